"""Ratios and text tests that the reports are made of."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, total: Column) -> Column:
    """``part`` as a percentage of ``total``, to two places, half away from zero.

    The factor comes before the division. ``part / total * 100`` on doubles
    misses ties (23 of 160 would give 14.37); this order is exact for totals
    below about 7e11. A total of 0 gives null.
    """
    return F.round(F.try_divide(part * 100, total), 2)


def relative_change(base: Column, other: Column) -> Column:
    """``1 - other/base`` as a fraction; 0 when both sides are missing.

    A missing ``base`` counts as 1 and a missing ``other`` as 0. A base of 0
    (all its ids null) gives null.
    """
    ratio = F.try_divide(F.coalesce(other, F.lit(0)), F.coalesce(base, F.lit(1)))
    return F.when(base.isNull() & other.isNull(), F.lit(0.0)).otherwise(1 - ratio)


def contains_any(text: Column, parts: Sequence[str]) -> Column:
    """True when ``text`` holds one of ``parts``; null for a null text."""
    return reduce(or_, [text.contains(part) for part in parts])


def flag(condition: Column) -> Column:
    """1 where ``condition`` holds and 0 elsewhere, also where it is null."""
    return F.when(condition, 1).otherwise(0)
