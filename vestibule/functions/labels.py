"""Text shown in charts and tables."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month labels for 1 to 12.
MONTH_LABELS = (
    "Jan", "Fev", "Mar", "Abr", "Mai", "Jun",
    "Jul", "Ago", "Set", "Out", "Nov", "Dez",
)


def month_label(month: Column) -> Column:
    """The label of a month number; null for a number outside 1 to 12."""
    pairs = chain.from_iterable(enumerate(MONTH_LABELS, start=1))
    return F.create_map(*map(F.lit, pairs))[month.cast("int")]


def percent_text(value: Column) -> Column:
    """``12.5`` as ``12.5%`` and ``5`` as ``5.0%``; null stays null."""
    return F.concat(value.cast("double").cast("string"), F.lit("%"))
