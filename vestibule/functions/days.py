"""Calendar predicates and date arithmetic on columns."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO weekday numbers and the text that marks a holiday row.
SATURDAY = 6
SUNDAY = 7
HOLIDAY_FLAG = "True"


def on_days(
    at: Column, days: Iterable[date], partition: Column | None = None, late_days: int = 0
) -> Column:
    """True when the timestamp ``at`` falls on one of ``days``.

    Written as half-open ranges, one for days in a row, because those reach the scan,
    where ``to_date(at).isin(days)`` does not. They skip data in Parquet files with
    microsecond ``timestamp`` columns and in ORC files; for ``timestamp_ntz``
    Parquet columns Spark 4.1 lists them as pushed but reads every row group.
    ``partition`` is the log's date partition column, when it has one: the
    literals then prune whole directories, whatever the file format. It must equal
    the event's date, or lie up to ``late_days`` days after it, as the day of loading
    may; only this bound is widened, the range stays exact.
    """
    days = sorted(set(days))
    hit = _any_of([(at >= F.lit(first)) & (at < F.lit(end)) for first, end in _ranges(days)])
    if partition is None:
        return hit
    stored = {day + timedelta(days=late) for day in days for late in range(late_days + 1)}
    return partition.isin(sorted(stored)) & hit


def _ranges(days: list[date]) -> list[tuple[date, date]]:
    """Ascending days as half-open ranges of days that follow each other."""
    ranges: list[tuple[date, date]] = []
    for day in days:
        after = day + timedelta(days=1)
        if ranges and ranges[-1][1] == day:
            ranges[-1] = (ranges[-1][0], after)
        else:
            ranges.append((day, after))
    return ranges


def _any_of(conditions: list[Column]) -> Column:
    """Their disjunction, as a tree of little depth; false without any."""
    while len(conditions) > 1:
        pairs = zip(conditions[::2], conditions[1::2])
        rest = conditions[-1:] if len(conditions) % 2 else []
        conditions = [a | b for a, b in pairs] + rest
    return conditions[0] if conditions else F.lit(False)


def in_year(
    at: Column, year: int, partition: Column | None = None, late_days: int = 0
) -> Column:
    """True inside one calendar year, as a pushed half-open range; ``partition`` as in ``on_days``."""
    first, following = date(year, 1, 1), date(year + 1, 1, 1)
    hit = (at >= F.lit(first)) & (at < F.lit(following))
    if partition is None:
        return hit
    stored_until = following + timedelta(days=late_days)
    return (partition >= F.lit(first)) & (partition < F.lit(stored_until)) & hit


def whole_months(later: Column, earlier: Column) -> Column:
    """Months from ``earlier`` to ``later``, cut toward zero.

    Two equal days of the month, or two month ends, are a whole number of months.
    A ``later`` up to one month before ``earlier`` still counts as 0.

    Dates are enough: the part of a month left over has the sign of the
    difference between the days of the month, whatever the times of day, and is
    below one. Without the times the session's time zone plays no part.
    """
    return F.months_between(F.to_date(later), F.to_date(earlier)).cast("int")


def hop_back(iso_weekday: Column, is_holiday: Column) -> Column:
    """Days to go back from a date that is a weekend day or a holiday, else 0.

    The weekday decides before the holiday flag. One hop is all: the day landed
    on is not looked at again, so a Monday holiday reads the Sunday before it.
    """
    return (
        F.when(iso_weekday == SUNDAY, 2)
        .when((iso_weekday == SATURDAY) | (is_holiday == HOLIDAY_FLAG), 1)
        .otherwise(0)
    )
