"""Hour-by-hour change of the last day against earlier days."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vestibule.functions.measures import relative_change
from vestibule.operators.densify import HOURS, densify
from vestibule.operators.lookbacks import (
    fetch_lookbacks,
    joined_profile,
    lookback_profile,
    resolve_lookbacks,
)
from vestibule.plans.openings import OPENING, fill_hours

# The lookbacks in calendar days, the first being the base.
BASE = 1
EARLIER = (3, 7, 30)
# The key under which an hour profile holds the day before the run date itself.
YESTERDAY = 0


def hourly_change(
    events: DataFrame,
    calendar: DataFrame,
    as_of: date,
    kind: str = OPENING,
    partition: str | None = None,
    late_days: int = 0,
) -> DataFrame:
    """``(hora, du3, du7, du30)``: change of distinct openings per hour.

    Each lookback goes back calendar days and then at most one hop off a weekend
    or holiday. The at most four days are read from the calendar first (a small
    job); the event log is then scanned once, for those days only.
    """
    ks = (BASE, *EARLIER)
    days = fetch_lookbacks(calendar, as_of, ks)
    day = None if partition is None else F.col(partition)
    return change_of(lookback_profile(events, days, ks, kind, day, late_days))


def hourly_change_pruned(
    events: DataFrame,
    calendar: DataFrame,
    as_of: date,
    partition: str,
    kind: str = OPENING,
    late_days: int = 0,
) -> DataFrame:
    """``hourly_change`` of a log partitioned by date, planned without running a job.

    The calendar is read when the query runs; the days it names prune the partitions.
    """
    ks = (BASE, *EARLIER)
    resolved = resolve_lookbacks(calendar, as_of, ks)
    return change_of(joined_profile(events, resolved, ks, kind, partition, late_days))


def hour_profile(
    events: DataFrame,
    calendar: DataFrame,
    as_of: date,
    kind: str = OPENING,
    partition: str | None = None,
    late_days: int = 0,
) -> DataFrame:
    """One scan for both hour reports: the lookback profile with the day before ``as_of``."""
    ks = (YESTERDAY, BASE, *EARLIER)
    days = fetch_lookbacks(calendar, as_of, ks[1:]) | {YESTERDAY: as_of - timedelta(days=1)}
    day = None if partition is None else F.col(partition)
    return lookback_profile(events, days, ks, kind, day, late_days)


def openings_of(profile: DataFrame) -> DataFrame:
    """The openings by hour, from an hour profile; an hour without events counts 0."""
    return fill_hours(profile.select("hora", F.col(f"d{YESTERDAY}").alias("aberturas_conta")))


def change_of(profile: DataFrame) -> DataFrame:
    """The hourly change, from a lookback profile."""
    base = F.col(f"d{BASE}")
    # Grouped by hour: at most 24 rows.
    return (
        densify(F.broadcast(profile), "hora", HOURS)
        .select("hora", *[relative_change(base, F.col(f"d{k}")).alias(f"du{k}") for k in EARLIER])
        .orderBy("hora")
    )
