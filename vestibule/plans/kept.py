"""The daily run on kept state: it reads what is new and publishes all reports at once."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vestibule.operators.cohorts import SINCE
from vestibule.operators.lookbacks import count_seen, fetch_lookbacks
from vestibule.plans.change import BASE, EARLIER, YESTERDAY, change_of, openings_of
from vestibule.plans.onboarding import cohort_matrix
from vestibule.plans.openings import OPENING
from vestibule.plans.pipeline import write_charts
from vestibule.sources.publish import new_run, publish
from vestibule.sources.reports import write_report
from vestibule.state.bitmaps import openings_from_bitmaps, read_bitmaps, refresh_bitmaps
from vestibule.state.cohorts import matrix_from_sums, stored_sums
from vestibule.state.hours import read_hours, refresh_hours
from vestibule.state.parts import DAY, stored_parts


def days_to_read(stored: set[date], wanted: Iterable[date], settled: date) -> list[date]:
    """The days of ``wanted`` that are not stored, and the stored ones from ``settled`` on.

    What is stored of the latter may have changed, whether it is wanted now or later.
    """
    return sorted({day for day in wanted if day not in stored} | {d for d in stored if d >= settled})


def run_kept_reports(
    events: DataFrame,
    calendar: DataFrame,
    clients: DataFrame | None,
    as_of: date,
    folder: str,
    state: str,
    since: date = SINCE,
    kind: str = OPENING,
    partition: str | None = None,
    late_days: int = 0,
    numbered: bool = True,
) -> str:
    """``run_reports`` on the state kept under ``state``; returns the folder of the run.

    Of the log only the days are read that the state lacks or that may have changed: a
    first run reads the year up to ``as_of``, a daily one a day or two more than
    ``late_days``, one after a pause the days since the last run as well. An event counts
    if it comes in up to ``late_days`` days after its own. Events after ``as_of`` do not
    count. The cohort matrix comes from ``clients`` or,
    without them, from the sums kept under ``state``. The reports go to a run folder of
    their own; readers keep the last run until this one is complete.
    """
    spark = events.sparkSession
    paths = {name: f"{state.rstrip('/')}/{name}" for name in ("bitmaps", "numbers", "hours", "sums")}
    stored = {"kind": kind, "partition": partition, "late_days": late_days}

    # Every run stores its own date, which is not over then: the last one is known by it.
    known = stored_parts(spark, paths["bitmaps"])
    settled = min(as_of, max(known, default=as_of)) - timedelta(days=late_days)
    year = [date(as_of.year, 1, 1) + timedelta(days=k) for k in range(366)]
    lacking = days_to_read(known, [day for day in year if day <= as_of], settled)
    numbers = paths["numbers"] if numbered else None

    ks = (YESTERDAY, BASE, *EARLIER)
    days = fetch_lookbacks(calendar, as_of, ks[1:]) | {YESTERDAY: as_of - timedelta(days=1)}
    of_hours = days_to_read(stored_parts(spark, paths["hours"]), days.values(), settled)
    refresh_hours(events, paths["hours"], of_hours, **stored)
    # Last, as this moves the date of the last run on.
    refresh_bitmaps(events, paths["bitmaps"], lacking, numbers=numbers, **stored)
    opened = read_bitmaps(spark, paths["bitmaps"]).filter(F.col(DAY) <= F.lit(as_of))
    hours = read_hours(spark, paths["hours"]).withColumnRenamed(DAY, "day")
    profile = count_seen(hours.filter(hours["day"].isin(sorted(set(days.values())))), days, ks)

    reports = {
        "openings_by_month": openings_from_bitmaps(opened, as_of),
        "openings_by_hour": openings_of(profile),
        "hourly_change": change_of(profile),
        "cohort_matrix": matrix_from_sums(stored_sums(spark, paths["sums"]))
        if clients is None
        else cohort_matrix(clients, since),
    }
    run = new_run(folder)
    for name, report in reports.items():
        write_report(report, run, name)
    write_charts(spark, run)
    publish(spark, folder, run)
    return run
