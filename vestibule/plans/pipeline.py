"""All reports in one run: tables in, named CSV reports and chart frames out."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from vestibule.operators.cohorts import SINCE
from vestibule.operators.frames import bar_frame, format_matrix, series_frame
from vestibule.plans.change import change_of, hour_profile, openings_of
from vestibule.plans.onboarding import cohort_matrix
from vestibule.plans.openings import openings_by_month
from vestibule.sources import schemas
from vestibule.sources.reports import read_report, write_report

# The legend names of the change chart.
CHANGE_SERIES = {"du3": "DU3", "du7": "DU7", "du30": "DU30"}


def change_series(change: DataFrame) -> DataFrame:
    """Points of the three-line change chart."""
    return series_frame(change, "hora", CHANGE_SERIES)


def month_bars(openings: DataFrame) -> DataFrame:
    """Bars of the month chart; a missing count gets no bar and no label."""
    return bar_frame(openings, "mes", "aberturas_conta", skip_null=True)


def hour_bars(openings: DataFrame) -> DataFrame:
    """Bars of the hour chart."""
    return bar_frame(openings, "hora", "aberturas_conta")


def write_charts(spark: SparkSession, folder: str) -> None:
    """Read the four reports back and write the chart and table frames made from them."""
    charts = {
        "change_series": (change_series, "hourly_change", schemas.HOURLY_CHANGE),
        "hour_bars": (hour_bars, "openings_by_hour", schemas.OPENINGS_BY_HOUR),
        "month_bars": (month_bars, "openings_by_month", schemas.OPENINGS_BY_MONTH),
        "cohort_matrix_text": (format_matrix, "cohort_matrix", schemas.COHORT_MATRIX),
    }
    for name, (shape, report, schema) in charts.items():
        write_report(shape(read_report(spark, folder, report, schema)), folder, name)


def run_reports(
    events: DataFrame,
    calendar: DataFrame,
    clients: DataFrame,
    as_of: date,
    folder: str,
    since: date = SINCE,
    partition: str | None = None,
    late_days: int = 0,
) -> None:
    """Write every report and every frame under ``folder``, each under its own name.

    The log is scanned twice: for the months, and for the hours of the at most five
    days that both hour reports need. Those hours are written first, as a table of at
    most 24 rows.
    """
    stored = {"partition": partition, "late_days": late_days}
    hours = f"{folder.rstrip('/')}/hour_profile"
    profile = hour_profile(events, calendar, as_of, **stored)
    profile.coalesce(1).write.mode("overwrite").parquet(hours)
    profile = events.sparkSession.read.schema(profile.schema).parquet(hours)
    reports = {
        "openings_by_month": openings_by_month(events, as_of, **stored),
        "openings_by_hour": openings_of(profile),
        "hourly_change": change_of(profile),
        "cohort_matrix": cohort_matrix(clients, since),
    }
    for name, report in reports.items():
        write_report(report, folder, name)
    write_charts(events.sparkSession, folder)
