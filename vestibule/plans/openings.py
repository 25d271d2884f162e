"""Accounts opened per month and per hour."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vestibule.functions.days import in_year, on_days
from vestibule.operators.densify import HOURS, MONTHS, densify, distinct_ids

# Fixed value: the event type that records an opening.
OPENING = "INCLUSAO"


def openings_by_month(
    events: DataFrame,
    as_of: date,
    kind: str = OPENING,
    partition: str | None = None,
    late_days: int = 0,
) -> DataFrame:
    """``(mes, aberturas_conta)``: distinct ids per month of the year of ``as_of``.

    ``mes`` is a number, so the order is 1, 2, 10 and not 1, 10, 2. ``partition`` and
    ``late_days`` as in ``on_days``.
    """
    at = F.col("dt_ocorrencia")
    day = None if partition is None else F.col(partition)
    in_range = in_year(at, as_of.year, day, late_days)
    opened = events.filter((F.col("ds_ocorrencia") == kind) & in_range)
    counts = distinct_ids(opened, F.month(at).alias("mes"), F.col("cd_cpfcgc"), "aberturas_conta")
    # Grouped by month of the year: at most twelve rows.
    return densify(F.broadcast(counts), "mes", MONTHS, {"aberturas_conta": 0}).orderBy("mes")


def openings_by_hour(
    events: DataFrame,
    as_of: date,
    kind: str = OPENING,
    partition: str | None = None,
    late_days: int = 0,
) -> DataFrame:
    """``(hora, aberturas_conta)``: distinct ids per hour of the day before ``as_of``."""
    at = F.col("dt_ocorrencia")
    day = None if partition is None else F.col(partition)
    yesterday = as_of - timedelta(days=1)
    in_range = on_days(at, [yesterday], day, late_days)
    opened = events.filter((F.col("ds_ocorrencia") == kind) & in_range)
    counts = distinct_ids(opened, F.hour(at).alias("hora"), F.col("cd_cpfcgc"), "aberturas_conta")
    return fill_hours(counts)


def fill_hours(counts: DataFrame) -> DataFrame:
    """All hours of the day; ``counts`` is grouped by hour, so it has at most 24 rows."""
    return densify(F.broadcast(counts), "hora", HOURS, {"aberturas_conta": 0}).orderBy("hora")
