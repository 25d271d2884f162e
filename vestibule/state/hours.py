"""The hourly change from distinct ids kept per day: a run reads the days it lacks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StructField, StructType

from vestibule.functions.days import on_days
from vestibule.operators.lookbacks import count_seen, fetch_lookbacks
from vestibule.plans.change import BASE, EARLIER, change_of
from vestibule.plans.openings import OPENING
from vestibule.state.parts import DAY, read_parts, replace_parts, stored_parts

HOUR_IDS = StructType(
    [
        StructField("hora", IntegerType()),
        StructField("cd_cpfcgc", LongType()),
        StructField(DAY, DateType()),
    ]
)


def refresh_hours(
    events: DataFrame,
    path: str,
    days: Sequence[date],
    kind: str = OPENING,
    partition: str | None = None,
    late_days: int = 0,
) -> None:
    """Bring the distinct ids per hour of ``days`` at ``path`` up to date.

    The log is read for these days only; null ids are kept, as they tell an hour with
    events from one without. ``partition`` and ``late_days`` as in ``on_days``.
    """
    at = F.col("dt_ocorrencia")
    stored = None if partition is None else F.col(partition)
    hit = (F.col("ds_ocorrencia") == kind) & on_days(at, days, stored, late_days)
    ident = F.col("cd_cpfcgc").cast("bigint").alias("cd_cpfcgc")
    rows = events.filter(hit).select(F.hour(at).alias("hora"), ident, F.to_date(at).alias(DAY))
    replace_parts(rows.distinct(), path, days)


def read_hours(spark: SparkSession, path: str) -> DataFrame:
    return read_parts(spark, path, HOUR_IDS)


def change_from_hours(
    hours: DataFrame, calendar: DataFrame, as_of: date, days: dict[int, date] | None = None
) -> DataFrame:
    """``hourly_change`` from stored days alone: what is distinct already is only counted."""
    ks = (BASE, *EARLIER)
    days = fetch_lookbacks(calendar, as_of, ks) if days is None else days
    seen = hours.filter(F.col(DAY).isin(sorted(set(days.values()))))
    return change_of(count_seen(seen.withColumnRenamed(DAY, "day"), days, ks))


def hourly_change_kept(
    events: DataFrame,
    calendar: DataFrame,
    as_of: date,
    path: str,
    kind: str = OPENING,
    partition: str | None = None,
    late_days: int = 0,
) -> DataFrame:
    """``hourly_change`` over the hours kept at ``path``, after the days it lacks were read.

    Of at most four days a run per day lacks one or two; nothing else of the log is read.
    A stored day stays as it is until ``refresh_hours`` is asked for it.
    """
    spark = events.sparkSession
    days = fetch_lookbacks(calendar, as_of, (BASE, *EARLIER))
    lacking = sorted(set(days.values()) - stored_parts(spark, path))
    refresh_hours(events, path, lacking, kind, partition, late_days)
    return change_from_hours(read_hours(spark, path), calendar, as_of, days)
