"""Earlier days to compare with: which ones, and what happened on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vestibule.functions.days import hop_back, on_days


def _hops(calendar: DataFrame) -> DataFrame:
    """``(calendar_date, hop)``, one row per date: days to go back from it.

    A date listed twice is an error, raised when the row is used: joining it
    would double every count.
    """
    hop = hop_back(F.col("calendar_iso_weekday"), F.col("is_holiday"))
    twice = F.raise_error(F.concat(F.lit("calendar lists a date twice: "), "calendar_date"))
    return (
        calendar.select("calendar_date", hop.alias("hop"))
        .groupBy("calendar_date")
        .agg(F.when(F.count("*") > 1, twice).otherwise(F.max("hop")).alias("hop"))
    )


def resolve_lookbacks(calendar: DataFrame, as_of: date, ks: Sequence[int]) -> DataFrame:
    """``(k, d0, day)``: for each ``k`` the date ``as_of - k`` and the day to read for it.

    At most one row per ``k``; a date that the calendar lacks gives none.
    """
    dates = [(as_of - timedelta(days=k)).isoformat() for k in ks]
    d0 = F.to_date("calendar_date")
    return _hops(calendar.filter(F.col("calendar_date").isin(dates))).select(
        F.date_diff(F.lit(as_of), d0).alias("k"),
        d0.alias("d0"),
        F.date_sub(d0, F.col("hop")).alias("day"),
    )


def resolve_lookbacks_of(
    calendar: DataFrame, as_of_days: DataFrame, ks: Sequence[int]
) -> DataFrame:
    """``(as_of, k, d0, day)`` for every date in the ``as_of`` column of ``as_of_days``."""
    wanted = as_of_days.select(
        "as_of", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k")
    ).withColumn("d0", F.date_sub("as_of", F.col("k")))
    on_date = F.col("d0").cast("string") == F.col("calendar_date")
    return wanted.join(_hops(calendar), on_date).select(
        "as_of", "k", "d0", F.date_sub("d0", F.col("hop")).alias("day")
    )


def fetch_lookbacks(calendar: DataFrame, as_of: date, ks: Sequence[int]) -> dict[int, date]:
    """The day to read for each of ``ks``, read into the driver: at most ``len(ks)`` rows.

    As literals the days prune files and row groups of the event log; joined as a
    table they would leave the scan unfiltered.
    """
    resolved = resolve_lookbacks(calendar, as_of, ks)
    return {row.k: row.day for row in resolved.select("k", "day").collect()}


def lookback_profile(
    events: DataFrame,
    days: Mapping[int, date],
    ks: Sequence[int],
    kind: str,
    partition: Column | None = None,
    late_days: int = 0,
) -> DataFrame:
    """``(hora, d<k>...)``: distinct ids per hour on the day each lookback reads.

    Null where a lookback has no day or saw no event; 0 where all its ids are
    null. One scan serves all lookbacks, and two that read the same day share
    its rows. Duplicates go first, in the map tasks and then by (hour, day, id),
    so a hot id is no hot task; after that, one small shuffle by hour counts
    every lookback side by side.
    """
    at = F.col("dt_ocorrencia")
    seen = (
        events.filter(F.col("ds_ocorrencia") == kind)
        .filter(on_days(at, days.values(), partition, late_days))
        .select(F.hour(at).alias("hora"), F.to_date(at).alias("day"), "cd_cpfcgc")
        .distinct()
    )
    return count_seen(seen, days, ks)


def count_seen(seen: DataFrame, days: Mapping[int, date], ks: Sequence[int]) -> DataFrame:
    """``(hora, d<k>...)`` from distinct ``(hora, day, cd_cpfcgc)``: they are only counted."""
    cells = [_ids_on(days.get(k)).alias(f"d{k}") for k in ks]
    return seen.groupBy("hora").agg(*cells) if cells else seen.select("hora").distinct()


def joined_profile(
    events: DataFrame,
    resolved: DataFrame,
    ks: Sequence[int],
    kind: str,
    partition: str,
    late_days: int = 0,
) -> DataFrame:
    """``lookback_profile`` with the days as a table: planning it runs no job.

    ``resolved`` is ``(k, day)``, one row per ``k`` at most, as from
    ``resolve_lookbacks``. The days are joined to ``partition``, the date column the log
    is partitioned by, so Spark reads the calendar when the query runs and then only the
    partitions that it names. Ids are counted per day before they meet the lookbacks, so
    two that read the same day share its rows.
    """
    at = F.col("dt_ocorrencia")
    late = F.explode(F.sequence(F.lit(0), F.lit(late_days))).alias("late")
    stored = resolved.select("day").distinct().select("day", late)
    stored = stored.select("day", F.date_add("day", F.col("late")).alias("stored"))
    # At most a few days for each of ``ks``: a bounded broadcast.
    on_day = (F.col(partition) == F.col("stored")) & (F.to_date(at) == F.col("day"))
    of_kind = events.filter(F.col("ds_ocorrencia") == kind)
    seen = of_kind.join(F.broadcast(stored), on_day).select(
        F.hour(at).alias("hora"), "day", "cd_cpfcgc"
    )
    # A row per hour and day, then one per lookback: all small from here on.
    counts = seen.groupBy("hora", "day").agg(F.count_distinct("cd_cpfcgc").alias("n"))
    long = counts.join(F.broadcast(resolved.select("k", "day")), "day")
    cells = [F.max(F.when(F.col("k") == k, F.col("n"))).alias(f"d{k}") for k in ks]
    return long.groupBy("hora").agg(*cells)


def _ids_on(day: date | None) -> Column:
    """Number of non-null ids on ``day`` among distinct rows; null without any row."""
    if day is None:
        return F.lit(None).cast("bigint")
    on_day = F.col("day") == F.lit(day)
    return F.when(F.count_if(on_day) > 0, F.count(F.when(on_day, F.col("cd_cpfcgc"))))


def lookback_counts(
    events: DataFrame,
    days: Mapping[int, date],
    kind: str,
    partition: Column | None = None,
    late_days: int = 0,
) -> DataFrame:
    """``(k, hora, n)``: the profile as one row per lookback and hour that saw an event."""
    wide = lookback_profile(events, days, sorted(days), kind, partition, late_days)
    cells = [cell for k in sorted(days) for cell in (F.lit(k), F.col(f"d{k}"))]
    by_lookback = F.create_map(*cells).cast("map<int, bigint>")
    long = wide.select("hora", F.explode(by_lookback).alias("k", "n"))
    return long.filter(F.col("n").isNotNull()).select("k", "hora", "n")
