"""Distinct ids of any month from one exact bitmap of ids per day."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DateType,
    LongType,
    StructField,
    StructType,
)

from vestibule.functions.days import in_year, on_days
from vestibule.operators.densify import MONTHS, densify
from vestibule.plans.openings import OPENING
from vestibule.state.parts import DAY, read_parts, replace_parts

BITMAPS = StructType(
    [
        StructField("bucket", LongType()),
        StructField("bits", BinaryType()),
        StructField(DAY, DateType()),
    ]
)
NUMBERS = StructType([StructField("cd_cpfcgc", LongType()), StructField("numero", LongType())])


def day_ids(
    events: DataFrame,
    days: Sequence[date],
    kind: str = OPENING,
    partition: str | None = None,
    late_days: int = 0,
) -> DataFrame:
    """``(dia, cd_cpfcgc)``: the distinct ids, not null, of events on ``days``."""
    at = F.col("dt_ocorrencia")
    stored = None if partition is None else F.col(partition)
    hit = (F.col("ds_ocorrencia") == kind) & on_days(at, days, stored, late_days)
    ids = events.filter(hit).select(F.to_date(at).alias(DAY), F.col("cd_cpfcgc").cast("bigint"))
    return ids.filter(F.col("cd_cpfcgc").isNotNull()).distinct()


def read_numbers(spark: SparkSession, path: str) -> DataFrame:
    """The numbers given to ids so far; none if the table does not exist yet."""
    try:
        return spark.read.schema(NUMBERS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).select(*[F.lit(None).cast("bigint").alias(c) for c in NUMBERS.names])


def number_ids(ids: DataFrame, path: str) -> DataFrame:
    """``(cd_cpfcgc, numero)``: the table at ``path`` with a number for every new one of ``ids``.

    Bitmaps hold 32,768 neighbouring numbers each, so ids that lie far apart, such as tax
    numbers, would have a bitmap each. Numbers given here are consecutive within a task
    that gives them. They never change, and giving them twice changes nothing.
    """
    spark = ids.sparkSession
    known = read_numbers(spark, path)
    new = ids.select("cd_cpfcgc").distinct().join(known, "cd_cpfcgc", "left_anti")
    last = known.agg(F.max("numero")).first()[0]
    first = 0 if last is None else last + 1
    number = F.lit(first) + F.monotonically_increasing_id()
    new.select("cd_cpfcgc", number.alias("numero")).write.mode("append").parquet(path)
    return spark.read.schema(NUMBERS).parquet(path)


def day_bitmaps(ids: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """``(dia, bucket, bits)``: a bit per id of ``(dia, cd_cpfcgc)``, exact.

    ``numbers`` gives the bit of each id, otherwise the id itself does. Ids are distinct
    per day before they meet their number, so an id of very many events is no hot key.
    """
    number = F.col("cd_cpfcgc")
    if numbers is not None:
        ids, number = ids.join(numbers, "cd_cpfcgc"), F.col("numero")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    return ids.groupBy(DAY, F.bitmap_bucket_number(number).alias("bucket")).agg(bits)


def refresh_bitmaps(
    events: DataFrame,
    path: str,
    days: Sequence[date],
    kind: str = OPENING,
    numbers: str | None = None,
    partition: str | None = None,
    late_days: int = 0,
) -> None:
    """Bring the bitmaps of ``days`` at ``path`` up to date; the log is read for these days only.

    ``numbers`` is the path of the ids' numbers, for ids that lie far apart; new ids get
    theirs first. ``partition`` and ``late_days`` as in ``on_days``.
    """
    ids = day_ids(events, days, kind, partition, late_days)
    table = None if numbers is None else number_ids(ids, numbers)
    replace_parts(day_bitmaps(ids, table), path, days)


def read_bitmaps(spark: SparkSession, path: str) -> DataFrame:
    return read_parts(spark, path, BITMAPS)


def openings_from_bitmaps(bitmaps: DataFrame, as_of: date) -> DataFrame:
    """``openings_by_month`` from stored days alone: no event is read.

    The bitmaps of a month are merged bucket by bucket, in the map tasks first, and their
    bits counted; only the days of the year of ``as_of`` are read.
    """
    of_year = bitmaps.filter(in_year(F.col(DAY), as_of.year))
    merged = of_year.groupBy(F.month(DAY).alias("mes"), "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits")
    )
    counts = merged.groupBy("mes").agg(F.sum(F.bitmap_count("bits")).alias("aberturas_conta"))
    # Grouped by month of the year: at most twelve rows.
    return densify(F.broadcast(counts), "mes", MONTHS, {"aberturas_conta": 0}).orderBy("mes")
