"""The report inputs as views of the sample tables (see FIXTURES.md)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from vestibule.operators.salting import salted_join

# Which sample rows stand in for which report input.
AS_OF = date(2024, 1, 31)
AS_OF_MONDAY = date(2024, 1, 29)
SIGNUP = "signup"
ORDERS_AS_OF = date(1998, 12, 31)
ORDERS_KIND = "F"
SINCE = date(1998, 7, 1)
SPARSE_SINCE = date(2000, 6, 1)
UPDATED_SINCE = date(1999, 1, 1)
PATTERNS = {
    "no_profile": ("NOT SPECIFIED",),
    "known_profiles": ("URGENT", "HIGH", "MEDIUM"),
}
CALENDAR_FIRST = date(2023, 11, 1)
CALENDAR_LAST = date(2024, 3, 31)
HOLIDAY = date(2024, 1, 24)

_EVENTS = StructType(
    [
        StructField("ts", TimestampNTZType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
    ]
)
_ORDERS = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_orderdate", TimestampNTZType()),
        StructField("o_orderpriority", StringType()),
    ]
)
_LINES = StructType(
    [StructField("l_orderkey", LongType()), StructField("l_shipdate", TimestampNTZType())]
)


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as the event log."""
    events = spark.read.schema(_EVENTS).parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.col("ts").alias("dt_ocorrencia"),
        F.col("user_id").alias("cd_cpfcgc"),
        F.col("event_type").alias("ds_ocorrencia"),
    )


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``orders`` table as an event log that fills all twelve months."""
    orders = spark.read.schema(_ORDERS).parquet(f"{sf_dir}/orders.parquet")
    return orders.select(
        F.col("o_orderdate").alias("dt_ocorrencia"),
        F.col("o_custkey").alias("cd_cpfcgc"),
        F.col("o_orderstatus").alias("ds_ocorrencia"),
    )


def calendar(spark: SparkSession) -> DataFrame:
    """A date dimension around the sample events, with one holiday."""
    days = spark.range(0, (CALENDAR_LAST - CALENDAR_FIRST).days + 1, 1, numPartitions=1)
    day = F.date_add(F.lit(CALENDAR_FIRST), F.col("id").cast("int"))
    return days.select(
        day.cast("string").alias("calendar_date"),
        (F.weekday(day) + 1).alias("calendar_iso_weekday"),
        F.when(day == F.lit(HOLIDAY), "True").otherwise("False").alias("is_holiday"),
    )


def earlier_clients(now: DataFrame) -> DataFrame:
    """The client view as it was before: updates from 1999 on had not been made yet.

    Who was updated since then had no update date and no profile; some others, created
    on the first ten days of a month, had another profile.
    """
    updated = F.coalesce(F.col("dt_atualiz") >= F.lit(UPDATED_SINCE), F.lit(False))
    other = F.when(F.dayofmonth("dt_criacao") <= 10, F.lit("2-HIGH")).otherwise(F.col("perfil"))
    return now.select(
        "dt_criacao",
        F.when(~updated, F.col("dt_atualiz")).alias("dt_atualiz"),
        F.when(~updated, other).alias("perfil"),
        "tp_pessoa",
    )


def clients(spark: SparkSession, sf_dir: str, rows_per_task: int | None = None) -> DataFrame:
    """``orders LEFT JOIN lineitem`` as the client view, one row per order line.

    Written as the matched rows plus the orders without lines. Spark can split
    a hot order's lines across tasks in an inner join but not in a left join,
    and the anti join meets each order key only once. The lines come first in
    the inner join: a merge join streams its left side and holds the matches of
    its right, here a single order and not all lines of one. Orders without a key
    match nothing and are a third part; without them both joins filter the orders
    alike and share their exchange. With ``rows_per_task`` hot orders are split by the
    plan itself and not by replanning.
    """
    orders = spark.read.schema(_ORDERS).parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.schema(_LINES).parquet(f"{sf_dir}/lineitem.parquet")
    low = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_custkey") % 2 == 0)
    client = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderdate").alias("dt_criacao"),
        F.when(low, None).otherwise(F.col("o_orderpriority")).alias("perfil"),
        F.col("o_orderstatus").alias("tp_pessoa"),
    )
    keyed = client.filter(F.col("l_orderkey").isNotNull())
    lines_made = lines.withColumnRenamed("l_shipdate", "dt_atualiz")
    if rows_per_task is None:
        updated = lines_made.join(keyed, "l_orderkey")
    else:
        updated = salted_join(lines_made, keyed, "l_orderkey", rows_per_task)
    unseen = keyed.join(lines.select("l_orderkey").distinct(), "l_orderkey", "left_anti")
    unkeyed = client.filter(F.col("l_orderkey").isNull())
    without = unseen.unionByName(unkeyed).withColumn("dt_atualiz", F.lit(None).cast("timestamp_ntz"))
    return updated.unionByName(without).select("dt_criacao", "dt_atualiz", "perfil", "tp_pessoa")
