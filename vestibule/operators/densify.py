"""Completing a grouped result over a fixed list of keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOURS = range(24)
MONTHS = range(1, 13)


def key_spine(spark: SparkSession, key: str, keys: range) -> DataFrame:
    """One row per key. A single partition: the default would be one task per core."""
    rows = spark.range(keys.start, keys.stop, keys.step, numPartitions=1)
    return rows.select(F.col("id").cast("int").alias(key))


def distinct_ids(rows: DataFrame, key: Column, ident: Column, count: str) -> DataFrame:
    """Exact number of distinct non-null ids per key.

    Spark removes duplicates inside each map task and shuffles on (key, id), so
    neither a hot id nor the small number of keys makes a hot task. A group
    whose ids are all null stays, with 0.
    """
    return rows.groupBy(key).agg(F.count_distinct(ident).alias(count))


def densify(
    grouped: DataFrame, key: str, keys: range, fill: Mapping[str, object] | None = None
) -> DataFrame:
    """Left join ``grouped`` (one row per key) onto all of ``keys``.

    Aggregating before this join keeps the large table out of it. ``fill`` gives
    the values of columns that an absent key leaves null. Rows whose key is not
    in ``keys`` drop out; a key that comes twice keeps both rows. The join is left
    to Spark: a caller that has grouped by one of the fixed spines above knows the
    bound of its rows and asks for the broadcast itself.
    """
    spine = key_spine(grouped.sparkSession, key, keys)
    joined = spine.join(grouped, key, "left")
    fill = fill or {}
    return joined.select(
        *[
            F.coalesce(F.col(c), F.lit(fill[c])).alias(c) if c in fill else F.col(c)
            for c in joined.columns
        ]
    )
