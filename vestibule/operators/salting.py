"""Joins on keys of which some are very frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys that are dealt out are at most this many, whatever the number of rows.
MOST_HOT = 1000
SALT = "_salt"
SALTS = "_salts"


def hot_keys(rows: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """``(key, _salts)``: keys with more than ``rows_per_task`` rows, and how many parts they need.

    Measured over all rows. A key counts as hot only if it also has more than one row in
    ``MOST_HOT`` of all, so there are fewer than ``MOST_HOT`` whatever the size.
    """
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    share = F.floor(rows.agg(F.count("*")).scalar() / F.lit(MOST_HOT))
    hot = F.col("n") > F.greatest(F.lit(rows_per_task), share)
    parts = F.ceil(F.col("n") / F.lit(rows_per_task)).cast("int")
    return counts.filter(hot).select(key, parts.alias(SALTS))


def salted_join(
    many: DataFrame, few: DataFrame, key: str, rows_per_task: int = 1_000_000
) -> DataFrame:
    """``many JOIN few`` on ``key`` where single keys may hold a large share of ``many``.

    The rows of a hot key are dealt into parts of about ``rows_per_task`` rows, and the
    rows of ``few`` with that key are repeated once per part; all other rows are joined
    as they are. The split is in the plan itself and needs no replanning. ``few`` should
    hold a key only a few times. Rows with a null key match nothing.
    """
    # Fewer than MOST_HOT rows: a bounded broadcast.
    hot = F.broadcast(hot_keys(many, key, rows_per_task))
    part = F.pmod(F.monotonically_increasing_id(), F.coalesce(F.col(SALTS), F.lit(1)))
    dealt = many.join(hot, key, "left").withColumn(SALT, part.cast("int")).drop(SALTS)
    parts = F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1)
    repeated = few.join(hot, key, "left").withColumn(SALT, F.explode(parts)).drop(SALTS)
    return dealt.join(repeated, [key, SALT]).drop(SALT)
