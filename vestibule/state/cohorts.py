"""The cohort matrix kept up to date by changed clients alone."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from vestibule.operators.cohorts import SINCE, completion_matrix, flagged_clients
from vestibule.state.parts import read_parts, replace_parts

# How often a row of clients stands: 1 for a new value, -1 for an old one that it replaces.
SIGN = "sinal"
BATCH = "lote"
SUMS = StructType(
    [
        StructField("mes", IntegerType()),
        StructField("gap", IntegerType()),
        StructField("n", LongType()),
        StructField("sem", LongType()),
        StructField("com", LongType()),
        StructField(BATCH, StringType()),
    ]
)


def signed_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows of ``before`` that are not in ``after`` with a negative ``sinal``, and vice versa.

    Rows that are in both cancel out, as often as they are, in one aggregation; no key is
    needed.
    """
    both = before.withColumn(SIGN, F.lit(-1)).unionByName(after.withColumn(SIGN, F.lit(1)))
    return both.groupBy(*before.columns).agg(F.sum(SIGN).alias(SIGN)).filter(F.col(SIGN) != 0)


def cohort_deltas(changes: DataFrame, since: date = SINCE, **patterns) -> DataFrame:
    """``(mes, gap, n, sem, com)``: what rows of clients with a ``sinal`` add to the sums.

    ``n`` counts the clients, so that a month and gap that has lost all its clients is
    told from one whose clients have no known profile. ``patterns`` as in
    ``flagged_clients``.
    """
    flags = flagged_clients(changes, since, carry=(SIGN,), **patterns)
    sums = [F.sum(F.col(c) * F.col(SIGN)).alias(c) for c in ("sem", "com")]
    deltas = flags.groupBy("mes", "gap").agg(F.sum(SIGN).alias("n"), *sums)
    return deltas.filter("n <> 0 OR sem <> 0 OR com <> 0")


def store_deltas(deltas: DataFrame, path: str, batch: str) -> None:
    """Store a batch of deltas; storing it again replaces it and counts it once."""
    replace_parts(deltas.withColumn(BATCH, F.lit(batch)), path, [batch], BATCH)


def stored_sums(spark: SparkSession, path: str) -> DataFrame:
    """``(mes, gap, n, sem, com)`` over all batches, a few rows each."""
    kept = read_parts(spark, path, SUMS, BATCH).groupBy("mes", "gap")
    return kept.agg(*[F.sum(c).alias(c) for c in ("n", "sem", "com")]).filter("n > 0")


def fold_batches(spark: SparkSession, path: str, into: str, batch: str = "base") -> None:
    """Write all batches as a single one to the table ``into``, which begins anew from there."""
    store_deltas(stored_sums(spark, path), into, batch)


def matrix_from_sums(sums: DataFrame) -> DataFrame:
    """``cohort_matrix`` from stored sums: no client is read."""
    # At most twelve rows: one task sorts them without an exchange.
    return completion_matrix(sums).coalesce(1).sortWithinPartitions("mes")
