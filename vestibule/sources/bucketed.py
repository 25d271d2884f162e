"""A copy of the event log in buckets by id."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vestibule.functions.days import in_year
from vestibule.operators.densify import MONTHS, densify, distinct_ids
from vestibule.plans.openings import OPENING


def write_bucketed(events: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """``(dia, hora, cd_cpfcgc, ds_ocorrencia)`` as catalog table ``table``, bucketed and sorted by id.

    What repeats within an hour is stored once, so that a hot id, which has all its rows
    in one bucket, has at most a row per hour and type there. The rows are dealt out by
    id once, here; whoever groups by id or joins on it does not have to again. ``path``
    is a shared folder for the files, by default the catalog's.
    """
    at = F.col("dt_ocorrencia")
    rows = events.select(
        F.to_date(at).alias("dia"), F.hour(at).alias("hora"), "cd_cpfcgc", "ds_ocorrencia"
    ).distinct()
    # Dealt as the buckets are: one file per bucket.
    writer = rows.repartition(buckets, "cd_cpfcgc").write.mode("overwrite")
    writer = writer.bucketBy(buckets, "cd_cpfcgc").sortBy("cd_cpfcgc")
    (writer if path is None else writer.option("path", path)).saveAsTable(table)
    return events.sparkSession.table(table)


def openings_of_buckets(bucketed: DataFrame, as_of: date, kind: str = OPENING) -> DataFrame:
    """``openings_by_month`` from the bucketed copy.

    Each bucket counts its own ids; only counts per month are exchanged.
    """
    opened = bucketed.filter((F.col("ds_ocorrencia") == kind) & in_year(F.col("dia"), as_of.year))
    counts = distinct_ids(opened, F.month("dia").alias("mes"), F.col("cd_cpfcgc"), "aberturas_conta")
    # Grouped by month of the year: at most twelve rows.
    return densify(F.broadcast(counts), "mes", MONTHS, {"aberturas_conta": 0}).orderBy("mes")
