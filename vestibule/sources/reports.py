"""Reports as named CSV folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vestibule.session import shared_folder

# Columns of the quarantine: the report, the file and the line as it stands there.
BAD_LINE = "linha"
QUARANTINE = StructType(
    [StructField(name, StringType()) for name in ("relatorio", "arquivo", BAD_LINE)]
)


def write_report(df: DataFrame, folder: str, name: str) -> str:
    """Write ``df`` as one CSV file with a header under its own name, replacing an earlier run.

    Reports have some dozen rows at most. Joining their partitions keeps their order.
    """
    path = f"{folder.rstrip('/')}/{name}"
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def read_report(spark: SparkSession, folder: str, name: str, schema: StructType) -> DataFrame:
    """Read a report back; a header that does not match ``schema`` is an error."""
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return reader.csv(f"{folder.rstrip('/')}/{name}")


def read_report_sorted_out(
    spark: SparkSession, folder: str, name: str, schema: StructType, quarantine: str
) -> DataFrame:
    """The good rows of a report; its broken lines go to ``quarantine``, none is lost.

    A line is broken if it has more or fewer fields than ``schema`` or one that is not of
    its type. Broken lines are added as ``(relatorio, arquivo, linha)`` to the part of the
    quarantine that is this report's, in place of those found there before, so reading
    a report again does not list them twice. A header that does not match is an error.
    """
    path = f"{folder.rstrip('/')}/{name}"
    kept = StructType([*schema.fields, StructField(BAD_LINE, StringType())])
    reader = spark.read.schema(kept).option("header", True).option("enforceSchema", False)
    lines = reader.option("columnNameOfCorruptRecord", BAD_LINE).csv(path)
    # Written with all columns: a query of a few would have Spark parse, and find fault
    # with, those only.
    parsed = f"{shared_folder(spark)}/{name}"
    lines.select(*kept.names, F.col("_metadata.file_path").alias("arquivo")).write.parquet(parsed)
    rows = spark.read.schema(StructType([*kept.fields, QUARANTINE["arquivo"]])).parquet(parsed)
    bad = rows.filter(F.col(BAD_LINE).isNotNull())
    bad = bad.select(F.lit(name).alias("relatorio"), "arquivo", BAD_LINE)
    bad.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/{name}")
    return rows.filter(F.col(BAD_LINE).isNull()).select(*schema.names)


def read_quarantine(spark: SparkSession, quarantine: str, name: str) -> DataFrame:
    """The broken lines of a report, as they were read last."""
    return spark.read.schema(QUARANTINE).parquet(f"{quarantine.rstrip('/')}/{name}")
