"""Input tables, from Parquet folders or the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Stored types that serve as well as the declared one and are left as they are:
# a cast around a column would keep its filters from the scan.
_EQUIVALENT = {
    TimestampNTZType(): (TimestampType(), DateType()),
    LongType(): (StringType(),),
}


def _as_read(declared: StructField, stored: StructField) -> StructField:
    if stored.dataType in _EQUIVALENT.get(declared.dataType, ()):
        return StructField(declared.name, stored.dataType)
    return declared


def read_table(
    spark: SparkSession, source: str, schema: StructType, partition: str | None = None
) -> DataFrame:
    """Read ``source``, a path (it holds a slash) or a catalog table, as ``schema``.

    ``partition`` names the date column a large log is partitioned by, to be
    kept beside the declared columns. Other columns are dropped. A missing
    column is an error, as is a type that does not fit; declaring the schema to
    the Parquet reader would give nulls for the former.
    """
    table = spark.read.parquet(source) if "/" in source else spark.table(source)
    extra = [] if partition is None else [table.schema[partition]]
    stored = table.select(*schema.names, *[field.name for field in extra])
    fields = [_as_read(field, stored.schema[field.name]) for field in schema.fields]
    return stored.to(StructType(fields + extra))
