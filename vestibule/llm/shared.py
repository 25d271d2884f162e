"""Folders, written tables and Arrow batches that the operators share."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Rows of a batch that are turned into Python objects at a time, and rows of a batch.
SLICE_ROWS = 256
BATCH_ROWS = 1000
# Bytes of text that are turned into Python objects at a time.
SLICE_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new subfolder of the folder that all executors share, ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_and_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """As ``written``, with the number of rows, counted on the way."""
    seen = Observation()
    out = written(df.observe(seen, F.count("*").alias("n")), name)
    return out, seen.get["n"]


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    Needed on one machine or a shared disk when it is not installed; on a cluster
    ship it with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def small_batches(spark: SparkSession) -> None:
    """Hand at most ``BATCH_ROWS`` rows to Python at once; a lower setting stays.

    Spark's default of 10,000 is meant for narrow rows: of whole texts that many
    fill a worker's memory twice, in the JVM and in Python.
    """
    rows = int(spark.conf.get(_BATCH_SETTING))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str | Column = "text") -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[dict[str, list]]:
    """The batches as dicts of Python lists, ``rows`` rows at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows).to_pydict()


def byte_slices(
    batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[dict[str, list]]:
    """The batches as dicts of Python lists, of at most ``most`` bytes in ``column`` each.

    A longer value comes alone.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for at, size in enumerate(sizes):
            if at > start and held + size > most:
                yield batch.slice(start, at - start).to_pydict()
                start, held = at, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start).to_pydict()


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of ``schema`` from one list or array per column."""
    made = [
        column if isinstance(column, pa.Array) else pa.array(column, type=field.type)
        for field, column in ((field, columns[field.name]) for field in schema)
    ]
    return pa.RecordBatch.from_arrays(made, schema=schema)


def ddl(schema: pa.Schema) -> str:
    """The Spark schema text of an Arrow schema of the few types used here."""
    return ", ".join(f"`{field.name}` {_spark_type(field.type)}" for field in schema)


def _spark_type(kind: pa.DataType) -> str:
    if pa.types.is_list(kind):
        return f"array<{_spark_type(kind.value_type)}>"
    if pa.types.is_struct(kind):
        return f"struct<{', '.join(f'{f.name}: {_spark_type(f.type)}' for f in kind)}>"
    names = {
        pa.int64(): "bigint",
        pa.int32(): "int",
        pa.float64(): "double",
        pa.string(): "string",
        pa.binary(): "binary",
        pa.bool_(): "boolean",
    }
    return names[kind]


def map_arrow(df: DataFrame, function, schema: pa.Schema) -> DataFrame:
    """``df.mapInArrow`` with an Arrow schema."""
    small_batches(df.sparkSession)
    return df.mapInArrow(function, ddl(schema))
