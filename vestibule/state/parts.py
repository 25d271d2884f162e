"""Tables in parts, such as days, that are replaced whole and leave the other parts alone."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DAY = "dia"


def replace_parts(rows: DataFrame, path: str, values: Sequence[date | str], column: str = DAY) -> None:
    """Make ``rows`` the whole content of the parts ``values`` of the table at ``path``.

    ``column`` names the part of each row; rows of other parts are not written, and no
    other part is touched. Each part also gets one row that is null but for ``column``:
    so a part that has lost all its rows is replaced too, and counts as stored. Doing it
    again changes nothing. Spark divides a large part among several files and tasks.
    """
    if not values:
        return
    parts = F.explode(F.array(*[F.lit(value) for value in values]))
    marks = rows.sparkSession.range(1).select(parts.alias(column))
    marked = rows.filter(F.col(column).isin(list(values))).unionByName(
        marks, allowMissingColumns=True
    )
    writer = marked.hint("rebalance", column).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def stored_parts(spark: SparkSession, path: str, column: str = DAY) -> set:
    """The parts of the table at ``path``, as far as it exists: one value per part."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {row[0] for row in table.select(column).distinct().collect()}


def read_parts(spark: SparkSession, path: str, schema: StructType, column: str = DAY) -> DataFrame:
    """The table at ``path`` without the marks; filters on ``column`` prune whole parts."""
    table = spark.read.schema(schema).parquet(path)
    marked = [F.col(name).isNull() for name in schema.names if name != column]
    is_mark = marked[0]
    for null in marked[1:]:
        is_mark &= null
    return table.filter(~is_mark)
