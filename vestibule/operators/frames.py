"""Chart-ready and table-ready rows made from finished reports."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vestibule.functions.labels import month_label, percent_text

# What a column without a header name is called by the tools that
# export the reports, and by Spark's own CSV reader.
STRAY_COLUMN = r"^Unnamed|^_c\d+$"


def bar_frame(df: DataFrame, x: str, y: str, skip_null: bool = False) -> DataFrame:
    """``(x, height, label, label_y)``: bars with their value written at half height."""
    if skip_null:
        df = df.filter(F.col(y).isNotNull())
    return df.select(
        F.col(x).alias("x"),
        F.col(y).alias("height"),
        F.col(y).cast("string").alias("label"),
        (F.col(y) / 2).alias("label_y"),
    )


def series_frame(df: DataFrame, x: str, series: Mapping[str, str]) -> DataFrame:
    """``(x, series, value)``: one row per point; ``series`` maps columns to legend names."""
    named = df.select(x, *[F.col(c).alias(name) for c, name in series.items()])
    return named.unpivot(x, list(series.values()), "series", "value")


def drop_stray_columns(df: DataFrame) -> DataFrame:
    """Drop the columns that came without a header name."""
    return df.drop(*[c for c in df.columns if re.match(STRAY_COLUMN, c)])


def format_matrix(df: DataFrame, month: str = "mes", remainder: str = "nr") -> DataFrame:
    """The cohort matrix as text: month labels, ``%`` behind numbers, blanks for nulls.

    Rows come by month, which the labels could no longer tell; a matrix has at most
    twelve. Only the bucket columns are blanked; a null ``remainder`` stays null.
    Numbers are taken as doubles throughout, so 5 shows as ``5.0%`` in every column.
    """
    cells = []
    for c in drop_stray_columns(df).columns:
        if c.lower() == month:
            cells.append(month_label(F.col(c)).alias(month))
        elif c.lower() == remainder:
            cells.append(percent_text(F.col(c)).alias(remainder))
        else:
            cells.append(F.coalesce(percent_text(F.col(c)), F.lit("")).alias(c.lower()))
    return df.coalesce(1).sortWithinPartitions(F.col(month).cast("int")).select(*cells)
