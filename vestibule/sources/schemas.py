"""Declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

EVENT_LOG = StructType(
    [
        StructField("dt_ocorrencia", TimestampNTZType()),
        StructField("cd_cpfcgc", LongType()),
        StructField("ds_ocorrencia", StringType()),
    ]
)

CALENDAR = StructType(
    [
        StructField("calendar_date", StringType()),
        StructField("calendar_iso_weekday", IntegerType()),
        StructField("is_holiday", StringType()),
    ]
)

CLIENTS = StructType(
    [
        StructField("dt_criacao", TimestampNTZType()),
        StructField("dt_atualiz", TimestampNTZType()),
        StructField("perfil", StringType()),
        StructField("tp_pessoa", StringType()),
    ]
)

OPENINGS_BY_MONTH = StructType(
    [StructField("mes", IntegerType()), StructField("aberturas_conta", LongType())]
)

OPENINGS_BY_HOUR = StructType(
    [StructField("hora", IntegerType()), StructField("aberturas_conta", LongType())]
)

HOURLY_CHANGE = StructType(
    [StructField("hora", IntegerType())]
    + [StructField(c, DoubleType()) for c in ("du3", "du7", "du30")]
)

COHORT_MATRIX = StructType(
    [StructField("mes", IntegerType())]
    + [StructField(f"m{k}", DoubleType()) for k in range(7)]
    + [StructField("nr", DoubleType())]
)
