"""Every registered query against its DuckDB counterpart."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from frames import REGISTERED

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

SPARK_TYPES = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string"}


def sample(sf):
    folder = Path(f"/root/testdata/sf{sf}")
    if not folder.exists():
        pytest.skip("sample tables are not here")
    return str(folder)


def by_value(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(row[i] for i in order) for row in rows)


def types(df):
    return dict(df.dtypes)


def check(spark, name, folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS FROM '{folder}/{table}.parquet'")
    expected = con.sql(contract.oracle_sql()[name])
    result = contract.queries()[name](spark, folder)
    rows = result.collect()
    assert len(rows) > 0
    assert sorted(result.columns) == sorted(expected.columns)
    assert by_value(result.columns, rows) == by_value(expected.columns, expected.fetchall())
    assert types(result) == {c: SPARK_TYPES[str(t)] for c, t in zip(expected.columns, expected.types)}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
@pytest.mark.parametrize("name", REGISTERED)
def test_query_equals_oracle(spark, name, sf):
    check(spark, name, sample(sf))


@pytest.mark.parametrize("name", REGISTERED)
def test_query_holds_without_broadcasts_and_replanning(spark, name):
    """The plans that large inputs get: shuffled joins, many partitions, ANSI off, another zone."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "13",
        "spark.sql.files.maxPartitionBytes": "100000",
        "spark.sql.ansi.enabled": "false",
        "spark.sql.session.timeZone": "America/New_York",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        check(spark, name, sample("0.001"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_every_query_has_an_oracle():
    assert set(REGISTERED) <= set(contract.oracle_sql())


def test_entry_has_a_row_per_hour(spark):
    sample("0.001")
    result = contract.entry(spark)
    assert result.columns == ["hora", "du3", "du7", "du30"]
    assert result.count() == 24
