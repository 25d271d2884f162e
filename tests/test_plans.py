"""The physical plans: what reaches the scan, how often, and how skew is met."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from frames import REGISTERED, calendar, physical, scanned_rows
from test_lookbacks import dates, random_log
from test_oracles import sample
from vestibule.plans.change import hourly_change
from vestibule.plans.openings import openings_by_month
from vestibule.sources import schemas, standins
from vestibule.sources.tables import read_table

REPORTS = ("openings_by_month", "openings_by_month_orders", "openings_by_hour", "hourly_change")


def final(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def query(spark, name):
    return contract.queries()[name](spark, sample("0.01"))


@pytest.mark.parametrize("name", REPORTS)
def test_reports_scan_once_and_only_their_columns(spark, name):
    plan = physical(query(spark, name))
    scans = re.findall(r"ReadSchema: (.*)", plan)
    assert len(scans) == 1
    assert scans[0].count(":") == 3
    assert "SortMergeJoin" not in plan
    # Distinct ids, then counts; the spine and the final sort need none.
    assert len(re.findall(r"hashpartitioning|rangepartitioning", plan)) == 2


def test_year_and_days_reach_the_scan(spark):
    def pushed(name):
        return re.search(r"PushedFilters: (.*)", physical(query(spark, name))).group(1)

    assert "EqualTo(event_type,signup)" in pushed("openings_by_month")
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in pushed("openings_by_month")
    assert "LessThan(ts,2025-01-01T00:00)" in pushed("openings_by_month")
    assert "LessThan(ts,2024-01-31T00:00)" in pushed("openings_by_hour")
    days = pushed("hourly_change")
    for day in ("2024-01-30", "2024-01-26", "2024-01-23", "2024-01-01"):
        assert f"GreaterThanOrEqual(ts,{day}T00:00)" in days


def test_the_cohort_filters_reach_the_scan(spark):
    plan = physical(query(spark, "cohort_matrix"))
    pushed = [p for p in re.findall(r"PushedFilters: (.*)", plan) if "o_orderstatus" in p]
    assert len(pushed) == 3  # orders with a line, without one, and without a key
    for filters in pushed:
        assert "EqualTo(o_orderstatus,F)" in filters
        assert "GreaterThanOrEqual(o_orderdate,1998-07-01T00:00)" in filters


@pytest.mark.parametrize("name", REGISTERED)
def test_no_python_and_no_product_joins(spark, name):
    plan = physical(query(spark, name))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


@pytest.fixture(scope="module")
def partitioned_log(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('log')}/events"
    log = random_log(spark, 6, 20).withColumn("dia", F.to_date("dt_ocorrencia"))
    log.repartition("dia").write.partitionBy("dia").parquet(path)
    return path


@pytest.mark.parametrize("kind", ["date", "string"])
def test_a_partition_column_prunes_directories(spark, partitioned_log, kind):
    inference = "spark.sql.sources.partitionColumnTypeInference.enabled"
    spark.conf.set(inference, str(kind == "date").lower())
    try:
        log = read_table(spark, partitioned_log, schemas.EVENT_LOG, "dia")
    finally:
        spark.conf.unset(inference)
    assert dict(log.dtypes)["dia"] == kind
    table = calendar(spark, list(dates("2023-11-01", 152)))
    change = hourly_change(log, table, standins.AS_OF, partition="dia")
    months = openings_by_month(log, standins.AS_OF, partition="dia")
    for pruned, full in (
        (change, hourly_change(log, table, standins.AS_OF)),
        (months, openings_by_month(log, standins.AS_OF)),
    ):
        assert re.search(r"PartitionFilters: \[.*dia", physical(pruned))
        assert pruned.collect() == full.collect()
        assert scanned_rows(pruned) < scanned_rows(full) == 20_000


@pytest.mark.parametrize("layout", ["partitioned", "parquet timestamp", "orc", "parquet ntz"])
def test_the_days_limit_what_is_read(spark, tmp_path, layout):
    """Which layouts let the literals skip data, counted in rows and not read off the plan."""
    log = spark.range(0, 60_000, 1, 1).select(
        F.expr("timestamp_ntz '2023-12-02 00:00:00' + make_dt_interval(0, 0, cast(id as int))").alias(
            "dt_ocorrencia"
        ),
        F.col("id").alias("cd_cpfcgc"),
        F.lit("INCLUSAO").alias("ds_ocorrencia"),
    )
    path, partition = f"{tmp_path}/log", None
    by_day = log.repartitionByRange(40, "dt_ocorrencia").sortWithinPartitions("dt_ocorrencia")
    if layout == "partitioned":
        partition = "dia"
        by_day.withColumn("dia", F.to_date("dt_ocorrencia")).write.partitionBy("dia").parquet(path)
    elif layout == "parquet timestamp":
        # The default, INT96, has no statistics to skip by.
        spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        try:
            stamp = F.col("dt_ocorrencia").cast("timestamp")
            by_day.withColumn("dt_ocorrencia", stamp).write.parquet(path)
        finally:
            spark.conf.unset("spark.sql.parquet.outputTimestampType")
    elif layout == "orc":
        by_day.write.orc(path)
        spark.read.orc(path).createOrReplaceTempView("orc_log")
        path = "orc_log"
    else:
        by_day.write.parquet(path)
    log = read_table(spark, path, schemas.EVENT_LOG, partition)
    table = calendar(spark, list(dates("2023-11-01", 152)))
    change = hourly_change(log, table, date(2024, 1, 9), partition=partition)
    assert len(change.collect()) == 24
    wanted = 4 * 24 * 60  # four days at one row per minute
    if layout == "partitioned":
        assert scanned_rows(change) == wanted
    elif layout == "parquet ntz":
        # Listed as pushed, yet Spark 4.1 skips nothing for this column type.
        assert scanned_rows(change) == 60_000
    else:
        assert wanted <= scanned_rows(change) < 20_000


def test_the_client_joins_share_the_orders(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert "ReusedExchange" in final(standins.clients(spark, sample("0.01")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_orders_without_a_key_stay(spark, tmp_path):
    orders = spark.sql(
        "SELECT explode(array(1L, 2L, NULL, NULL)) AS o_orderkey, 3L AS o_custkey, 'F' AS "
        "o_orderstatus, timestamp_ntz '1998-08-01' AS o_orderdate, '1-URGENT' AS o_orderpriority"
    )
    lines = spark.sql(
        "SELECT explode(array(1L, 1L, NULL)) AS l_orderkey, timestamp_ntz '1998-09-01' AS l_shipdate"
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    updates = [r.dt_atualiz for r in standins.clients(spark, str(tmp_path)).collect()]
    assert sorted(u is None for u in updates) == [False, False, True, True, True]


def test_a_hot_order_is_split_across_tasks(spark, tmp_path):
    """A third of all lines on one order: the join splits them, and the result holds."""
    lines = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 4000).alias("l_orderkey"),
        F.expr("timestamp_ntz '1998-08-01 00:00:00' + make_dt_interval(cast(id % 200 as int))").alias(
            "l_shipdate"
        ),
    )
    orders = spark.range(0, 4100, 1, 4).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 50).alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"),
        F.lit(standins.SINCE).cast("timestamp_ntz").alias("o_orderdate"),
        F.element_at(
            F.array(*map(F.lit, ("1-URGENT", "4-NOT SPECIFIED", "5-LOW"))),
            (F.col("id") % 3 + 1).cast("int"),
        ).alias("o_orderpriority"),
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        matrix = contract.cohort_matrix(spark, str(tmp_path))
        plan = final(matrix)
        assert "SortMergeJoin(skew=true)" in plan
        joined = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        low = "o_orderpriority = '5-LOW' AND o_custkey % 2 = 0"
        counts = joined.selectExpr(
            "count(*) AS n",
            f"count_if(({low}) OR o_orderpriority LIKE '%NOT SPECIFIED%') AS sem",
            "count_if(o_orderpriority LIKE '%URGENT%') AS com",
            "count_if(l_orderkey IS NULL) AS unseen",
        ).first()
        assert counts.n == 300_100 and counts.unseen == 100
        flags = contract.profile_flags_by_gap(spark, str(tmp_path)).collect()
        assert sum(row.sem for row in flags) == counts.sem
        assert sum(row.com for row in flags) == counts.com
        assert [row.mes for row in matrix.collect()] == [7]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
