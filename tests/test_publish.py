"""Publishing as a whole, broken lines, the bucketed copy, salting, and days joined as a table."""


import re
import threading
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from frames import calendar, event_log, physical, scanned_rows, tuples
from test_lookbacks import dates, random_log
from test_oracles import sample
from vestibule.operators import salting
from vestibule.operators.lookbacks import fetch_lookbacks, lookback_counts
from vestibule.plans.change import hourly_change, hourly_change_pruned
from vestibule.plans.openings import openings_by_month
from vestibule.sources import bucketed, publish, reports, schemas, standins
from vestibule.sources.reports import read_quarantine, read_report_sorted_out, write_report
from vestibule.sources.tables import read_table

AS_OF = date(2024, 1, 31)


def month_report(spark, n):
    return spark.range(1, 13).selectExpr("cast(id AS int) AS mes", f"id * {n} AS aberturas_conta")


def hour_report(spark, n):
    return spark.range(0, 24).selectExpr("cast(id AS int) AS hora", f"id * {n} AS aberturas_conta")


def shown(spark, folder):
    run = publish.current_run(spark, folder)
    months = reports.read_report(spark, run, "openings_by_month", schemas.OPENINGS_BY_MONTH)
    hours = reports.read_report(spark, run, "openings_by_hour", schemas.OPENINGS_BY_HOUR)
    return months.agg(F.max("aberturas_conta")).first()[0] // 12, hours.agg(F.max("aberturas_conta")).first()[0] // 23


def both(spark, n):
    return {"openings_by_month": month_report(spark, n), "openings_by_hour": hour_report(spark, n)}


def test_readers_see_one_run_or_the_next(spark, tmp_path):
    folder = str(tmp_path)
    publish.publish_reports(spark, folder, both(spark, 1))
    assert shown(spark, folder) == (1, 1)
    publish.publish_reports(spark, folder + "/", both(spark, 2))
    assert shown(spark, folder) == (2, 2)
    months = publish.read_published(spark, folder, "openings_by_month", schemas.OPENINGS_BY_MONTH)
    assert tuples(months) == tuples(month_report(spark, 2))


def test_a_run_that_dies_between_two_reports_leaves_the_old_set(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    publish.publish_reports(spark, folder, both(spark, 1))
    real = reports.write_report

    def dies(report, run, name):
        if name == "openings_by_hour":
            raise RuntimeError("killed")
        return real(report, run, name)

    monkeypatch.setattr(publish, "write_report", dies)
    with pytest.raises(RuntimeError, match="killed"):
        publish.publish_reports(spark, folder, both(spark, 2))
    assert shown(spark, folder) == (1, 1)
    monkeypatch.setattr(publish, "write_report", real)
    monkeypatch.setattr(publish, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):  # all reports written, the name not yet
        publish.publish_reports(spark, folder, both(spark, 3))
    assert shown(spark, folder) == (1, 1)


def test_a_reader_never_finds_the_manifest_missing_or_in_part(spark, tmp_path):
    folder = str(tmp_path)
    runs = [publish.publish_reports(spark, folder, both(spark, n)) for n in (1, 2)]
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(max(p.name for p in (tmp_path / publish.MANIFEST).glob("[0-9]*")).split("-")[1])

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(100):
        publish.publish(spark, folder, runs[k % 2])
    stop.set()
    reader.join()
    assert set(seen) <= {run.rsplit("/", 1)[-1] for run in runs} and len(seen) > 100
    assert publish.current_run(spark, folder) == runs[1]
    assert {p.name for p in tmp_path.iterdir()} == {publish.MANIFEST, "runs"}
    with pytest.raises(FileNotFoundError, match="published"):
        publish.current_run(spark, f"{folder}/runs")


BROKEN = ["3", "4,5,6", "x,7", "8,9.5", "", '"10,1']


@pytest.mark.parametrize("line", BROKEN[:4])
def test_one_broken_line_is_quarantined(spark, tmp_path, line):
    folder, quarantine = f"{tmp_path}/reports", f"{tmp_path}/quarantine"
    write_report(month_report(spark, 5), folder, "openings_by_month")
    (tmp_path / "reports" / "openings_by_month" / "more.csv").write_text(f"mes,aberturas_conta\n1,7\n{line}\n2,8\n")
    for _ in range(2):  # reading again lists the line once
        good = read_report_sorted_out(spark, folder, "openings_by_month", schemas.OPENINGS_BY_MONTH, quarantine)
        assert sorted(tuples(good)) == sorted([*tuples(month_report(spark, 5)), (1, 7), (2, 8)])
        assert sorted(tuples(good.select("mes"))) == sorted([(m,) for m in [*range(1, 13), 1, 2]])
        assert good.count() == 14
        bad = read_quarantine(spark, quarantine, "openings_by_month").collect()
        assert [(r.relatorio, r.linha) for r in bad] == [("openings_by_month", line)]
        assert bad[0].arquivo.endswith("/more.csv")


def test_no_broken_lines_and_a_wrong_header(spark, tmp_path):
    folder, quarantine = f"{tmp_path}/reports", f"{tmp_path}/quarantine"
    write_report(month_report(spark, 5), folder, "openings_by_month")
    good = read_report_sorted_out(spark, folder, "openings_by_month", schemas.OPENINGS_BY_MONTH, quarantine)
    assert tuples(good) == tuples(month_report(spark, 5))
    assert read_quarantine(spark, quarantine, "openings_by_month").count() == 0
    with pytest.raises(Exception, match="header"):
        read_report_sorted_out(spark, folder, "openings_by_month", schemas.OPENINGS_BY_HOUR, quarantine).collect()


@pytest.fixture
def shuffled_joins(spark):
    """Every join shuffles and nothing is planned anew."""
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_the_bucketed_copy_counts_without_an_exchange_of_ids(spark, shuffled_joins, tmp_path):
    events = random_log(spark, 7, 3000)
    copy = bucketed.write_bucketed(events, "log_in_buckets", 4, f"{tmp_path}/log")
    report = bucketed.openings_of_buckets(copy, AS_OF)
    assert tuples(report) == tuples(openings_by_month(events, AS_OF))
    exchanges = re.findall(r"hashpartitioning\((.*?)\)", physical(report))
    assert exchanges and all("cd_cpfcgc" not in by for by in exchanges)
    full = re.findall(r"hashpartitioning\((.*?)\)", physical(openings_by_month(events, AS_OF)))
    assert any("cd_cpfcgc" in by for by in full)
    spark.sql("DROP TABLE log_in_buckets")


def test_a_hot_id_has_a_row_per_hour_and_type_in_its_bucket(spark, tmp_path):
    rows = [("2024-01-05 10:00:00", 1)] * 500 + [("2024-01-05 10:30:00", 1), ("2024-01-05 11:00:00", 1)]
    copy = bucketed.write_bucketed(event_log(spark, rows), "hot_log", 2, f"{tmp_path}/log")
    assert copy.count() == 2
    spark.sql("DROP TABLE hot_log")


def hot_order(spark, folder):
    lines = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 4000).alias("l_orderkey"),
        F.lit(standins.SINCE).cast("timestamp_ntz").alias("l_shipdate"),
    )
    lines = lines.unionByName(lines.limit(50).withColumn("l_orderkey", F.lit(None).cast("bigint")))
    orders = spark.range(0, 4100, 1, 4).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 50).alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"),
        F.lit(standins.SINCE).cast("timestamp_ntz").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    )
    lines.write.parquet(f"{folder}/lineitem.parquet")
    orders.write.parquet(f"{folder}/orders.parquet")


def largest_share(joined):
    sizes = joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()
    return max(r.n for r in sizes) / sum(r.n for r in sizes)


def test_a_hot_order_is_split_by_the_plan_itself(spark, shuffled_joins, tmp_path):
    hot_order(spark, str(tmp_path))
    lines, orders = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("lineitem", "orders"))
    orders = orders.withColumnRenamed("o_orderkey", "l_orderkey")
    salted = salting.salted_join(lines, orders, "l_orderkey", rows_per_task=2000)
    plain = lines.join(orders, "l_orderkey")
    assert largest_share(plain) > 0.33
    assert largest_share(salted) < 0.12
    columns = sorted(plain.columns)
    assert sorted(salted.columns) == columns
    counts = lambda df: sorted(tuples(df.groupBy(*columns).count()))
    assert counts(salted) == counts(plain)
    matrices = [
        onboarding_flags(spark, standins.clients(spark, str(tmp_path), rows)) for rows in (None, 2000)
    ]
    assert matrices[0] == matrices[1]


def onboarding_flags(spark, made):
    return sorted(tuples(made.groupBy("dt_criacao", "dt_atualiz", "perfil").count()), key=str)


def test_hot_keys_are_measured_and_bounded(spark):
    rows = spark.range(0, 100_000).selectExpr("CASE WHEN id % 4 = 0 THEN 7 WHEN id % 4 = 1 THEN NULL ELSE id END AS k")
    assert tuples(salting.hot_keys(rows, "k", 1000)) == [(7, 26)]
    assert salting.hot_keys(rows, "k", 30_000).count() == 0
    # Even with a limit of one row a key needs more than a thousandth of all.
    assert salting.hot_keys(rows.filter("k IS NOT NULL"), "k", 1).count() == 1


@pytest.mark.parametrize("late_days", [0, 2])
def test_joined_days_prune_the_log_without_a_job_while_planning(spark, tmp_path, late_days):
    path = f"{tmp_path}/log"
    made = random_log(spark, 8, 30)
    loaded = F.date_add(F.to_date("dt_ocorrencia"), F.pmod(F.hash("cd_cpfcgc"), F.lit(late_days + 1)))
    made.withColumn("dia", loaded).repartition("dia").write.partitionBy("dia").parquet(path)
    calendar(spark, list(dates("2023-11-01", 152))).write.parquet(f"{tmp_path}/calendar")
    log = read_table(spark, path, schemas.EVENT_LOG, "dia")
    table = read_table(spark, f"{tmp_path}/calendar", schemas.CALENDAR)
    store = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "no job may run")
    try:
        report = hourly_change_pruned(log, table, AS_OF, "dia", late_days=late_days)
        plan = physical(report)
        assert list(store.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "dynamicpruning" in plan
    assert tuples(report) == tuples(hourly_change(made, table, AS_OF))
    days = set(fetch_lookbacks(table, AS_OF, (1, 3, 7, 30)).values())
    stored = {d + timedelta(days=k) for d in days for k in range(late_days + 1)}
    wanted = log.filter(F.col("dia").isin(sorted(stored))).count()
    assert scanned_rows(report) - table.count() <= wanted < log.count()


def test_late_days_reach_the_lookback_counts(spark, tmp_path):
    path = f"{tmp_path}/log"
    made = random_log(spark, 9, 30)
    made.withColumn("dia", F.date_add(F.to_date("dt_ocorrencia"), 1)).write.partitionBy("dia").parquet(path)
    log = read_table(spark, path, schemas.EVENT_LOG, "dia")
    table = calendar(spark, list(dates("2023-11-01", 152)))
    days = fetch_lookbacks(table, AS_OF, (1, 3, 7, 30))
    late = lookback_counts(log, days, "INCLUSAO", F.col("dia"), late_days=1)
    assert sorted(tuples(late)) == sorted(tuples(lookback_counts(made, days, "INCLUSAO")))
    assert late.count() > lookback_counts(log, days, "INCLUSAO", F.col("dia")).count()


def test_the_registered_log_has_a_bitmap_per_day(spark):
    assert contract._days_of(standins.event_log(spark, sample("0.001")))[-1] == date(2024, 1, 30)
