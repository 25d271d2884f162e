
from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date
from importlib.util import find_spec
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vestibule.operators.cohorts import flagged_clients
from vestibule.operators.cohorts import profile_flags_by_gap as sum_flags
from vestibule.operators.densify import HOURS, densify, distinct_ids
from vestibule.operators.frames import bar_frame, format_matrix
from vestibule.operators.lookbacks import (
    fetch_lookbacks,
    lookback_counts as count_lookbacks,
    lookback_profile,
    resolve_lookbacks_of,
)
from vestibule.plans import change, onboarding, openings, pipeline
from vestibule.session import shared_folder
from vestibule.sources import bucketed, publish, schemas, standins
from vestibule.sources.reports import (
    read_quarantine,
    read_report,
    read_report_sorted_out,
    write_report,
)
from vestibule.sources.tables import read_table
from vestibule.state import bitmaps, cohorts, hours

LOOKBACKS = (change.BASE, *change.EARLIER)


def openings_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = standins.event_log(spark, sf_dir)
    return openings.openings_by_month(log, standins.AS_OF, standins.SIGNUP)


def openings_by_month_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = standins.order_log(spark, sf_dir)
    report = openings.openings_by_month(log, standins.ORDERS_AS_OF, standins.ORDERS_KIND)
    return report.withColumnRenamed("aberturas_conta", "n")


def openings_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = standins.event_log(spark, sf_dir)
    return openings.openings_by_hour(log, standins.AS_OF, standins.SIGNUP)


def spine_densify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers per hour over all orders, which all lie at midnight: 23 hours to fill."""
    log = standins.order_log(spark, sf_dir)
    hour = F.hour("dt_ocorrencia").alias("hora")
    counts = distinct_ids(log, hour, F.col("cd_cpfcgc"), "n")
    return densify(F.broadcast(counts), "hora", HOURS, {"n": 0})  # at most 24 rows


def business_day_rollback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days to compare with, for every day that occurs in the event log."""
    days = standins.event_log(spark, sf_dir).select(F.to_date("dt_ocorrencia").alias("as_of"))
    resolved = resolve_lookbacks_of(standins.calendar(spark), days.distinct(), LOOKBACKS)
    return resolved.select(
        F.col("as_of").cast("string").alias("as_of"),
        "k",
        F.col("d0").cast("string").alias("d0"),
        F.col("day").cast("string").alias("day"),
    )


def lookback_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = fetch_lookbacks(standins.calendar(spark), standins.AS_OF, LOOKBACKS)
    return count_lookbacks(standins.event_log(spark, sf_dir), days, standins.SIGNUP)


def hourly_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, calendar = standins.event_log(spark, sf_dir), standins.calendar(spark)
    return change.hourly_change(log, calendar, standins.AS_OF, standins.SIGNUP)


def hourly_change_monday(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, calendar = standins.event_log(spark, sf_dir), standins.calendar(spark)
    return change.hourly_change(log, calendar, standins.AS_OF_MONDAY, standins.SIGNUP)


def profile_flags_by_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = standins.clients(spark, sf_dir)
    return sum_flags(flagged_clients(clients, standins.SINCE, **standins.PATTERNS))


def cohort_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = standins.clients(spark, sf_dir)
    return onboarding.cohort_matrix(clients, standins.SINCE, **standins.PATTERNS)


def cohort_matrix_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_matrix(cohort_matrix(spark, sf_dir))


def change_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.change_series(hourly_change(spark, sf_dir))


def month_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.month_bars(openings_by_month(spark, sf_dir))


def hour_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.hour_bars(openings_by_hour(spark, sf_dir))


def report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cohort matrix written as a named CSV report and read back."""
    folder = shared_folder(spark)
    write_report(cohort_matrix(spark, sf_dir), folder, "cohort_matrix")
    return read_report(spark, folder, "cohort_matrix", schemas.COHORT_MATRIX)


def _log_by_load_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events copied into a log partitioned by the day after, as column ``dia``."""
    path = f"{shared_folder(spark)}/events"
    log = standins.event_log(spark, sf_dir)
    loaded = log.withColumn("dia", F.date_add(F.to_date("dt_ocorrencia"), 1))
    loaded.repartition("dia").write.partitionBy("dia").parquet(path)
    return read_table(spark, path, schemas.EVENT_LOG, "dia")


def _stored_calendar(spark: SparkSession) -> DataFrame:
    """The calendar as a stored table."""
    path = f"{shared_folder(spark)}/calendar"
    standins.calendar(spark).write.parquet(path)
    return read_table(spark, path, schemas.CALENDAR)


def _days_of(log: DataFrame) -> list[date]:
    """The days that a log has events on: a row per day reaches the driver."""
    days = log.select(F.to_date("dt_ocorrencia").alias("dia")).distinct()
    return sorted(row.dia for row in days.collect())


def openings_by_hour_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The openings by hour of a log partitioned by the day of loading."""
    copy = _log_by_load_day(spark, sf_dir)
    kind, as_of = standins.SIGNUP, standins.AS_OF
    return openings.openings_by_hour(copy, as_of, kind, partition="dia", late_days=1)


def lookback_counts_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of every lookback, from that log and a stored calendar."""
    days = fetch_lookbacks(_stored_calendar(spark), standins.AS_OF, LOOKBACKS)
    copy = _log_by_load_day(spark, sf_dir)
    return count_lookbacks(copy, days, standins.SIGNUP, F.col("dia"), late_days=1)


def business_day_rollback_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days to compare with, for every day of the log, from a stored calendar."""
    days = standins.event_log(spark, sf_dir).select(F.to_date("dt_ocorrencia").alias("as_of"))
    resolved = resolve_lookbacks_of(_stored_calendar(spark), days.distinct(), LOOKBACKS)
    return resolved.select(
        F.col("as_of").cast("string").alias("as_of"),
        "k",
        F.col("d0").cast("string").alias("d0"),
        F.col("day").cast("string").alias("day"),
    )


def hourly_change_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change without a job while planning: a stored calendar prunes the log as it runs."""
    log, calendar = _log_by_load_day(spark, sf_dir), _stored_calendar(spark)
    return change.hourly_change_pruned(
        log, calendar, standins.AS_OF, "dia", standins.SIGNUP, late_days=1
    )


def hourly_change_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change from kept hours: Monday's run first, then the one that reads what is new."""
    path = f"{shared_folder(spark)}/hours"
    log, calendar = standins.event_log(spark, sf_dir), standins.calendar(spark)
    for as_of in (standins.AS_OF_MONDAY, standins.AS_OF):
        report = hours.hourly_change_kept(log, calendar, as_of, path, standins.SIGNUP)
    return report


def openings_from_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The openings by month from one bitmap per day; the last day comes in a run of its own."""
    path = f"{shared_folder(spark)}/bitmaps"
    log = standins.event_log(spark, sf_dir)
    *earlier, last = _days_of(log)
    for days in (earlier, [last]):
        bitmaps.refresh_bitmaps(log, path, days, standins.SIGNUP)
    return bitmaps.openings_from_bitmaps(bitmaps.read_bitmaps(spark, path), standins.AS_OF)


def openings_from_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for ids that lie far apart: each gets a number close to others first."""
    folder = shared_folder(spark)
    path, numbers = f"{folder}/bitmaps", f"{folder}/numbers"
    far = F.col("cd_cpfcgc") * F.lit(1_000_003) + F.lit(10_000_000_000)
    log = standins.event_log(spark, sf_dir).withColumn("cd_cpfcgc", far)
    days = _days_of(log)
    for part in (days[: len(days) // 2], days[len(days) // 2 :]):
        bitmaps.refresh_bitmaps(log, path, part, standins.SIGNUP, numbers)
    return bitmaps.openings_from_bitmaps(bitmaps.read_bitmaps(spark, path), standins.AS_OF)


def openings_of_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The openings by month from a copy of the log in buckets by id."""
    folder = shared_folder(spark)
    table = f"log_{folder.rsplit('-', 1)[-1]}"
    log = standins.event_log(spark, sf_dir)
    copy = bucketed.write_bucketed(log, table, buckets=8, path=f"{folder}/log")
    return bucketed.openings_of_buckets(copy, standins.AS_OF, standins.SIGNUP)


def cohort_matrix_from_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix from kept sums: all clients as they were, then those that have changed."""
    path = f"{shared_folder(spark)}/sums"
    now = standins.clients(spark, sf_dir)
    before = standins.earlier_clients(now)
    batches = {
        "base": before.withColumn(cohorts.SIGN, F.lit(1)),
        "changes": cohorts.signed_changes(before, now),
    }
    for name, rows in batches.items():
        deltas = cohorts.cohort_deltas(rows, standins.SINCE, **standins.PATTERNS)
        cohorts.store_deltas(deltas, path, name)
    return cohorts.matrix_from_sums(cohorts.stored_sums(spark, path))


def cohort_matrix_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix over clients whose hot orders are split by the plan."""
    clients = standins.clients(spark, sf_dir, rows_per_task=1_000_000)
    return onboarding.cohort_matrix(clients, standins.SINCE, **standins.PATTERNS)


def cohort_matrix_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix as readers see it after two runs were published as a whole."""
    folder = shared_folder(spark)
    matrices = (cohort_matrix_sparse(spark, sf_dir), cohort_matrix(spark, sf_dir))
    for matrix in matrices:
        publish.publish_reports(spark, folder, {"cohort_matrix": matrix})
    return publish.read_published(spark, folder, "cohort_matrix", schemas.COHORT_MATRIX)


def _with_broken_lines(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a report with a line of two fields beside each good one."""
    folder = shared_folder(spark)
    write_report(cohort_matrix(spark, sf_dir), folder, "cohort_matrix")
    good = spark.read.option("header", False).text(f"{folder}/cohort_matrix")
    fields = F.split("value", ",")
    head = F.col("value").startswith("mes")
    broken = good.filter(~head).select(F.concat(fields[0], F.lit(",?")).alias("value"))
    header = good.filter(head).limit(1)
    rows = header.unionByName(broken).coalesce(1)  # a dozen lines
    rows.write.mode("append").text(f"{folder}/cohort_matrix")
    return folder


def cohort_matrix_sorted_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The good lines of a report with broken ones."""
    folder = _with_broken_lines(spark, sf_dir)
    return read_report_sorted_out(
        spark, folder, "cohort_matrix", schemas.COHORT_MATRIX, f"{folder}/quarantine"
    )


def quarantined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The broken ones."""
    folder = _with_broken_lines(spark, sf_dir)
    quarantine = f"{folder}/quarantine"
    read_report_sorted_out(spark, folder, "cohort_matrix", schemas.COHORT_MATRIX, quarantine)
    return read_quarantine(spark, quarantine, "cohort_matrix").drop("arquivo")


def cohort_matrix_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matrix from a later day on: some cells have no client."""
    clients = standins.clients(spark, sf_dir)
    return onboarding.cohort_matrix(clients, standins.SPARSE_SINCE, **standins.PATTERNS)


def cohort_matrix_stray_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """That matrix as a CSV report with a column that has no name, read back as a text table."""
    folder = shared_folder(spark)
    stray = cohort_matrix_sparse(spark, sf_dir).withColumn("Unnamed: 9", F.col("mes"))
    path = write_report(stray, folder, "cohort_matrix")
    return format_matrix(spark.read.option("header", True).csv(path))


def lookback_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of the last business day's profile; an hour without events has no bar."""
    days = fetch_lookbacks(standins.calendar(spark), standins.AS_OF, LOOKBACKS)
    log = standins.event_log(spark, sf_dir)
    profile = lookback_profile(log, days, LOOKBACKS, standins.SIGNUP)
    return bar_frame(profile, "hora", f"d{change.BASE}", skip_null=True)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the hourly change report on the smallest sample."""
    return hourly_change(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every report, operator and frame, by name."""
    registered = (
        openings_by_month,
        openings_by_month_orders,
        openings_by_hour,
        spine_densify,
        business_day_rollback,
        lookback_counts,
        hourly_change,
        hourly_change_monday,
        profile_flags_by_gap,
        cohort_matrix,
        cohort_matrix_text,
        change_series,
        month_bars,
        hour_bars,
        report_roundtrip,
        openings_by_hour_partitioned,
        cohort_matrix_sparse,
        cohort_matrix_stray_text,
        lookback_bars,
        lookback_counts_partitioned,
        business_day_rollback_stored,
        hourly_change_pruned,
        hourly_change_kept,
        openings_from_bitmaps,
        openings_from_numbers,
        openings_of_buckets,
        cohort_matrix_from_deltas,
        cohort_matrix_salted,
        cohort_matrix_published,
        cohort_matrix_sorted_out,
        quarantined_lines,
    )
    return {query.__name__: query for query in registered} | _optional("queries")


def _optional(what: str) -> dict:
    """``queries`` or ``oracle_sql`` of the training-data operators and their pipeline, if there."""
    found = {}
    if _there("vestibule.llm"):
        from vestibule.llm import queries as llm

        found |= getattr(llm, what)()
        if _there("corpus_pipeline"):
            import corpus_pipeline

            if what == "queries":
                found["pipeline"] = corpus_pipeline.run
            elif corpus_pipeline.ORACLE_SQL:
                found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def _there(module: str) -> bool:
    """Whether ``module`` exists; an empty folder in its place does not count."""
    spec = find_spec(module)
    return spec is not None and spec.origin is not None


# --- The same results in DuckDB SQL, written without the library's code. ---

_OPENINGS_BY_MONTH = """
WITH hit AS (
  SELECT month({ts})::INTEGER AS mes, count(DISTINCT {id}) AS n
  FROM {table} WHERE {kind} AND year({ts}) = {year} GROUP BY ALL
)
SELECT m::INTEGER AS mes, coalesce(n, 0)::BIGINT AS {name}
FROM range(1, 13) AS months(m) LEFT JOIN hit ON mes = m ORDER BY m
"""

_OPENINGS_BY_HOUR = """
WITH hit AS (
  SELECT hour(ts)::INTEGER AS hora, count(DISTINCT user_id) AS n
  FROM events WHERE event_type = 'signup' AND ts::DATE = DATE '2024-01-30' GROUP BY ALL
)
SELECT h::INTEGER AS hora, coalesce(n, 0)::BIGINT AS aberturas_conta
FROM range(24) AS hours(h) LEFT JOIN hit ON hora = h ORDER BY h
"""

# Expects a CTE `asked(as_of)`; gives `resolved(as_of, k, d0, day)`.
_RESOLVED = """
calendar AS (
  SELECT d::DATE AS d, isodow(d) AS wd, d::DATE = DATE '2024-01-24' AS holiday
  FROM range(DATE '2023-11-01', DATE '2024-04-01', INTERVAL 1 DAY) AS days(d)
),
resolved AS (
  SELECT as_of, k::INTEGER AS k, d AS d0,
         d - (CASE WHEN wd = 7 THEN 2 WHEN wd = 6 OR holiday THEN 1 ELSE 0 END)::INTEGER AS day
  FROM asked, (VALUES (1), (3), (7), (30)) AS lags(k), calendar
  WHERE d = as_of - k::INTEGER
)
"""

_COUNTS = (
    "WITH asked AS (SELECT DATE '{as_of}' AS as_of),"
    + _RESOLVED
    + """,
counted AS (
  SELECT k, hour(ts)::INTEGER AS hora, count(DISTINCT user_id)::BIGINT AS n
  FROM resolved JOIN events ON ts::DATE = day
  WHERE event_type = 'signup' GROUP BY ALL
)
"""
)

_CHANGE = (
    _COUNTS
    + """,
wide AS (
  SELECT h::INTEGER AS hora, max(n) FILTER (k = 1) AS d1, max(n) FILTER (k = 3) AS d3,
         max(n) FILTER (k = 7) AS d7, max(n) FILTER (k = 30) AS d30
  FROM range(24) AS hours(h) LEFT JOIN counted ON hora = h GROUP BY h
),
change AS (
  SELECT hora,
         CASE WHEN coalesce(d1, d3) IS NULL THEN 0::DOUBLE
              ELSE 1 - coalesce(d3, 0) / nullif(coalesce(d1, 1), 0)::DOUBLE END AS du3,
         CASE WHEN coalesce(d1, d7) IS NULL THEN 0::DOUBLE
              ELSE 1 - coalesce(d7, 0) / nullif(coalesce(d1, 1), 0)::DOUBLE END AS du7,
         CASE WHEN coalesce(d1, d30) IS NULL THEN 0::DOUBLE
              ELSE 1 - coalesce(d30, 0) / nullif(coalesce(d1, 1), 0)::DOUBLE END AS du30
  FROM wide
)
"""
)

_FLAGS = """
WITH client AS (
  SELECT o_orderdate AS a, l_shipdate AS b,
         CASE WHEN o_orderpriority = '5-LOW' AND o_custkey % 2 = 0 THEN NULL
              ELSE o_orderpriority END AS profile
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
  WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1998-07-01'
),
gapped AS (
  SELECT month(a)::INTEGER AS mes,
         trunc((year(b) - year(a)) * 12 + month(b) - month(a)
           + CASE WHEN day(b) = day(a) OR (b::DATE = last_day(b) AND a::DATE = last_day(a)) THEN 0
                  ELSE ((day(b) - day(a)) * 86400.0 + epoch(b) % 86400 - epoch(a) % 86400)
                       / 86400.0 / 31 END)::INTEGER AS gap,
         coalesce(profile LIKE '%NOT SPECIFIED%', true) AS is_sem,
         coalesce(regexp_matches(profile, 'URGENT|HIGH|MEDIUM'), false) AS is_com
  FROM client
),
flags AS (
  SELECT mes, gap, count(*) FILTER (is_sem)::BIGINT AS sem, count(*) FILTER (is_com)::BIGINT AS com
  FROM gapped GROUP BY ALL
)
"""

_SPARSE_FLAGS = _FLAGS.replace("DATE '1998-07-01'", "DATE '2000-06-01'")

_MATRIX = (
    ", totals AS (SELECT mes, nullif(sum(sem) + sum(com), 0) AS total, sum(sem) AS sem "
    + "FROM flags GROUP BY mes), matrix AS (SELECT mes, "
    + "".join(
        f"round(100 * max(com) FILTER (gap = {k}) / max(total)::DOUBLE, 2) AS m{k}, "
        for k in range(7)
    )
    + "round(100 * max(totals.sem) / max(total)::DOUBLE, 2) AS nr "
    + "FROM flags JOIN totals USING (mes) GROUP BY mes)"
)

_MATRIX_TEXT = (
    " SELECT ['Jan','Fev','Mar','Abr','Mai','Jun','Jul','Ago','Set','Out','Nov','Dez'][mes] AS mes, "
    + "".join(f"coalesce(m{k}::VARCHAR || '%', '') AS m{k}, " for k in range(7))
    + "nr::VARCHAR || '%' AS nr FROM matrix"
)


def oracle_sql() -> dict[str, str]:
    """The DuckDB counterpart of every query."""
    by_month = _OPENINGS_BY_MONTH.format(
        ts="ts", id="user_id", table="events", kind="event_type = 'signup'",
        year=2024, name="aberturas_conta",
    )
    change = _CHANGE.format(as_of=standins.AS_OF)
    in_order = " SELECT * FROM matrix ORDER BY mes"
    matrix = _FLAGS + _MATRIX + in_order
    bars = "SELECT {x} AS x, n AS height, n::VARCHAR AS label, n / 2 AS label_y"
    by_hour = change + "SELECT * FROM change ORDER BY hora"
    counts = _COUNTS.format(as_of=standins.AS_OF) + "SELECT * FROM counted"
    rollback = (
        "WITH asked AS (SELECT DISTINCT ts::DATE AS as_of FROM events),"
        + _RESOLVED
        + "SELECT as_of::VARCHAR AS as_of, k, d0::VARCHAR AS d0, day::VARCHAR AS day FROM resolved"
    )
    return {
        "openings_by_month": by_month,
        "openings_by_month_orders": _OPENINGS_BY_MONTH.format(
            ts="o_orderdate", id="o_custkey", table="orders", kind="o_orderstatus = 'F'",
            year=1998, name="n",
        ),
        "openings_by_hour": _OPENINGS_BY_HOUR,
        "spine_densify": """
            SELECT h::INTEGER AS hora,
                   count(DISTINCT o_custkey) FILTER (hour(o_orderdate) = h)::BIGINT AS n
            FROM range(24) AS hours(h), orders GROUP BY h
        """,
        "business_day_rollback": rollback,
        "business_day_rollback_stored": rollback,
        "lookback_counts": counts,
        "lookback_counts_partitioned": counts,
        "hourly_change": by_hour,
        "hourly_change_pruned": by_hour,
        "hourly_change_kept": by_hour,
        "openings_from_bitmaps": by_month,
        "openings_from_numbers": by_month,
        "openings_of_buckets": by_month,
        "cohort_matrix_from_deltas": matrix,
        "cohort_matrix_salted": matrix,
        "cohort_matrix_published": matrix,
        "cohort_matrix_sorted_out": matrix,
        "quarantined_lines": _FLAGS
        + _MATRIX
        + " SELECT 'cohort_matrix' AS relatorio, mes || ',?' AS linha FROM matrix",
        "hourly_change_monday": _CHANGE.format(as_of=standins.AS_OF_MONDAY)
        + "SELECT * FROM change ORDER BY hora",
        "profile_flags_by_gap": _FLAGS + "SELECT * FROM flags",
        "cohort_matrix": matrix,
        "cohort_matrix_text": _FLAGS + _MATRIX + _MATRIX_TEXT,
        "openings_by_hour_partitioned": _OPENINGS_BY_HOUR,
        "cohort_matrix_sparse": _SPARSE_FLAGS + _MATRIX + in_order,
        "cohort_matrix_stray_text": _SPARSE_FLAGS + _MATRIX + _MATRIX_TEXT,
        "lookback_bars": _COUNTS.format(as_of=standins.AS_OF)
        + bars.format(x="hora") + " FROM counted WHERE k = 1",
        "change_series": change
        + "SELECT hora, 'DU3' AS series, du3 AS value FROM change "
        + "UNION ALL SELECT hora, 'DU7', du7 FROM change "
        + "UNION ALL SELECT hora, 'DU30', du30 FROM change",
        "month_bars": bars.format(x="mes")
        + f" FROM (SELECT mes, aberturas_conta AS n FROM ({by_month}))",
        "hour_bars": bars.format(x="hora")
        + f" FROM (SELECT hora, aberturas_conta AS n FROM ({_OPENINGS_BY_HOUR}))",
        "report_roundtrip": matrix,
    } | _optional("oracle_sql")
