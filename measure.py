"""Time the jobs on large made-up inputs, beside the alternatives that README.md compares.

    python measure.py FOLDER [--events 120000000] [--clients 60000000] [--lines 90000000]

Writes the inputs under FOLDER once (a third of the events on one id, a third of the
order lines on one order) and prints seconds per job, the best of ``--runs`` runs.
"""

from __future__ import annotations

import argparse
import sys
import time
from datetime import date, timedelta
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vestibule.functions.days import in_year
from vestibule.operators.cohorts import completion_matrix, flagged_clients
from vestibule.operators.densify import MONTHS, key_spine
from vestibule.operators.lookbacks import fetch_lookbacks, lookback_counts
from vestibule.plans.change import BASE, EARLIER, hourly_change
from vestibule.plans.onboarding import cohort_matrix
from vestibule.plans.openings import OPENING, openings_by_month
from vestibule.session import local_session
from vestibule.sources import bucketed, standins
from vestibule.state import bitmaps, hours

AS_OF = date(2024, 1, 31)


def stamp(first: str, seconds: int):
    second = (F.col("id") * 7919 % seconds).cast("int")
    return F.timestamp_add("SECOND", second, F.expr(f"timestamp_ntz '{first} 00:00:00'"))


def write_inputs(spark: SparkSession, folder: str, events: int, clients: int, lines: int) -> None:
    def write(df: DataFrame, name: str) -> None:
        if not Path(folder, name, "_SUCCESS").exists():
            df.write.mode("overwrite").parquet(f"{folder}/{name}")

    hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id"))
    log = spark.range(events).select(
        stamp("2023-07-01", 86400 * 300).alias("dt_ocorrencia"),
        hot.alias("cd_cpfcgc"),
        F.when(F.col("id") % 4 == 0, "OUTRO").otherwise(OPENING).alias("ds_ocorrencia"),
    )
    write(log, "events")
    profile = F.array(*map(F.lit, ("Sem Perfil", "Moderado", "Arrojado", "Outro")))
    made = stamp("2023-07-01", 86400 * 360)
    people = spark.range(clients).select(
        made.alias("dt_criacao"),
        F.timestamp_add("DAY", (F.col("id") % 250).cast("int"), made).alias("dt_atualiz"),
        F.element_at(profile, (F.col("id") % 4 + 1).cast("int")).alias("perfil"),
        F.lit("F").alias("tp_pessoa"),
    )
    write(people, "clients")
    order = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % (lines // 6))
    shipped = stamp("1998-08-01", 86400 * 200)
    write(spark.range(lines).select(order.alias("l_orderkey"), shipped.alias("l_shipdate")), "lineitem.parquet")
    priority = F.array(*map(F.lit, ("1-URGENT", "2-HIGH", "4-NOT SPECIFIED", "5-LOW")))
    orders = spark.range(lines // 6).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 1000).alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"),
        stamp("1998-07-01", 86400 * 30).alias("o_orderdate"),
        F.element_at(priority, (F.col("id") % 4 + 1).cast("int")).alias("o_orderpriority"),
    )
    write(orders, "orders.parquet")


def months_joined_first(log: DataFrame) -> DataFrame:
    """The month report with the log joined to the months before it is counted."""
    at = F.col("dt_ocorrencia")
    opened = log.filter((F.col("ds_ocorrencia") == OPENING) & in_year(at, AS_OF.year))
    spine = key_spine(log.sparkSession, "mes", MONTHS)
    joined = spine.join(opened.withColumn("mes", F.month(at)), "mes", "left")
    return joined.groupBy("mes").agg(F.count_distinct("cd_cpfcgc").alias("n")).orderBy("mes")


def scan_per_lookback(log: DataFrame, calendar: DataFrame) -> DataFrame:
    """The lookback counts with one scan of the log for each."""
    days = fetch_lookbacks(calendar, AS_OF, (BASE, *EARLIER))
    parts = [lookback_counts(log, {k: day}, OPENING) for k, day in days.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def plain_left_join(spark: SparkSession, folder: str) -> DataFrame:
    """The cohort matrix over an outer join of orders and lines as it stands."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    low = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_custkey") % 2 == 0)
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").select(
        F.col("o_orderdate").alias("dt_criacao"),
        F.col("l_shipdate").alias("dt_atualiz"),
        F.when(low, None).otherwise(F.col("o_orderpriority")).alias("perfil"),
        F.col("o_orderstatus").alias("tp_pessoa"),
    )
    return cohort_matrix(joined, standins.SINCE, **standins.PATTERNS)


def kept_jobs(spark: SparkSession, folder: str, log: DataFrame, calendar: DataFrame) -> dict:
    """The jobs on kept state beside those that read the log; the state is built first, timed."""
    paths = {name: f"{folder}/kept/{name}" for name in ("bitmaps", "numbers", "hours", "log")}
    year = [date(AS_OF.year, 1, 1) + timedelta(days=k) for k in range(120)]
    ks = (BASE, *EARLIER)
    days = sorted(set(fetch_lookbacks(calendar, AS_OF, ks).values()))
    table = "kept_log"

    def bucketed_copy() -> None:
        bucketed.write_bucketed(log, table, 64, paths["log"])

    def unplanned(job):
        """``job`` without replanning and without broadcasts that it does not ask for."""

        def run() -> DataFrame:
            settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
            before = {key: spark.conf.get(key) for key in settings}
            for key, value in settings.items():
                spark.conf.set(key, value)
            try:
                job().collect()
            finally:
                for key, value in before.items():
                    spark.conf.set(key, value)

        return run

    def lined(rows_per_task: int | None) -> DataFrame:
        clients = standins.clients(spark, folder, rows_per_task)
        return cohort_matrix(clients, standins.SINCE, **standins.PATTERNS)

    return {
        "bitmaps of 120 days": lambda: bitmaps.refresh_bitmaps(
            log, paths["bitmaps"], year, numbers=paths["numbers"]
        ),
        "bitmaps of one new day": lambda: bitmaps.refresh_bitmaps(
            log, paths["bitmaps"], year[-1:], numbers=paths["numbers"]
        ),
        "openings_by_month from bitmaps": lambda: bitmaps.openings_from_bitmaps(
            bitmaps.read_bitmaps(spark, paths["bitmaps"]), AS_OF
        ),
        "openings_by_month from the log": lambda: openings_by_month(log, AS_OF),
        "hours of four days": lambda: hours.refresh_hours(log, paths["hours"], days),
        "hourly_change from kept hours": lambda: hours.change_from_hours(
            hours.read_hours(spark, paths["hours"]), calendar, AS_OF
        ),
        "hourly_change from the log": lambda: hourly_change(log, calendar, AS_OF),
        "bucketed copy of the log": bucketed_copy,
        "openings_by_month from buckets": lambda: bucketed.openings_of_buckets(
            spark.table(table), AS_OF
        ),
        "cohort_matrix, hot order salted, no replanning": unplanned(lambda: lined(1_000_000)),
        "cohort_matrix, hot order as it is, no replanning": unplanned(lambda: lined(None)),
    }


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("folder")
    parser.add_argument("--events", type=int, default=120_000_000)
    parser.add_argument("--clients", type=int, default=60_000_000)
    parser.add_argument("--lines", type=int, default=90_000_000)
    parser.add_argument("--runs", type=int, default=3)
    parser.add_argument("--kept", action="store_true", help="time the jobs on kept state instead")
    args = parser.parse_args()
    spark = local_session("measure", "8", **{"spark.driver.memory": "8g"})
    write_inputs(spark, args.folder, args.events, args.clients, args.lines)
    log, clients = (spark.read.parquet(f"{args.folder}/{name}") for name in ("events", "clients"))
    calendar = standins.calendar(spark)
    lined = lambda: standins.clients(spark, args.folder)
    jobs = {
        "openings_by_month": lambda: openings_by_month(log, AS_OF),
        "openings_by_month, log joined first": lambda: months_joined_first(log),
        "hourly_change": lambda: hourly_change(log, calendar, AS_OF),
        "lookbacks, a scan for each": lambda: scan_per_lookback(log, calendar),
        "cohort_matrix": lambda: cohort_matrix(clients),
        "cohort_matrix, by month at once": lambda: completion_matrix(flagged_clients(clients)),
        "cohort_matrix over lines": lambda: cohort_matrix(lined(), standins.SINCE, **standins.PATTERNS),
        "cohort_matrix over lines, plain left join": lambda: plain_left_join(spark, args.folder),
    }
    if args.kept:
        jobs = kept_jobs(spark, args.folder, log, calendar)
    for name, job in jobs.items():
        seconds = []
        for _ in range(args.runs):
            start = time.perf_counter()
            report = job()
            if report is not None:
                report.collect()
            seconds.append(time.perf_counter() - start)
        print(f"{name}: {min(seconds):.1f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
