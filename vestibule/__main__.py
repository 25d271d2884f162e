"""``spark-submit`` entry point: run all reports for one day."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from vestibule.operators.cohorts import SINCE
from vestibule.plans.kept import run_kept_reports
from vestibule.plans.pipeline import run_reports
from vestibule.sources import schemas
from vestibule.sources.tables import read_table


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="vestibule", description=__doc__)
    parser.add_argument("--events", required=True, help="event log: Parquet path or table")
    parser.add_argument("--calendar", required=True, help="calendar: Parquet path or table")
    parser.add_argument("--clients", required=True, help="client view: Parquet path or table")
    parser.add_argument("--out", required=True, help="folder the reports are written to")
    parser.add_argument("--as-of", required=True, type=date.fromisoformat, help="run date")
    parser.add_argument("--since", default=SINCE, type=date.fromisoformat)
    parser.add_argument(
        "--partition", help="date column the event log is partitioned by: the event's date"
    )
    parser.add_argument(
        "--late-days",
        type=int,
        default=0,
        help="days by which that column may lie after the event's date",
    )
    parser.add_argument(
        "--state",
        help="folder with what earlier runs have read: only new days are read, and all reports"
        " are published at once",
    )
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("vestibule").getOrCreate()
    tables = (
        read_table(spark, args.events, schemas.EVENT_LOG, args.partition),
        read_table(spark, args.calendar, schemas.CALENDAR),
        read_table(spark, args.clients, schemas.CLIENTS),
    )
    stored = {"since": args.since, "partition": args.partition, "late_days": args.late_days}
    if args.state:
        run_kept_reports(*tables, args.as_of, args.out, args.state, **stored)
    else:
        run_reports(*tables, args.as_of, args.out, **stored)


if __name__ == "__main__":
    main()
