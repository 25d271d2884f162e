"""Report files and the whole run."""

import re
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from frames import calendar, physical, tuples
from test_cohorts import random_clients
from test_lookbacks import dates, random_log
from vestibule.__main__ import main
from vestibule.operators.frames import format_matrix
from vestibule.plans.change import change_of, hour_profile, hourly_change, openings_of
from vestibule.plans.onboarding import cohort_matrix
from vestibule.plans.openings import openings_by_hour, openings_by_month
from vestibule.plans.pipeline import change_series, hour_bars, month_bars, run_reports
from vestibule.session import shared_folder
from vestibule.sources import schemas
from vestibule.sources.reports import read_report, write_report
from vestibule.sources.tables import read_table

AS_OF = date(2024, 1, 31)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("inputs")
    log = random_log(spark, 5, 30).withColumn("dia", F.to_date("dt_ocorrencia"))
    log.write.partitionBy("dia").parquet(f"{folder}/events")
    rows = list(dates("2023-11-01", 152, ["2024-01-24"]))
    calendar(spark, rows).write.parquet(f"{folder}/calendar")
    random_clients(spark, 2000, 9)[1].write.parquet(f"{folder}/clients")
    return str(folder)


def test_a_report_comes_back_as_written(spark, tmp_path):
    schema = schemas.COHORT_MATRIX
    rows = [(1, 12.5, None, 0.0, 100.0, 14.38, None, None, 33.33), (2, *[None] * 8)]
    write_report(spark.createDataFrame(rows, schema), str(tmp_path), "cohort_matrix")
    back = read_report(spark, str(tmp_path), "cohort_matrix", schema)
    assert back.schema == schema
    assert sorted(tuples(back), key=lambda r: r[0]) == rows


def test_a_second_run_replaces_the_report(spark, tmp_path):
    schema = schemas.OPENINGS_BY_HOUR
    for n in (5, 6):
        df = spark.createDataFrame([(0, n)], schema)
        write_report(df, str(tmp_path), "openings_by_hour")
    assert tuples(read_report(spark, str(tmp_path), "openings_by_hour", schema)) == [(0, 6)]


def test_reading_a_report_as_another_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([(0, 1)], schemas.OPENINGS_BY_HOUR)
    write_report(df, str(tmp_path), "openings_by_hour")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_report(spark, str(tmp_path), "openings_by_hour", schemas.OPENINGS_BY_MONTH).collect()


def test_upper_case_headers_and_a_stray_column(spark, tmp_path):
    (tmp_path / "upper").mkdir()
    (tmp_path / "upper" / "a.csv").write_text("MES,ABERTURAS_CONTA\n1,4\n")
    back = read_report(spark, str(tmp_path), "upper", schemas.OPENINGS_BY_MONTH)
    assert tuples(back) == [(1, 4)]
    (tmp_path / "stray").mkdir()
    for header in ("Unnamed: 9", ""):
        (tmp_path / "stray" / "a.csv").write_text(f"MES,M0,M1,NR,{header}\n2,12.5,,7,\n")
        stray = spark.read.option("header", True).csv(str(tmp_path / "stray"))
        assert len(stray.columns) == 5
        assert tuples(format_matrix(stray)) == [("Fev", "12.5%", "", "7.0%")]


def test_the_whole_run(spark, inputs, tmp_path):
    out = str(tmp_path / "out")
    main(
        f"--events {inputs}/events --calendar {inputs}/calendar --clients {inputs}/clients "
        f"--out {out} --as-of 2024-01-31 --partition dia".split()
    )
    log = read_table(spark, f"{inputs}/events", schemas.EVENT_LOG)
    months = openings_by_month(log, AS_OF)
    hours = openings_by_hour(log, AS_OF)
    change = hourly_change(log, read_table(spark, f"{inputs}/calendar", schemas.CALENDAR), AS_OF)
    matrix = cohort_matrix(read_table(spark, f"{inputs}/clients", schemas.CLIENTS))
    for name, schema, report, rows in (
        ("openings_by_month", schemas.OPENINGS_BY_MONTH, months, 12),
        ("openings_by_hour", schemas.OPENINGS_BY_HOUR, hours, 24),
        ("hourly_change", schemas.HOURLY_CHANGE, change, 24),
        ("cohort_matrix", schemas.COHORT_MATRIX, matrix, 12),
    ):
        assert len(list(Path(out, name).glob("*.csv"))) == 1, name
        back = tuples(read_report(spark, out, name, schema))
        assert len(back) == rows
        assert back == tuples(report), name
    for name, frame in (
        ("month_bars", month_bars(months)),
        ("hour_bars", hour_bars(hours)),
        ("change_series", change_series(change)),
        ("cohort_matrix_text", format_matrix(matrix)),
    ):
        back = read_report(spark, out, name, frame.schema).fillna("")
        assert sorted(tuples(back)) == sorted(tuples(frame)), name


def test_reports_are_one_file_in_order_under_any_setting(spark, inputs, tmp_path):
    """Without replanning and with many partitions, each report is still one ordered file."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "200"}
    before = {key: spark.conf.get(key) for key in settings}
    clients = read_table(spark, f"{inputs}/clients", schemas.CLIENTS)
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        matrix = cohort_matrix(clients)
        assert "rangepartitioning" not in physical(matrix)
        path = write_report(matrix, str(tmp_path), "matrix")
        assert len(list(Path(path).glob("*.csv"))) == 1
        back = read_report(spark, str(tmp_path), "matrix", schemas.COHORT_MATRIX)
        text = write_report(format_matrix(back), str(tmp_path), "text")
        (file,) = Path(text).glob("*.csv")
        months = [line.split(",")[0] for line in file.read_text().splitlines()[1:]]
        assert months == "Jan Fev Mar Abr Mai Jun Jul Ago Set Out Nov Dez".split()
        shuffled = matrix.repartition(7)
        assert [r.mes for r in format_matrix(shuffled).collect()] == months
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_run_scans_the_log_twice(spark, inputs, tmp_path, monkeypatch):
    scans = []

    def counted(df, folder, name):
        scans.extend(re.findall(r"Location: .*/events", physical(df)))
        return write_report(df, folder, name)

    monkeypatch.setattr("vestibule.plans.pipeline.write_report", counted)
    log = read_table(spark, f"{inputs}/events", schemas.EVENT_LOG)
    table = read_table(spark, f"{inputs}/calendar", schemas.CALENDAR)
    clients = read_table(spark, f"{inputs}/clients", schemas.CLIENTS)
    run_reports(log, table, clients, AS_OF, str(tmp_path / "out"))
    profile = hour_profile(log, table, AS_OF)
    assert len(re.findall(r"Location: .*/events", physical(profile))) == 1
    assert len(scans) == 1  # the months; the hours come from the profile
    assert tuples(openings_of(profile)) == tuples(openings_by_hour(log, AS_OF))
    assert tuples(change_of(profile)) == tuples(hourly_change(log, table, AS_OF))


def test_a_shared_folder_must_be_set(spark, monkeypatch):
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(spark)


def test_read_table_from_the_catalog(spark, inputs):
    read_table(spark, f"{inputs}/calendar", schemas.CALENDAR).withColumn(
        "extra", F.lit(1)
    ).createOrReplaceTempView("calendar_view")
    table = read_table(spark, "calendar_view", schemas.CALENDAR)
    assert table.schema == schemas.CALENDAR
    assert table.count() == 152


def test_a_missing_column_or_a_wrong_type_is_an_error(spark, inputs):
    with pytest.raises(AnalysisException):
        read_table(spark, f"{inputs}/calendar", schemas.CLIENTS)
    spark.range(1).selectExpr(
        "'x' AS calendar_date", "'Monday' AS calendar_iso_weekday", "'True' AS is_holiday"
    ).createOrReplaceTempView("odd_calendar")
    with pytest.raises(AnalysisException):
        read_table(spark, "odd_calendar", schemas.CALENDAR)


def test_other_stored_types_keep_their_filters_on_the_scan(spark, inputs, tmp_path):
    log = read_table(spark, f"{inputs}/events", schemas.EVENT_LOG)
    log.select(
        F.col("DS_OCORRENCIA").alias("DS_OCORRENCIA"),
        F.col("cd_cpfcgc").cast("string").alias("cd_cpfcgc"),
        F.col("dt_ocorrencia").cast("timestamp").alias("dt_ocorrencia"),
    ).write.parquet(f"{tmp_path}/events")
    other = read_table(spark, f"{tmp_path}/events", schemas.EVENT_LOG)
    assert [t for _, t in other.dtypes] == ["timestamp", "string", "string"]
    report = openings_by_hour(other, AS_OF)
    assert "GreaterThanOrEqual(dt_ocorrencia,2024-01-30" in physical(report)
    assert tuples(report) == tuples(openings_by_hour(log, AS_OF))
    assert tuples(openings_by_month(other, AS_OF)) == tuples(openings_by_month(log, AS_OF))


def test_clients_with_plain_dates(spark, inputs, tmp_path):
    stored = read_table(spark, f"{inputs}/clients", schemas.CLIENTS)
    dates_only = stored.withColumns(
        {c: F.to_date(c) for c in ("dt_criacao", "dt_atualiz")}
    )
    dates_only.write.parquet(f"{tmp_path}/clients")
    clients = read_table(spark, f"{tmp_path}/clients", schemas.CLIENTS)
    matrix = cohort_matrix(clients)
    assert "GreaterThanOrEqual(dt_criacao,2023-07-01)" in physical(matrix)
    assert tuples(matrix) == tuples(cohort_matrix(stored))


def test_shared_folders_differ(spark):
    assert shared_folder(spark) != shared_folder(spark)
