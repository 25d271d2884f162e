"""Chart and table frames."""

from frames import tuples
from vestibule.operators.frames import bar_frame, drop_stray_columns, format_matrix, series_frame
from vestibule.plans.pipeline import change_series, hour_bars, month_bars
from vestibule.sources import schemas


def test_bars_carry_their_value_at_half_height(spark):
    df = spark.createDataFrame([(1, 7), (2, 0), (3, None)], "mes int, aberturas_conta bigint")
    kept = [(1, 7, "7", 3.5), (2, 0, "0", 0.0)]
    assert tuples(month_bars(df)) == kept
    assert month_bars(df).columns == ["x", "height", "label", "label_y"]
    everything = hour_bars(df.withColumnRenamed("mes", "hora"))
    assert tuples(everything) == [*kept, (3, None, None, None)]
    assert tuples(bar_frame(df, "mes", "aberturas_conta", skip_null=True)) == kept


def test_series_are_long_and_keep_nulls(spark):
    df = spark.createDataFrame([(0, 0.5, None, -1.0)], "hora int, du3 double, du7 double, du30 double")
    points = [(0, "DU3", 0.5), (0, "DU7", None), (0, "DU30", -1.0)]
    assert tuples(change_series(df)) == points
    assert change_series(df).columns == ["hora", "series", "value"]
    assert tuples(series_frame(df, "hora", {"du7": "a"})) == [(0, "a", None)]


def test_matrix_text(spark):
    row = (1, 12.5, 5.0, None, 0.0, 100.0, 14.38, None, 33.33)
    rows = [row, (12, *[None] * 8), (13, *[1.0] * 8)]
    df = spark.createDataFrame(rows, schemas.COHORT_MATRIX)
    text = format_matrix(df)
    assert text.columns == df.columns
    assert tuples(text) == [
        ("Jan", "12.5%", "5.0%", "", "0.0%", "100.0%", "14.38%", "", "33.33%"),
        ("Dez", *[""] * 7, None),
        (None, *["1.0%"] * 8),
    ]


def test_matrix_text_labels_every_month(spark):
    df = spark.createDataFrame([(m, 1.0) for m in range(1, 13)], "mes int, nr double")
    labels = [row[0] for row in tuples(format_matrix(df))]
    assert labels == "Jan Fev Mar Abr Mai Jun Jul Ago Set Out Nov Dez".split()


def test_stray_columns_are_dropped(spark):
    df = spark.createDataFrame([(1, 5, 2.0, "x")], "MES int, M0 int, NR double, `Unnamed: 9` string")
    assert drop_stray_columns(df).columns == ["MES", "M0", "NR"]
    text = format_matrix(df)
    assert text.columns == ["mes", "m0", "nr"]
    assert tuples(text) == [("Jan", "5.0%", "2.0%")]
