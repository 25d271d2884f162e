"""Calendar predicates and date arithmetic."""

import random
from calendar import monthrange
from datetime import date, datetime, timedelta
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from frames import at, event_log, tuples
from vestibule.functions.days import hop_back, in_year, on_days, whole_months


def months(spark, pairs):
    df = spark.createDataFrame(pairs, "i int, earlier timestamp_ntz, later timestamp_ntz")
    gap = whole_months(F.col("later"), F.col("earlier"))
    return [row.gap for row in df.select("i", gap.alias("gap")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "earlier, later, expected",
    [
        ("2024-01-31", "2024-02-29T10:00", 1),  # both month ends
        ("2024-02-29", "2024-03-30", 1),  # 1.03, not both month ends
        ("2024-01-15T01:00", "2024-02-15T23:00", 1),
        ("2024-01-15T23:00", "2024-02-15T01:00", 1),  # same day: time ignored
        ("2024-01-15", "2024-02-14T23:59:59.999", 0),
        ("2024-01-20", "2024-01-01", 0),  # up to a month before
        ("2024-01-20", "2023-11-01", -2),
        ("2024-01-20", None, None),
    ],
)
def test_whole_months(spark, earlier, later, expected):
    assert months(spark, [(0, at(earlier), later and at(later))]) == [expected]


def expected_months(earlier, later):
    whole = (later.year - earlier.year) * 12 + later.month - earlier.month
    last = [monthrange(t.year, t.month)[1] == t.day for t in (earlier, later)]
    if earlier.day == later.day or all(last):
        return whole
    second = [t.hour * 3600 + t.minute * 60 + t.second for t in (earlier, later)]
    rest = Fraction((later.day - earlier.day) * 86400 + second[1] - second[0], 86400 * 31)
    return int(whole + rest)


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Pacific/Apia"])
def test_whole_months_against_exact_arithmetic(spark, zone):
    """In any session time zone: clocks changed in these years, in Apia by a whole day."""
    rng = random.Random(7)
    start = datetime(2011, 10, 1) if zone == "Pacific/Apia" else datetime(2017, 9, 1)
    pairs = []
    for i in range(5000):
        earlier = start + timedelta(days=rng.randrange(900), seconds=rng.randrange(86400))
        # Many near-whole gaps, where cutting and rounding disagree.
        shift = rng.choice([rng.randrange(-400, 900), 31 * rng.randrange(-3, 9)])
        later = earlier + timedelta(days=shift, seconds=rng.randrange(-2, 3))
        pairs.append((i, earlier, later))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert months(spark, pairs) == [expected_months(a, b) for _, a, b in pairs]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("weekday", range(1, 8))
@pytest.mark.parametrize(
    "flag, holiday", [("True", True), ("False", False), ("true", False), (None, False)]
)
def test_hop_back(spark, weekday, flag, holiday):
    df = spark.createDataFrame([(weekday, flag)], "weekday int, flag string")
    expected = {7: 2, 6: 1}.get(weekday, 1 if holiday else 0)
    assert tuples(df.select(hop_back(F.col("weekday"), F.col("flag")))) == [(expected,)]


def test_on_days_is_half_open(spark):
    log = event_log(
        spark,
        [
            ("2024-01-09T23:59:59.999999", 1),
            ("2024-01-10", 2),
            ("2024-01-10T23:59:59.999999", 3),
            ("2024-01-11", 4),
            ("2024-01-13T12:00", 5),
        ],
    )
    days = [date(2024, 1, 13), date(2024, 1, 10), date(2024, 1, 10)]
    hit = log.filter(on_days(F.col("dt_ocorrencia"), days))
    assert sorted(row.cd_cpfcgc for row in hit.collect()) == [2, 3, 5]
    assert log.filter(on_days(F.col("dt_ocorrencia"), [])).count() == 0


def test_in_year_is_half_open(spark):
    log = event_log(
        spark,
        [("2023-12-31T23:59:59", 1), ("2024-01-01", 2), ("2024-12-31T23:00", 3), ("2025-01-01", 4)],
    )
    hit = log.filter(in_year(F.col("dt_ocorrencia"), 2024))
    assert sorted(row.cd_cpfcgc for row in hit.collect()) == [2, 3]
