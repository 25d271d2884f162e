"""Roll-back of lookbacks and the hourly change built on them."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from frames import calendar, event_log, tuples
from vestibule.operators.lookbacks import (
    fetch_lookbacks,
    lookback_counts,
    resolve_lookbacks,
    resolve_lookbacks_of,
)
from vestibule.plans.change import hourly_change
from vestibule.plans.openings import openings_by_hour
from vestibule.sources import schemas

KS = (1, 3, 7, 30)


def dates(first, days, holidays=(), flag="True"):
    """Calendar rows with the weekdays of the real calendar."""
    for i in range(days):
        day = date.fromisoformat(first) + timedelta(days=i)
        yield (day.isoformat(), day.isoweekday(), flag if day.isoformat() in holidays else "False")


def rolled(rows, as_of, k):
    """The day to read by the written rule, or None."""
    d0 = as_of - timedelta(days=k)
    for text, weekday, flag in rows:
        if text == d0.isoformat():
            hop = 2 if weekday == 7 else 1 if weekday == 6 or flag == "True" else 0
            return d0 - timedelta(days=hop)
    return None


@pytest.mark.parametrize("weekday", range(1, 8))
@pytest.mark.parametrize("flag", ["True", "False", "true"])
@pytest.mark.parametrize("k", KS)
def test_resolve_every_weekday_and_flag(spark, weekday, flag, k):
    as_of = date(2024, 1, 31)
    d0 = as_of - timedelta(days=k)
    table = calendar(spark, [(d0.isoformat(), weekday, flag)])
    hop = {7: 2, 6: 1}.get(weekday, 1 if flag == "True" else 0)
    assert tuples(resolve_lookbacks(table, as_of, KS)) == [(k, d0, d0 - timedelta(days=hop))]


@pytest.mark.parametrize(
    "as_of, expected",
    [
        ("2024-01-31", {1: "2024-01-30", 3: "2024-01-26", 7: "2024-01-23", 30: "2024-01-01"}),
        ("2024-01-29", {1: "2024-01-26", 3: "2024-01-26", 7: "2024-01-22", 30: "2023-12-29"}),
    ],
)
def test_resolve_real_days(spark, as_of, expected):
    table = calendar(spark, list(dates("2023-11-01", 152, ["2024-01-24"])))
    days = fetch_lookbacks(table, date.fromisoformat(as_of), KS)
    assert {k: day.isoformat() for k, day in days.items()} == expected


def test_one_hop_is_not_looked_at_again(spark):
    # Monday holiday: reads Sunday. Sunday after a holiday Friday: reads that Friday.
    rows = list(dates("2024-01-01", 60, ["2024-01-22", "2024-01-26"]))
    table = calendar(spark, rows)
    days = fetch_lookbacks(table, date(2024, 1, 29), KS)
    assert days[7] == date(2024, 1, 21)
    assert days[1] == date(2024, 1, 26)
    assert days[3] == date(2024, 1, 25)


def test_a_missing_date_gives_no_row(spark):
    table = calendar(spark, [r for r in dates("2024-01-01", 31) if r[0] != "2024-01-28"])
    days = fetch_lookbacks(table, date(2024, 1, 31), KS)
    assert sorted(days) == [1, 7, 30]


def test_a_date_listed_twice_is_an_error(spark):
    rows = list(dates("2024-01-01", 31))
    table = calendar(spark, rows + [("2024-01-30", 2, "False")])
    with pytest.raises(PySparkException, match="twice: 2024-01-30"):
        fetch_lookbacks(table, date(2024, 1, 31), KS)
    # Not an error for a run that does not use that date.
    assert len(fetch_lookbacks(table, date(2024, 1, 30), (1, 3, 7))) == 3


def test_resolving_many_days_equals_resolving_each(spark):
    rng = random.Random(3)
    rows = [
        (text, weekday, rng.choice(["True", "False", "False"]))
        for text, weekday, _ in dates("2023-11-20", 110)
        if rng.random() < 0.9
    ]
    table = calendar(spark, rows)
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(60)]
    asked = spark.createDataFrame([(d,) for d in days], "as_of date")
    expected = {
        (as_of, k, as_of - timedelta(days=k), rolled(rows, as_of, k))
        for as_of in days
        for k in KS
        if rolled(rows, as_of, k)
    }
    result = tuples(resolve_lookbacks_of(table, asked, KS))
    assert len(result) == len(expected)
    assert set(result) == expected
    for as_of in days[:5]:
        single = {(as_of, *row) for row in tuples(resolve_lookbacks(table, as_of, KS))}
        assert single == {row for row in expected if row[0] == as_of}


def test_lookbacks_on_the_same_day_both_get_its_counts(spark):
    log = event_log(spark, [("2024-01-26T04:00", 1), ("2024-01-26T04:10", 2), ("2024-01-22T05:00", 1)])
    friday, monday = date(2024, 1, 26), date(2024, 1, 22)
    counts = lookback_counts(log, {1: friday, 3: friday, 7: monday}, "INCLUSAO")
    assert sorted(tuples(counts)) == [(1, 4, 2), (3, 4, 2), (7, 5, 1)]
    assert tuples(lookback_counts(log, {}, "INCLUSAO")) == []


# Wednesday run date; D-1 is the 30th, D-3 rolls to the 26th, D-7 is the 24th.
AS_OF = date(2024, 1, 31)
D1, D3, D7, D30 = "2024-01-30", "2024-01-26", "2024-01-24", "2024-01-01"


def change_by_hour(spark, log, rows=None):
    rows = list(dates("2023-12-01", 62)) if rows is None else rows
    result = hourly_change(event_log(spark, log), calendar(spark, rows), AS_OF)
    assert result.columns == ["hora", "du3", "du7", "du30"]
    got = tuples(result)
    assert [row[0] for row in got] == list(range(24))
    return {row[0]: row[1:] for row in got}


def test_hourly_change_cases(spark):
    log = [(f"{D1}T05:00", None), (f"{D3}T05:00", 7)]  # D-1: only a null id
    log += [(f"{D3}T04:{i:02}", i) for i in range(6)]  # D-1 missing, six ids on D-3
    log += [(f"{D1}T06:{i:02}", i) for i in range(6)]  # six ids on D-1, D-3 missing
    log += [(f"{D1}T07:{i:02}", i) for i in range(4)] + [(f"{D3}T07:30", 1), (f"{D3}T07:31", 1)]
    log += [(f"{D7}T07:{i:02}", i) for i in range(10)] + [(f"{D30}T07:00", None)]
    log += [(f"{D1}T08:00", 1, "ALTERACAO"), ("2024-01-29T08:00", 1), ("2024-01-31T08:00", 1)]
    change = change_by_hour(spark, log)
    assert change[3] == (0.0, 0.0, 0.0)  # nothing on any day
    assert change[4] == (-5.0, 0.0, 0.0)  # base counts as 1
    assert change[5] == (None, None, None)  # base of 0
    assert change[6] == (1.0, 1.0, 1.0)
    assert change[7] == (0.75, -1.5, 1.0)  # a null id on D-30: count 0, not missing
    assert change[8] == (0.0, 0.0, 0.0)  # other types and days do not count


def test_a_lookback_without_calendar_row_is_missing(spark):
    log = [(f"{D1}T04:00", 1), (f"{D3}T04:00", 1), (f"{D7}T04:00", 1)]
    rows = [r for r in dates("2023-12-01", 62) if r[0] != "2024-01-28"]
    assert change_by_hour(spark, log, rows)[4] == (1.0, 0.0, 1.0)
    assert change_by_hour(spark, log, [])[4] == (0.0, 0.0, 0.0)


def random_log(spark, seed, users):
    rng = random.Random(seed)
    first = datetime(2023, 11, 25)
    rows = [
        (
            first + timedelta(seconds=rng.randrange(75 * 86400)),
            rng.choice([None, 1, *range(users)]),
            rng.choice(["INCLUSAO", "INCLUSAO", "ALTERACAO"]),
        )
        for _ in range(20_000)
    ]
    return spark.createDataFrame(rows, schemas.EVENT_LOG).repartition(4)


@pytest.mark.parametrize("seed, users", [(1, 3), (2, 40)])
def test_one_scan_equals_one_scan_per_lookback(spark, seed, users):
    rows = list(dates("2023-11-20", 100, ["2023-12-25", "2024-01-01", "2024-01-24"]))
    rows = [r for r in rows if r[0] not in ("2024-01-11", "2023-12-20")]
    log = random_log(spark, seed, users)
    for as_of in (date(2024, 1, d) for d in (12, 14, 15, 18, 27, 29, 31)):
        perday = {}
        for k in KS:
            day = rolled(rows, as_of, k)
            if day is None:
                perday[k] = {}
                continue
            # The single-day report gives the counts; it cannot tell 0 from missing.
            counts = dict(tuples(openings_by_hour(log, day + timedelta(days=1))))
            seen = log.filter(F.to_date("dt_ocorrencia") == F.lit(day))
            seen = seen.filter("ds_ocorrencia = 'INCLUSAO'").select(F.hour("dt_ocorrencia"))
            hours = {row[0] for row in seen.distinct().collect()}
            perday[k] = {h: counts[h] for h in hours}
        expected = []
        for h in range(24):
            base = perday[1].get(h)
            cells = [h]
            for k in KS[1:]:
                other = perday[k].get(h)
                if base is None and other is None:
                    cells.append(0.0)
                elif base == 0:
                    cells.append(None)
                else:
                    cells.append(1 - (other or 0) / (1 if base is None else base))
            expected.append(tuple(cells))
        assert tuples(hourly_change(log, calendar(spark, rows), as_of)) == expected
