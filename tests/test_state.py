"""Results kept between runs: equal to full runs, and brought up to date by what is new."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from frames import calendar, clients, event_log, physical, scanned_rows, tuples
from test_lookbacks import dates, random_log
from vestibule.operators.cohorts import completion_matrix, flagged_clients, profile_flags_by_gap
from vestibule.plans.change import hourly_change
from vestibule.plans.onboarding import cohort_matrix
from vestibule.plans.openings import openings_by_month
from vestibule.state import bitmaps, cohorts, hours
from vestibule.state.parts import read_parts, replace_parts, stored_parts

AS_OF = date(2024, 1, 31)


def days_of(log):
    rows = log.select(F.to_date("dt_ocorrencia").alias("d")).distinct().collect()
    return sorted(row.d for row in rows)


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    """A log of two years with null ids, ids below zero and far apart, in a file."""
    rng = random.Random(3)
    ids = [None, 0, -1, -32768, -32769, 1, 32768, 32769, 98765432100, 2**62, *range(500, 530)]
    rows = []
    for _ in range(4000):
        day = date(2023, 11, 1) + timedelta(days=rng.randrange(110))
        moment = f"{day} {rng.randrange(24):02}:{rng.randrange(60):02}:00"
        rows.append((moment, rng.choice(ids), [rng.choice(["INCLUSAO", "INCLUSAO", "OUTRO"])]))
    made = event_log(spark, [(m, i, *k) for m, i, k in rows])
    path = f"{tmp_path_factory.mktemp('log')}/events"
    made.withColumn("dia", F.to_date("dt_ocorrencia")).repartition("dia").write.partitionBy(
        "dia"
    ).parquet(path)
    return spark.read.schema(made.schema.add("dia", "date")).parquet(path)


def test_parts_are_replaced_whole_and_others_stay(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert stored_parts(spark, path, "p") == set()
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (9, "z")], "v int, p string")
    replace_parts(first, path, ["a", "b", "c"], "p")
    assert stored_parts(spark, path, "p") == {"a", "b", "c"}  # c has no rows but counts, z was not asked for
    read = lambda: sorted(tuples(read_parts(spark, path, first.schema, "p")))
    assert read() == [(1, "a"), (2, "a"), (3, "b")]
    for _ in range(2):  # doing it again changes nothing
        replace_parts(first.filter("v = 2"), path, ["a"], "p")
        assert read() == [(2, "a"), (3, "b")]
    replace_parts(first.limit(0), path, ["b"], "p")  # a part that has lost all its rows
    assert read() == [(2, "a")]
    replace_parts(first, path, [], "p")
    assert read() == [(2, "a")]


def test_bitmaps_count_as_the_log_does(spark, log, tmp_path):
    path = f"{tmp_path}/bitmaps"
    days = days_of(log)
    for part in (days[:40], days[40:]):
        bitmaps.refresh_bitmaps(log, path, part, partition="dia")
    kept = bitmaps.read_bitmaps(spark, path)
    for as_of in (AS_OF, date(2023, 12, 31), date(2022, 1, 1)):
        assert tuples(bitmaps.openings_from_bitmaps(kept, as_of)) == tuples(openings_by_month(log, as_of))
    of_year = bitmaps.openings_from_bitmaps(kept, AS_OF)
    plan = physical(of_year)
    assert "bitmap" in plan and "cd_cpfcgc" not in plan  # no event is read
    assert "PartitionFilters: [isnotnull(dia" in plan
    of_year.collect()
    read = kept.filter("year(dia) = 2024").count() + len([d for d in days if d.year == 2024])
    assert scanned_rows(of_year) == read  # with a mark per day


def test_one_new_day_touches_one_day(spark, log, tmp_path):
    path, numbers = f"{tmp_path}/bitmaps", f"{tmp_path}/numbers"
    days = days_of(log)
    bitmaps.refresh_bitmaps(log, path, days[:-1], numbers=numbers, partition="dia")
    files = lambda: {
        r.f: r.n
        for r in spark.read.schema(bitmaps.BITMAPS).parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("f"))
        .agg(F.max("_metadata.file_modification_time").alias("n"))
        .collect()
    }
    before = files()
    new_ids = log.filter(F.to_date("dt_ocorrencia") == F.lit(days[-1]))
    bitmaps.refresh_bitmaps(log, path, days[-1:], numbers=numbers, partition="dia")
    after = files()
    assert {f: n for f, n in after.items() if f in before} == before
    assert all(f"dia={days[-1]}" in f for f in after.keys() - before.keys())
    assert new_ids.count() > 0
    kept = bitmaps.openings_from_bitmaps(bitmaps.read_bitmaps(spark, path), AS_OF)
    assert tuples(kept) == tuples(openings_by_month(log, AS_OF))


def test_numbers_are_close_given_once_and_never_change(spark, tmp_path):
    path = f"{tmp_path}/numbers"
    ids = spark.range(0, 40_000, 1, 4).selectExpr("id * 1000003 + 12345678901 AS cd_cpfcgc")
    first = dict(tuples(bitmaps.number_ids(ids.filter("cd_cpfcgc % 2 = 0"), path)))
    again = dict(tuples(bitmaps.number_ids(ids.unionByName(ids), path)))
    assert len(again) == 40_000 == len(set(again.values()))
    assert first.items() <= again.items()
    table = spark.read.schema(bitmaps.NUMBERS).parquet(path)
    marked = ids.select(F.lit(AS_OF).alias("dia"), "cd_cpfcgc")
    apart, close = (bitmaps.day_bitmaps(marked, n).count() for n in (None, table))
    assert apart == 40_000 and close <= 40_000 / 32768 + 2 * spark.sparkContext.defaultParallelism + 2


def test_a_late_event_of_a_stored_day_counts_after_a_refresh(spark, tmp_path):
    path = f"{tmp_path}/bitmaps"
    old = event_log(spark, [("2024-01-05 10:00:00", 1), ("2024-01-06 10:00:00", 1)])
    bitmaps.refresh_bitmaps(old, path, [date(2024, 1, 5), date(2024, 1, 6)])
    new = old.unionByName(event_log(spark, [("2024-01-05 11:00:00", 2), ("2024-01-05 12:00:00", None)]))
    count = lambda: tuples(bitmaps.openings_from_bitmaps(bitmaps.read_bitmaps(spark, path), AS_OF))[0]
    assert count() == (1, 1)
    for _ in range(2):
        bitmaps.refresh_bitmaps(new, path, [date(2024, 1, 5)])
        assert count() == (1, 2)
    bitmaps.refresh_bitmaps(new.limit(0), path, [date(2024, 1, 5), date(2024, 1, 6)])
    assert count() == (1, 0)


def test_kept_hours_equal_full_runs_on_every_day(spark, tmp_path):
    events = random_log(spark, 5, 40)
    table = calendar(spark, list(dates("2023-11-01", 152)))
    path = f"{tmp_path}/hours"
    for as_of in (date(2024, 1, 29) + timedelta(days=k) for k in range(4)):
        kept = hours.hourly_change_kept(events, table, as_of, path)
        assert tuples(kept) == tuples(hourly_change(events, table, as_of))
        assert "ds_ocorrencia" not in physical(kept)  # the log is not read again


def test_a_second_run_reads_one_new_day(spark, log, tmp_path, monkeypatch):
    table = calendar(spark, list(dates("2023-11-01", 152)))
    path, asked, scanned = f"{tmp_path}/hours", [], []
    real = hours.replace_parts

    def counted(rows, where, days, *rest):
        asked.append(list(days))
        if days:
            scanned.append(rows.collect() and scanned_rows(rows))
        real(rows, where, days, *rest)

    monkeypatch.setattr(hours, "replace_parts", counted)
    hours.refresh_hours(log, path, [d for d in days_of(log) if d < date(2024, 1, 16)], partition="dia")
    for as_of in (date(2024, 1, 17), date(2024, 1, 18), date(2024, 1, 18)):
        hours.hourly_change_kept(log, table, as_of, path, partition="dia")
    assert asked[1:] == [[date(2024, 1, 16)], [date(2024, 1, 17)], []]
    per_day = {r.dia: r.n for r in log.groupBy("dia").agg(F.count("*").alias("n")).collect()}
    # Only the partitions of the days that were lacking were read.
    assert scanned == [sum(per_day[d] for d in days) for days in asked if days]
    kept = lambda: sorted(tuples(hours.read_hours(spark, path)), key=str)
    before = kept()
    hours.refresh_hours(log, path, asked[0][-5:] + asked[1], partition="dia")
    assert kept() == before


def test_an_hour_of_null_ids_is_kept_as_one(spark, tmp_path):
    """Null ids only count 0, which is not the same as no event."""
    table = calendar(spark, [(f"2024-01-{d:02}", (d - 1) % 7 + 1, "False") for d in range(1, 31)])
    events = event_log(spark, [("2024-01-10 05:00:00", None), ("2024-01-08 05:00:00", 7), ("2024-01-10 06:00:00", 1)])
    got = hours.hourly_change_kept(events, table, date(2024, 1, 11), f"{tmp_path}/hours")
    assert tuples(got) == tuples(hourly_change(events, table, date(2024, 1, 11)))


def client_rows(seed, n):
    rng = random.Random(seed)
    profiles = [None, "Sem Perfil", "Conservador", "Moderado x", "Outro"]
    rows = []
    for _ in range(n):
        made = date(2023, 5, 1) + timedelta(days=rng.randrange(500))
        updated = made + timedelta(days=rng.randrange(-40, 300)) if rng.random() < 0.8 else None
        rows.append((f"{made} 00:00:00", updated and f"{updated} 00:00:00", rng.choice(profiles), [rng.choice("FFFJ")]))
    return [(a, b, p, *k) for a, b, p, k in rows]


def test_changed_clients_give_the_matrix_of_a_full_run(spark, tmp_path):
    path = f"{tmp_path}/sums"
    rows = client_rows(1, 400)
    state = rows
    deltas = cohorts.cohort_deltas(clients(spark, rows).withColumn("sinal", F.lit(1)))
    cohorts.store_deltas(deltas, path, "base")
    for batch in range(3):
        rng = random.Random(batch)
        gone = set(rng.sample(range(len(state)), 60))
        now = [r for k, r in enumerate(state) if k not in gone] + client_rows(10 + batch, 50)
        before, after = clients(spark, state), clients(spark, now)
        changes = cohorts.signed_changes(before, after)
        assert changes.filter("sinal < 0").agg(F.sum("sinal")).first()[0] >= -60
        for _ in range(2):  # a batch that is stored twice counts once
            cohorts.store_deltas(cohorts.cohort_deltas(changes), path, f"batch {batch}")
        state = now
        sums = cohorts.stored_sums(spark, path)
        assert tuples(cohorts.matrix_from_sums(sums)) == tuples(cohort_matrix(after))
        flags = profile_flags_by_gap(flagged_clients(after))
        assert sorted(tuples(sums.select("mes", "gap", "sem", "com")), key=str) == sorted(tuples(flags), key=str)
    folded = f"{tmp_path}/folded"
    cohorts.fold_batches(spark, path, folded)
    assert stored_parts(spark, folded, "lote") == {"base"}
    whole = cohorts.matrix_from_sums(cohorts.stored_sums(spark, folded))
    assert tuples(whole) == tuples(cohort_matrix(clients(spark, state)))


def test_a_gap_that_has_lost_its_clients_is_empty_and_not_zero(spark, tmp_path):
    """Clients of an unknown profile are in neither sum, yet their gap shows 0 while they are there."""
    path = f"{tmp_path}/sums"
    lone = ("2024-01-10 00:00:00", "2024-04-20 00:00:00", "Outro")
    rows = [("2024-01-10 00:00:00", "2024-01-20 00:00:00", "Moderado"), lone]
    base = clients(spark, rows)
    cohorts.store_deltas(cohorts.cohort_deltas(base.withColumn("sinal", F.lit(1))), path, "base")
    shown = lambda: cohorts.matrix_from_sums(cohorts.stored_sums(spark, path)).first()
    assert (shown().m0, shown().m3) == (100.0, 0.0)
    changes = cohorts.signed_changes(base, clients(spark, rows[:1]))
    cohorts.store_deltas(cohorts.cohort_deltas(changes), path, "gone")
    assert (shown().m0, shown().m3) == (100.0, None)


def test_unchanged_rows_cancel_out(spark):
    rows = client_rows(2, 30)
    both = clients(spark, rows + rows[:3]), clients(spark, rows[::-1])
    changes = cohorts.signed_changes(*both).collect()
    assert sum(r.sinal for r in changes) == -3 and all(r.sinal < 0 for r in changes)
    assert cohorts.signed_changes(both[1], both[1]).count() == 0


def test_sums_with_and_without_counts_give_one_matrix(spark):
    made = clients(spark, client_rows(3, 80))
    deltas = cohorts.cohort_deltas(made.withColumn("sinal", F.lit(1)))
    flags = profile_flags_by_gap(flagged_clients(made))
    order = lambda df: sorted(tuples(df), key=str)
    assert order(completion_matrix(deltas)) == order(completion_matrix(flags))
