"""The cohort matrix: flags, gaps, null against zero, rounding."""

import random
from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from frames import clients, tuples
from test_days import expected_months
from vestibule.functions.measures import percent
from vestibule.operators.cohorts import completion_matrix, flagged_clients, profile_flags_by_gap
from vestibule.plans.onboarding import cohort_matrix
from vestibule.sources import schemas


def matrix(spark, rows):
    result = cohort_matrix(clients(spark, rows))
    assert result.columns == ["mes", "m0", "m1", "m2", "m3", "m4", "m5", "m6", "nr"]
    return {row[0]: row[1:] for row in tuples(result)}


def test_null_update_counts_in_the_denominator_only(spark):
    rows = [("2023-08-01", None, "Moderado"), ("2023-08-01", "2023-08-02", "Arrojado")]
    assert matrix(spark, rows) == {8: (50.0, *[None] * 6, 0.0)}


def test_a_seen_gap_without_known_profile_is_zero_and_an_unseen_gap_null(spark):
    rows = [("2023-08-01", "2023-11-02", None), ("2023-08-01", "2023-08-02", "Conservador")]
    assert matrix(spark, rows) == {8: (50.0, None, None, 0.0, None, None, None, 50.0)}


def test_gaps_outside_the_buckets(spark):
    rows = [
        ("2023-08-20", "2023-08-01", "Moderado"),  # up to a month before: gap 0
        ("2023-08-20", "2023-05-01", "Moderado"),  # gap -3: no column
        ("2023-08-20", "2024-03-20", "Moderado"),  # gap 7: no column
        ("2023-08-20", "2024-02-20", "Moderado"),  # gap 6
    ]
    assert matrix(spark, rows) == {8: (25.0, *[None] * 5, 25.0, 0.0)}


def test_profiles_of_neither_kind(spark):
    assert matrix(spark, [("2023-08-01", "2023-08-02", "Outro")]) == {8: (None,) * 8}
    rows = [("2023-08-01", "2023-08-02", "Outro"), ("2023-08-01", "2023-08-02", "Sem Perfil")]
    assert matrix(spark, rows) == {8: (0.0, *[None] * 6, 100.0)}


def test_profile_texts_are_searched_inside(spark):
    rows = [
        ("2023-08-01", "2023-08-02", "Perfil Moderado (2)"),
        ("2023-08-01", "2023-08-02", "Cliente Sem Perfil definido"),
        ("2023-08-01", "2023-08-02", "moderado"),  # case counts
        ("2023-08-01", "2023-08-02", "Sem Perfil / Arrojado"),  # both flags
    ]
    assert matrix(spark, rows)[8] == (50.0, *[None] * 6, 50.0)


def test_filters(spark):
    rows = [
        ("2023-06-30T23:59:59", "2023-07-01", "Moderado"),
        ("2023-07-01", "2023-07-01", "Moderado"),
        ("2023-07-01", "2023-07-01", None, "J"),
    ]
    assert matrix(spark, rows) == {7: (100.0, *[None] * 6, 0.0)}


def test_equal_months_of_different_years_fall_together(spark):
    rows = [("2023-07-05", "2023-07-06", "Moderado"), ("2024-07-05", "2024-07-06", None)]
    assert matrix(spark, rows) == {7: (50.0, *[None] * 6, 50.0)}


def test_ties_round_half_up(spark):
    rows = [("2023-08-01", "2023-08-02", "Moderado")] * 23 + [("2023-08-01", None, None)] * 137
    assert matrix(spark, rows)[8][0] == 14.38


def shares():
    """Small totals in full, and large ones with shares as near to a tie as they get."""
    for d in range(1, 401):
        for n in range(0, d + 1, max(1, d // 40)):
            yield n, d
    rng = random.Random(5)
    for _ in range(20_000):
        d = rng.randrange(10**6, 5 * 10**11)
        tie = rng.randrange(10_000) * 2 + 1  # in units of 0.005
        yield min(d, d * tie // 20_000 + rng.choice([0, 1])), d


def test_every_share_rounds_exactly(spark):
    df = spark.createDataFrame(list(shares()), "n bigint, d bigint")
    for n, d, got in tuples(df.select("n", "d", percent(F.col("n"), F.col("d")))):
        hundredths = (20_000 * n + d) // (2 * d)  # half up, in integers
        assert Decimal(str(got)) == Decimal(hundredths) / 100, (n, d)


def random_clients(spark, n, seed):
    rng = random.Random(seed)
    profiles = [None, "Sem Perfil", "Conservador", "Moderado", "Arrojado", "Outro"]
    rows = []
    for _ in range(n):
        made = datetime(2023, 6, 1) + timedelta(days=rng.randrange(500), seconds=rng.randrange(86400))
        updated = made + timedelta(days=rng.randrange(-60, 300), seconds=rng.randrange(86400))
        # A third of all clients share one creation day and one update day.
        if rng.random() < 1 / 3:
            made, updated = datetime(2023, 9, 30), datetime(2023, 11, 30, 5)
        updated = None if rng.random() < 0.1 else updated
        rows.append((made, updated, rng.choice(profiles), rng.choice("FFFJ")))
    return rows, spark.createDataFrame(rows, schemas.CLIENTS).repartition(8)


def expected_flags(rows):
    flags = defaultdict(lambda: [0, 0])
    for made, updated, profile, kind in rows:
        if kind == "F" and made >= datetime(2023, 7, 1):
            gap = None if updated is None else expected_months(made, updated)
            cell = flags[made.month, gap]
            cell[0] += profile in (None, "Sem Perfil")
            cell[1] += profile in ("Conservador", "Moderado", "Arrojado")
    return {(*key, *value) for key, value in flags.items()}


def test_flags_against_brute_force(spark):
    rows, df = random_clients(spark, 6000, 11)
    result = tuples(profile_flags_by_gap(flagged_clients(df)))
    assert len(result) == len(set(result))
    assert set(result) == expected_flags(rows)


def test_matrix_against_brute_force_from_clients_and_from_sums(spark):
    rows, df = random_clients(spark, 3000, 12)
    flags = expected_flags(rows)
    expected = {}
    for mes in sorted({f[0] for f in flags}):
        of_month = [f for f in flags if f[0] == mes]
        total = sum(f[2] + f[3] for f in of_month)
        by_gap = {f[1]: f[3] for f in of_month}

        def share(part):
            exact = Decimal(100 * part) / Decimal(total)
            return float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))

        cells = [share(by_gap[k]) if k in by_gap else None for k in range(7)]
        expected[mes] = (*cells, share(sum(f[2] for f in of_month)))
    flagged = flagged_clients(df, date(2023, 7, 1))
    for flags in (flagged, profile_flags_by_gap(flagged)):
        assert {row[0]: row[1:] for row in tuples(completion_matrix(flags))} == expected
    assert tuples(cohort_matrix(df)) == [(mes, *cells) for mes, cells in expected.items()]
