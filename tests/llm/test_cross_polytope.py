import numpy as np
import pytest
from pyspark.sql import functions as F

from vestibule.llm import cross_polytope as cp

SCHEMA = "vec_id bigint, embedding array<float>, score string, code string"


def frame(spark, ids, rows):
    data = [(i, None if r is None else list(map(float, r)), "x", "x") for i, r in zip(ids, rows)]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def exact(ids, rows, queries, k):
    out = {}
    for q in queries:
        score = (rows * rows[ids.index(q)]).sum(1)
        order = sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-score[j], ids[j]))
        out[q] = [(ids[j], score[j]) for j in order[:k]]
    return out


def found(df):
    out = {}
    for row in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row.rank == len(out[row.query_id])
    return out


@pytest.mark.parametrize("unit", [True, False])
def test_recall_against_brute_force(spark, unit):
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(1500, 24)) + np.repeat(rng.normal(size=(15, 24)), 100, 0)
    rows = (rows / np.linalg.norm(rows, axis=1)[:, None] if unit else rows).astype(np.float32).astype(float)
    ids = list(range(1500))
    want = exact(ids, rows, ids[::20], 20)
    got = found(cp.nearest_vectors(frame(spark, ids, rows), F.col("vec_id") % 20 == 0, 20))
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, near in got.items():
        true = dict(exact(ids, rows, [q], 1500)[q])
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        assert all(abs(score - true[v]) < 1e-12 for v, score in near)


def test_hot_vector_in_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(cp, "BLOCK_VECTORS", 7)
    monkeypatch.setattr(cp, "BLOCK_QUERIES", 3)
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(120, 10))
    rows[10:90] = rows[10]
    rows = rows.astype(np.float32).astype(float)
    ids = rng.permutation(1000)[:120].tolist()
    query = F.col("vec_id").isin(ids[::10])
    got = found(cp.nearest_vectors(frame(spark, ids, rows), query, 5, probes=64))
    want = exact(ids, rows, ids[::10], 5)
    for q in want:
        assert [v for v, _ in got[q]] == [v for v, _ in want[q]]


def test_odd_vectors_take_no_part(spark):
    good = [[1.0, 0.0], [0.9, 0.1], [0.5, 0.5], [-1.0, 0.0]]
    ids = [20, 1, 2, 3, 40, 60, 80, 100, 120, None]
    data = [*zip(ids, [*good, None, [], [0.0, 0.0], [float("nan"), 1.0], [float("inf"), 1.0], [1.0, 1.0]])]
    rows = [(i, v, "x", "x") for i, v in data] + [(140, [None, 1.0], "x", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = found(cp.nearest_vectors(df, F.col("vec_id") % 20 == 0, 20))
    assert {q: [v for v, _ in near] for q, near in got.items()} == {20: [1, 2, 3]}
    assert cp.nearest_vectors(df.limit(0), F.col("vec_id") % 20 == 0, 20).count() == 0
    one = frame(spark, [20], [[1.0, 2.0]])
    assert cp.nearest_vectors(one, F.col("vec_id") % 20 == 0, 20).count() == 0
    repeated = frame(spark, [20, 20, 5, 5], [[1.0, 0.0], [1.0, 0.0], [0.5, 0.0], [0.7, 0.0]])
    near = found(cp.nearest_vectors(repeated, F.col("vec_id") % 20 == 0, 20))
    assert [v for v, _ in near[20]] == [5]


def test_pseudo_rotation_keeps_lengths_and_angles():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(40, 16))
    turned = cp.hadamard(rows * rng.choice([-1, 1], 16))
    assert np.allclose(turned @ turned.T, rows @ rows.T)


def test_a_vector_probes_its_own_bucket_first():
    rows = np.random.default_rng(2).normal(size=(50, 20))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    hashes = cp.CrossPolytope(20, 1.0, True, 4, 1)
    assert np.array_equal(hashes.probes(rows, 3)[:, :, 0], hashes.codes(rows))


@pytest.mark.parametrize("lengths", ["one of 2", "one of 10", "wide", "wider"])
def test_recall_with_unequal_lengths(spark, lengths):
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(2000, 64))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    if lengths.startswith("one"):
        rows[17] *= int(lengths.split()[-1])
    else:
        rows *= rng.lognormal(0, 0.5 if lengths == "wide" else 2, 2000)[:, None]
    rows = rows.astype(np.float32).astype(float)
    ids = list(range(2000))
    want = exact(ids, rows, ids[::20], 20)
    got = found(cp.nearest_vectors(frame(spark, ids, rows), F.col("vec_id") % 20 == 0, 20))
    assert all(len(got.get(q, ())) == 20 for q in want)
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_bands_of_doubling_length():
    bands = cp.Bands({-9: 2, 0: 5, 1: 1, 4: 1, 5: 1, 8: 1, 9: 1, 99: 1}, 16, 128)
    steps = (-9, 0, 1, 4, 5, 8, 9, 99)
    assert [bands.of(step) for step in steps] == [0, 0, 1, 1, 2, 2, 3, 3]
    assert bands.most == 64 and bands.filed(99, [5, 6]) == [3 * 128]
    near = [list(range(64))] * 2
    assert [len(found) for found in bands.probed(near)] == [16 + 32 + 64 + 1, 16 + 32 + 64]


@pytest.mark.parametrize("block", [1024, 5])
def test_every_query_gets_all_rows_asked_for(spark, monkeypatch, block):
    """Few vectors in many buckets: what the probed ones lack is found among all."""
    monkeypatch.setattr(cp, "BLOCK_VECTORS", block)
    monkeypatch.setattr(cp, "BLOCK_QUERIES", 1 if block == 5 else block)
    rng = np.random.default_rng(8)
    rows = rng.normal(size=(21, 64))
    rows = (rows / np.linalg.norm(rows, axis=1)[:, None]).astype(np.float32).astype(float)
    for n in (21, 15):
        ids = list(range(n))
        want = exact(ids, rows[:n], ids[::7], 20)
        got = found(cp.nearest_vectors(frame(spark, ids, rows[:n]), F.col("vec_id") % 7 == 0, 20))
        assert {q: [v for v, _ in near] for q, near in got.items()} == {
            q: [v for v, _ in near] for q, near in want.items()
        }


def test_stray_queries_beside_a_cluster(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=64)
    rows = centre / np.linalg.norm(centre) + 0.02 * rng.normal(size=(1000, 64))
    rows[:200:20] = rng.normal(size=(10, 64))
    rows[20] = -centre
    rows = (rows / np.linalg.norm(rows, axis=1)[:, None]).astype(np.float32).astype(float)
    ids = list(range(1000))
    got = found(cp.nearest_vectors(frame(spark, ids, rows), F.col("vec_id") % 20 == 0, 20, probes=4))
    assert {len(got.get(q, ())) for q in ids[::20]} == {20}
    want = exact(ids, rows, [20], 20)
    assert [v for v, _ in got[20]] == [v for v, _ in want[20]]


def test_a_repeated_id_takes_one_place_of_its_block():
    rng = np.random.default_rng(10)
    rows = rng.normal(size=(60, 8))
    rows[:30] = rows[0] * np.linspace(1, 2, 30)[:, None]
    ids = np.concatenate([np.full(30, 3), np.arange(100, 130)])
    query = rows[:1]
    got = cp.best_of(np.array([1]), query, ids, rows, 20)
    score = (rows * query[0]).sum(1)
    best = {}
    for i, s in zip(ids.tolist(), score.tolist()):
        best[i] = max(s, best.get(i, s))
    assert got == [(1, i, s) for i, s in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:20]]
