import random
import zlib

import numpy as np
import pytest
from cases import frame, prose
from pyspark.sql import functions as F

from vestibule.llm import quality_pu as pu


def corpus(n=900, seed=1):
    """Prose and junk; labels for about half, as ``(rows, labels, quality)``."""
    rng = random.Random(seed)
    rows, quality = [], {}
    for i in range(n):
        text, good = prose(rng, rng.randrange(5, 80)), rng.random() < 0.8
        if not good:
            text = rng.choice(
                (
                    lambda: text.upper() + "!!",
                    lambda: " ".join(f"{w}$$$" for w in text.split()),
                    lambda: " | ".join(text.split()),
                    lambda: " ".join(text.split()[:2] * 40),
                )
            )()
        rows.append((i, text))
        quality[i] = int(good)
    labels = [(i, quality[i], 0) for i in range(n) if rng.random() < 0.5]
    return rows, labels, quality


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def label_frame(spark, labels):
    return spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows, labels, quality = corpus()
    docs = frame(spark, rows + [(5000, None), (5001, ""), (5000, None)])
    got = pu.score_quality(docs, pu.fit_quality(docs, label_frame(spark, labels))).collect()
    assert len(got) == len(rows) + 3
    right = total = 0
    for row in got:
        assert row.held_out == held_out(row.doc_id)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
        if row.held_out and row.doc_id in quality:
            total += 1
            right += row.predicted == quality[row.doc_id]
    assert right / total > 0.95
    empty = {r.score for r in got if r.doc_id >= 5000}
    assert len(empty) == 1


def test_held_out_labels_are_never_read(spark):
    rows, labels, _ = corpus(200)
    docs = frame(spark, rows)
    flipped = [(i, 1 - q if held_out(i) else q, t) for i, q, t in labels]
    models = [pu.fit_quality(docs, label_frame(spark, x)) for x in (labels, flipped)]
    assert np.array_equal(models[0].weights, models[1].weights)
    assert models[0].prior == models[1].prior


def test_sample_is_bounded_and_prior_counts_all(spark):
    rows, labels, quality = corpus(300)
    docs = frame(spark, rows)
    model = pu.fit_quality(docs, label_frame(spark, labels), max_positives=20, max_unlabelled=30)
    known = [q for i, q, _ in labels if not held_out(i)]
    assert model.prior == pytest.approx(sum(known) / len(known))


def test_nothing_to_learn_from(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    none = label_frame(spark, [])
    scores = {r.score for r in pu.score_quality(docs, pu.fit_quality(docs, none)).collect()}
    assert scores == {0.5}
    odd = label_frame(spark, [(1, None, 0), (None, 1, 0), (7, 5, 0), (99, 1, 1)])
    assert pu.fit_quality(docs, odd).prior == 0.5
    assert pu.score_quality(frame(spark, []), pu.fit_quality(frame(spark, []), none)).count() == 0


def test_keep_quality_keeps_columns(spark):
    rows, labels, quality = corpus()
    docs = frame(spark, rows).withColumn("score", F.lit("mine"))
    model = pu.fit_quality(docs, label_frame(spark, labels))
    kept = pu.keep_quality(docs, model)
    assert kept.columns == docs.columns
    scored = {r.doc_id for r in pu.score_quality(docs, model).collect() if r.predicted}
    assert {r.doc_id for r in kept.collect()} == scored


def rest_of_risk(model, positive, unlabelled):
    at = [
        pu._standard(rows, model.mean, model.scale) @ model.weights + model.bias
        for rows in (unlabelled, positive)
    ]
    return np.logaddexp(0, at[0]).mean() - model.prior * np.logaddexp(0, at[1]).mean()


def test_negative_risk_is_taken_back(monkeypatch):
    """With more weights than rows the unbiased risk can fall without bound; it is held near 0."""
    rng = np.random.default_rng(0)
    positive, unlabelled = rng.normal(1, 1, (30, 60)), rng.normal(0, 1, (40, 60))
    held = [rest_of_risk(pu.fit_nn_pu(positive, unlabelled, 0.5, n), positive, unlabelled) for n in (800, 3000)]
    assert min(held) > -1
    monkeypatch.setattr(pu, "BACK", -1.0)  # follow the negative part down instead
    assert rest_of_risk(pu.fit_nn_pu(positive, unlabelled, 0.5), positive, unlabelled) < -100


def test_features_cover_the_whole_text():
    plain = b"word other " * 1000
    assert not np.array_equal(pu.features(plain), pu.features(plain + b"$$$ " * 300))
    assert not pu.features(b"").any()
    assert np.isfinite(pu.features(b"\n")).all()


def plain_nn_pu(positive, unlabelled, prior, rounds):
    """The same risk step by step: gradients by the chain rule, row by row."""
    mean, scale = unlabelled.mean(0), unlabelled.std(0)
    p, u = (np.c_[np.clip((x - mean) / scale, -8, 8), np.ones(len(x))] for x in (positive, unlabelled))
    w, m, v = np.zeros(p.shape[1]), 0, 0
    w[-1] = np.log(prior / (1 - prior))
    kept = []
    for step in range(1, rounds + 1):
        as_positive = np.mean([-x / (1 + np.exp(x @ w)) for x in p], axis=0)
        p_negative = np.mean([x / (1 + np.exp(-(x @ w))) for x in p], axis=0)
        u_negative = np.mean([x / (1 + np.exp(-(x @ w))) for x in u], axis=0)
        risk_p, risk_u = (np.mean([np.log1p(np.exp(x @ w)) for x in rows]) for rows in (p, u))
        rest = u_negative - prior * p_negative
        slope = prior * as_positive + rest if risk_u >= prior * risk_p else -0.1 * rest
        slope = slope + np.append(1e-4 * w[:-1], 0)
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        w = w - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        kept.append(w)
    return np.mean(kept[-200:], axis=0)


def test_fit_equals_a_plain_one():
    """Both come to one optimum; the first steps of the bias have slope 0 and go either way."""
    rng = np.random.default_rng(7)
    positive = rng.normal(0.2, 1, (300, 3))
    unlabelled = np.concatenate([rng.normal(0.2, 1, (200, 3)), rng.normal(-0.2, 1, (300, 3))])
    model = pu.fit_nn_pu(positive, unlabelled, 0.4, 500)
    want = plain_nn_pu(positive, unlabelled, 0.4, 500)
    assert rest_of_risk(model, positive, unlabelled) > 0.05
    assert np.allclose(np.append(model.weights, model.bias), want, atol=5e-3)


def test_a_repeated_id_gives_the_same_model_in_any_partitioning(spark):
    rows, labels, _ = corpus(150)
    repeated = next(i for i, q, _ in labels if q == 1 and not held_out(i))
    rng = random.Random(2)
    rows += [(repeated, prose(rng, 30)) for _ in range(1000)] + [(None, "x y"), (3, None)]
    models = [
        pu.fit_quality(frame(spark, rows, n), label_frame(spark, labels), 30, 60) for n in (1, 7)
    ]
    for name in ("weights", "mean", "scale"):
        assert np.array_equal(*(getattr(model, name) for model in models))
    learned = [pu.features((t or "").encode()) for i, t in rows if i is not None and not held_out(i)]
    assert np.allclose(models[0].mean, np.mean(learned, axis=0), atol=1e-5)


def test_very_long_texts(spark, monkeypatch):
    rows, labels, _ = corpus(60)
    rows += [(900, "word " * 700_000), (901, "x" * 100_000)]
    docs = frame(spark, rows)
    scores = pu.score_quality(docs, pu.fit_quality(docs, label_frame(spark, labels))).collect()
    assert len(scores) == 62 and all(0 <= r.score <= 1 for r in scores)
    text = b"ab cd, EF 1\n" * 400
    whole = pu.features(text)
    monkeypatch.setattr(pu, "PIECE", 100)
    assert np.array_equal(pu.features(text), whole)
