"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a logistic model that minimises
the non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),

where ``R_p`` and ``R_u`` are mean losses over positives and unlabelled rows for
the named label and ``prior`` is the share of positives, estimated from the
labels. Once the second term falls below 0 the step goes the other way, which is
what keeps the model from overfitting the positives.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vestibule.llm.shared import byte_slices, map_arrow, record, small_batches, utf8

HELD_OUT_MOD = 5
KEEP_FROM = 0.3
# Bounds of the sample that the model is fitted on. Scoring reads every row.
FIT_POSITIVES = 10_000
FIT_UNLABELLED = 20_000
# Steps of the fit, of which the last ones are averaged; their size; the share of a
# step that is taken back while the second term is negative; the weight decay; and
# how many deviations a standardised feature may count.
ROUNDS = 800
AVERAGED = 200
STEP = 0.1
BACK = 0.1
DECAY = 1e-4
CLIP = 8.0
# Bytes of a text whose neighbourhoods are counted at a time.
PIECE = 1 << 20
# Features are summed as whole multiples of this, so that the order does not matter.
UNIT = 2.0**-20

# Kinds of bytes whose neighbourhoods describe a text; everything else in ASCII is a kind too.
_KINDS = (
    bytes(range(0x61, 0x7B)),
    bytes(range(0x41, 0x5B)),
    bytes(range(0x30, 0x3A)),
    b" \t",
    b"\n\r",
    b".",
    b",;:",
    b"!?",
    b"|",
    b"*#$%&@^~+=<>",
    b"\"'()[]{}-_/\\`",
    bytes(range(0x80, 0x100)),
)
N_KINDS = len(_KINDS) + 1
_KIND_OF = np.full(256, len(_KINDS), np.int64)
for _i, _bytes in enumerate(_KINDS):
    _KIND_OF[list(_bytes)] = _i
N_FEATURES = N_KINDS * N_KINDS + 7


def features(raw: bytes) -> np.ndarray:
    """Shares of neighbouring byte kinds, length, and how much words and lines repeat.

    The whole text counts. An empty text has only zeros.
    """
    out = np.zeros(N_FEATURES)
    if not raw:
        return out
    pairs = np.zeros(N_KINDS * N_KINDS, np.int64)
    for start in range(0, len(raw), PIECE):
        kinds = _KIND_OF[np.frombuffer(raw[start : start + PIECE + 1], np.uint8)]
        pairs += np.bincount(kinds[:-1] * N_KINDS + kinds[1:], minlength=N_KINDS * N_KINDS)
    out[: N_KINDS * N_KINDS] = np.sqrt(pairs / len(raw))
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line]
    n_words, n_lines = max(1, len(words)), max(1, len(lines))
    distinct = len(set(words))
    out[N_KINDS * N_KINDS :] = (
        np.log1p(len(raw)) / 10,
        np.log1p(len(raw) / n_words) / 2,
        1 - distinct / n_words,
        np.sqrt(sum(map(eq, words, words[1:])) / n_words),
        np.log((n_words + 1) / (distinct + 1)),
        1 - len(set(lines)) / n_lines,
        np.log1p(len(raw) / n_lines) / 10,
    )
    return out


@dataclass
class Model:
    """A logistic model over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(_standard(rows, self.mean, self.scale) @ self.weights + self.bias)


def _standard(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((rows - mean) / scale, -CLIP, CLIP)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_nn_pu(
    positive: np.ndarray,
    unlabelled: np.ndarray,
    prior: float,
    rounds: int = ROUNDS,
    moments: tuple[np.ndarray, np.ndarray] | None = None,
) -> Model:
    """Minimise the non-negative risk with the logistic loss by Adam on whole batches.

    ``moments`` are mean and deviation of the features, by default those of
    ``unlabelled``. Without positives or without unlabelled rows nothing can be learned and every
    score is the prior.
    """
    prior = float(np.clip(prior, 0.01, 0.99))
    n = positive.shape[1]
    bias = float(np.log(prior / (1 - prior)))
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(n), np.ones(n), np.zeros(n), bias, prior)
    mean, scale = moments or (unlabelled.mean(0), unlabelled.std(0))
    scale = np.where(scale < 1e-6, 1.0, scale)

    def with_one(rows: np.ndarray) -> np.ndarray:
        ones = np.ones((len(rows), 1), np.float32)
        return np.hstack([_standard(rows, mean, scale).astype(np.float32), ones])

    p, u = with_one(positive), with_one(unlabelled)
    w = np.zeros(n + 1)
    w[-1] = bias
    m, v, averaged = np.zeros_like(w), np.zeros_like(w), np.zeros_like(w)
    for step in range(1, rounds + 1):
        at_p, at_u = p @ w.astype(np.float32), u @ w.astype(np.float32)
        sp, su = _sigmoid(at_p), _sigmoid(at_u)
        # loss for label +: log(1 + exp(-x)), slope s - 1; for label -: log(1 + exp(x)), slope s
        rest = np.logaddexp(0, at_u).mean() - prior * np.logaddexp(0, at_p).mean()
        slope_rest = u.T @ su / len(u) - prior * (p.T @ sp) / len(p)
        if rest >= 0:
            slope = prior * (p.T @ (sp - 1)) / len(p) + slope_rest
        else:
            slope = -BACK * slope_rest
        slope[:-1] += DECAY * w[:-1]
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope * slope
        w = w - STEP * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        if step > rounds - AVERAGED:
            averaged += w / min(AVERAGED, rounds)
    return Model(mean, scale, averaged[:-1], float(averaged[-1]), prior)


def is_held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text is a multiple of 5."""
    checksum = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(checksum % HELD_OUT_MOD == 0, F.lit(True))


_FEATURE_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("positive", pa.bool_()), ("row", pa.binary())]
)
_SUMS = pa.schema(
    [("feature", pa.int32()), ("n", pa.int64()), ("sum", pa.int64()), ("square", pa.int64())]
)


def _feature_rows(docs: DataFrame) -> DataFrame:
    def read(batches):
        for rows in byte_slices(batches, "raw"):
            found = [features(raw).astype(np.float32).tobytes() for raw in rows["raw"]]
            columns = {"doc_id": rows["doc_id"], "positive": rows["positive"], "row": found}
            yield pa.RecordBatch.from_pydict(columns, schema=_FEATURE_ROWS)

    return map_arrow(docs, read, _FEATURE_ROWS)


def feature_moments(texts: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """Mean and deviation of every feature over all rows of ``(raw)``; none without rows.

    Each task adds its rows up, Spark the tasks; a row per feature reaches the driver.
    """

    def add(batches):
        n, total, square = 0, np.zeros(N_FEATURES, np.int64), np.zeros(N_FEATURES, np.int64)
        for rows in byte_slices(batches, "raw"):
            found = np.array([features(raw) for raw in rows["raw"]])
            n += len(found)
            total += np.rint(found / UNIT).astype(np.int64).sum(0)
            square += np.rint(found * found / UNIT).astype(np.int64).sum(0)
        columns = {"feature": range(N_FEATURES), "n": [n] * N_FEATURES, "sum": total, "square": square}
        yield record(_SUMS, **columns)

    sums = map_arrow(texts, add, _SUMS).groupBy("feature")
    totals = [F.sum(c).alias(c) for c in ("n", "sum", "square")]
    found = sums.agg(*totals).orderBy("feature").collect()
    if not found or not found[0].n:
        return None
    mean, square = (np.array([row[c] / row.n * UNIT for row in found]) for c in ("sum", "square"))
    return mean, np.sqrt(np.maximum(0, square - mean * mean))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    max_positives: int = FIT_POSITIVES,
    max_unlabelled: int = FIT_UNLABELLED,
) -> Model:
    """Fit on a bounded sample of rows that are not held out, drawn by a hash of the id.

    Positives are rows whose label is 1 without a contrary one. Unlabelled are all
    rows, whatever their label; labels serve the positives and the prior alone. Mean and
    deviation of the features are those of all rows that are not held out. Of an id that
    repeats one row is drawn, the same in any partitioning; all its rows count in the
    moments. Null and empty texts count as texts without any feature; very long ones are
    read whole, in bounded pieces. The driver holds at most ``max_positives`` and
    ``max_unlabelled`` rows of features.
    """
    marks = (
        labels.filter(F.col("quality").isin(0, 1) & ~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    known = docs.select("doc_id").filter(~is_held_out(F.col("doc_id"))).distinct()
    labelled = marks.join(known, "doc_id", "left_semi")
    counts = labelled.agg(F.avg("quality").alias("prior")).first()
    prior = 0.5 if counts.prior is None else counts.prior

    def drawn(ids: DataFrame, n: int, salt: int, positive: bool) -> DataFrame:
        order = F.xxhash64("doc_id", F.lit(salt))
        return ids.select("doc_id").orderBy(order, "doc_id").limit(n).select(
            "doc_id", F.lit(positive).alias("positive")
        )

    sample = drawn(labelled.filter("quality = 1"), max_positives, 1, True).unionByName(
        drawn(known, max_unlabelled, 2, False)
    )
    texts = docs.select("doc_id", utf8().alias("raw")).filter(~is_held_out(F.col("doc_id")))
    # At most max_positives + max_unlabelled ids: a bounded broadcast.
    of_sample = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "positive", "raw")
    drawn_rows = _feature_rows(of_sample)
    one = F.min(F.struct(F.xxhash64("row").alias("order"), "row")).alias("least")
    found = drawn_rows.groupBy("doc_id", "positive").agg(one).select("doc_id", "positive", "least.row")
    found = sorted(found.collect(), key=lambda row: row.doc_id)

    def matrix(positive: bool) -> np.ndarray:
        part = b"".join(row.row for row in found if row.positive == positive)
        return np.frombuffer(part, np.float32).reshape(-1, N_FEATURES)

    moments = feature_moments(texts.select("raw"))
    return fit_nn_pu(matrix(True), matrix(False), prior, moments=moments)


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score_quality(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``, from the text alone.

    Null and empty texts get the score of a text without any feature. Equal texts
    get equal scores; repeated rows and ids give a row each; very long texts are read
    whole; other columns are not read. A row without an id counts as held out.
    """

    def score(batches):
        for rows in byte_slices(batches, "raw"):
            found = model.score(np.array([features(raw) for raw in rows["raw"]]))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": rows["doc_id"], "score": found}, schema=_SCORES
            )

    scored = map_arrow(docs.select("doc_id", utf8(F.col(text)).alias("raw")), score, _SCORES)
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= KEEP_FROM, 1).otherwise(0).alias("predicted"),
    )


def keep_quality(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``KEEP_FROM`` or more, with all their columns."""

    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def score(raws: pd.Series) -> pd.Series:
        rows = [features(raw) for raw in raws]
        return pd.Series(model.score(np.array(rows)) if rows else [], dtype="float64")

    return docs.filter(score(utf8(F.col(text))) >= KEEP_FROM)
