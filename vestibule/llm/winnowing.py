"""Benchmark decontamination by winnowing.

Of every window of neighbouring k-gram hashes the smallest is kept. Two texts
that share a run of as many words as a benchmark window share such a whole
window of hashes and so keep the same k-gram: joining the kept fingerprints of
both sides finds every shared run, and extending each hit word by word to both
sides gives the run itself.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vestibule.llm.shared import byte_slices, map_arrow, slices, utf8, written
from vestibule.llm.words import ALNUM, Words, grams, mix, words_of

WINDOW = 13
GRAM = 5
# Share of a text's words that must be hit, as 1 in so many.
CONTAMINATED_ONE_IN = 20
# Bits of the filter that spares most fingerprints of clean texts the join. It is
# of fixed size, whatever the benchmark's; a false positive falls out of the join.
FILTER_BITS = 1 << 23
_BUCKET = 1 << 15


def winnow(hashes: np.ndarray, window: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of the kept k-grams for runs of ``window`` words.

    ``gram`` is cut to the window. Of equal smallest hashes the first is kept.
    """
    k = min(gram, window)
    found = grams(hashes, k)
    if window == k:
        return np.arange(len(found)), found
    width = window - k + 1
    if len(found) < width:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    views = np.lib.stride_tricks.sliding_window_view(found, width)
    at = np.unique(views.argmin(1) + np.arange(len(views)))
    return at, found[at]


def _keys(values: np.ndarray, window: int) -> np.ndarray:
    """Fingerprints of different window lengths never meet."""
    return mix(values + np.uint64(window)).view(np.int64)


class _Text:
    """The words of one of several texts."""

    def __init__(self, words: Words, raw: bytes, i: int):
        own = slice(words.first[i], words.first[i + 1])
        self.hashes, self.starts, self.ends = (
            values[own] for values in (words.hashes, words.starts, words.ends)
        )
        self.raw = raw

    def context(self, at: int, window: int, k: int) -> tuple[int, bytes]:
        """Words before ``at`` that are kept, and the words around it as far as a window reaches."""
        left = min(at, window - k)
        last = min(at + window, len(self.hashes)) - 1
        return left, self.raw[self.starts[at - left] : self.ends[last]]


def _texts(raws: list[bytes]) -> list[_Text]:
    words = words_of(raws, ALNUM)
    raw = words.block.tobytes()
    return [_Text(words, raw, i) for i in range(len(raws))]


_ITEM_HITS = pa.schema(
    [
        ("fp", pa.int64()),
        ("item_id", pa.int64()),
        ("window", pa.int64()),
        ("item_left", pa.int64()),
        ("item_words", pa.binary()),
    ]
)


def item_fingerprints(benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(fp, item_id, window, item_left, item_words)``: kept fingerprints of every item.

    An item of fewer words than ``window``, but not none, is one window of its own
    length.
    """

    def read(batches):
        for rows in byte_slices(batches, "raw"):
            columns = {name: [] for name in _ITEM_HITS.names}
            for item_id, item in zip(rows["item_id"], _texts(rows["raw"]), strict=True):
                n = min(window, len(item.hashes))
                if not n:
                    continue
                at, values = winnow(item.hashes, n, gram)
                for p, fp in zip(at.tolist(), _keys(values, n).tolist(), strict=True):
                    left, context = item.context(p, n, min(gram, n))
                    columns["fp"].append(fp)
                    columns["item_id"].append(item_id)
                    columns["window"].append(n)
                    columns["item_left"].append(left)
                    columns["item_words"].append(context)
            yield pa.RecordBatch.from_pydict(columns, schema=_ITEM_HITS)

    items = benchmark.select("item_id", utf8().alias("raw"))
    # The same context of an item counts once, however often it stands there.
    return map_arrow(items, read, _ITEM_HITS).distinct()


def fingerprint_filter(fingerprints: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bit ``fp mod bits`` is set for every fingerprint; ``bits / 8`` bytes reach the driver."""
    slot = F.pmod("fp", F.lit(bits))
    parts = (
        fingerprints.groupBy(F.floor(slot / _BUCKET).cast("int").alias("bucket"))
        .agg(F.bitmap_construct_agg((slot % _BUCKET).cast("bigint")).alias("part"))
        .collect()
    )
    packed = np.zeros(bits // 8, np.uint8)
    for row in parts:
        start = row.bucket * _BUCKET // 8
        packed[start : start + _BUCKET // 8] = np.frombuffer(row.part, np.uint8)
    return packed


_DOC_ROWS = pa.schema(
    [
        ("rid", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        (
            "hits",
            pa.list_(
                pa.struct(
                    [
                        ("fp", pa.int64()),
                        ("at", pa.int64()),
                        ("left", pa.int64()),
                        ("words", pa.binary()),
                    ]
                )
            ),
        ),
    ]
)


def _doc_hits(docs: DataFrame, windows: list[int], packed, gram: int) -> DataFrame:
    def read(batches):
        bits = np.unpackbits(packed.value, bitorder="little").view(bool)
        for rows in byte_slices(batches, "raw"):
            texts = _texts(rows["raw"])
            hits = [[] for _ in texts]
            for i, text in enumerate(texts):
                for n in windows:
                    at, values = winnow(text.hashes, n, gram)
                    keys = _keys(values, n)
                    kept = bits[keys % len(bits)]
                    for p, fp in zip(at[kept].tolist(), keys[kept].tolist(), strict=True):
                        left, context = text.context(p, n, min(gram, n))
                        hits[i].append({"fp": fp, "at": p, "left": left, "words": context})
            yield pa.RecordBatch.from_pydict(
                {
                    "rid": rows["rid"],
                    "doc_id": rows["doc_id"],
                    "n_words": [len(text.hashes) for text in texts],
                    "hits": hits,
                },
                schema=_DOC_ROWS,
            )

    return map_arrow(docs, read, _DOC_ROWS)


_RUNS = pa.schema(
    [("rid", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]
)


def _extend(batches):
    """Extend each joined fingerprint to both sides; keep runs of a whole window."""
    for rows in slices(batches, 4096):
        out = {name: [] for name in _RUNS.names}
        for rid, item, n, at, dl, dw, il, iw in zip(
            *(rows[c] for c in ("rid", "item_id", "window", "at", "left", "words")),
            rows["item_left"],
            rows["item_words"],
            strict=True,
        ):
            doc, test = _split(dw), _split(iw)
            left = _leading(reversed(doc[:dl]), reversed(test[:il]))
            right = _leading(doc[dl:], test[il:])
            if left + right >= n:
                out["rid"].append(rid)
                out["item_id"].append(item)
                out["start"].append(at - left)
                out["end"].append(at + right)
        yield pa.RecordBatch.from_pydict(out, schema=_RUNS)


def _split(context: bytes) -> list[bytes]:
    return context.translate(ALNUM).split()


def _leading(a: Iterable[bytes], b: Iterable[bytes]) -> int:
    """How many words agree before the first two that do not."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """``(rid, doc_id, n_words, n_hit, items, spans)`` per row of ``docs``.

    ``spans`` are the merged hit words ``[start, end)``, ``items`` the sorted ids,
    as strings, of the items with a window that stands in the text. Null and empty
    texts have no words; items without words match nothing; an item whose id is
    null counts for its words but has no id to list. Very long texts and words are read
    whole, some megabytes at a time or a longer text alone. Repeated rows and ids give a
    row each (``rid`` numbers them), repeated items count once per id. Extra columns
    are not read. A fingerprint that stands in very many texts meets only its few
    places in the benchmark, and Spark can split its rows.
    """
    spark = docs.sparkSession
    prints = written(item_fingerprints(benchmark, window, gram), "benchmark-fingerprints")
    windows = sorted(row.window for row in prints.select("window").distinct().collect())
    packed = spark.sparkContext.broadcast(fingerprint_filter(prints))
    numbered = docs.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", utf8(F.col(text)).alias("raw")
    )
    scanned = written(_doc_hits(numbered, windows, packed, gram), "winnowed")
    hits = scanned.select("rid", F.explode("hits").alias("hit")).select("rid", "hit.*")
    runs = map_arrow(hits.join(prints, "fp"), _extend, _RUNS).distinct()
    items = F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    by_text = merged_spans(runs).join(runs.groupBy("rid").agg(items), "rid")
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    none = F.array().cast("array<string>")
    return (
        scanned.select("rid", "doc_id", "n_words")
        .join(by_text, "rid", "left")
        .select(
            "rid",
            "doc_id",
            "n_words",
            F.coalesce(n_hit, F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("spans", F.array().cast("array<struct<start: bigint, end: bigint>>")).alias(
                "spans"
            ),
        )
    )


def merged_spans(runs: DataFrame) -> DataFrame:
    """``(rid, spans)``: spans that touch or overlap as one, in order, in linear time.

    A text's runs, at most a few per word, are ordered in one task.
    """
    by_start = Window.partitionBy("rid").orderBy("start", "end")
    before = by_start.rowsBetween(Window.unboundedPreceding, -1)
    so_far = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    apart = runs.select("rid", "start", "end").distinct()
    apart = apart.withColumn("reach", F.max("end").over(before))
    begins = F.when(F.col("reach") >= F.col("start"), 0).otherwise(1)
    joined = (
        apart.withColumn("begins", begins)
        .withColumn("number", F.sum("begins").over(so_far))
        .groupBy("rid", "number")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    spans = F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")
    return joined.groupBy("rid").agg(spans)


def contaminated(n_hit, n_words) -> F.Column:
    """True where at least one word in twenty is hit."""
    return (n_hit > 0) & (F.lit(CONTAMINATED_ONE_IN) * n_hit >= n_words)
