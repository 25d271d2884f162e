"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation, three rounds of random signs and a fast Hadamard transform,
turns a unit vector; its hash is the signed axis it then lies nearest to. Every
vector is filed under one hash in each of several tables. A query looks, in each
table, into the buckets of the axes nearest to it (multiprobe), and what it finds
is ranked by the true inner product. Queries that find too few rows so are compared
with all vectors.

Vectors are hashed by direction. Where lengths differ, a long vector is near in inner
product at a wider angle: vectors longer than the median fall into bands of doubling
length, each with buckets of its own, and with every band twice as many are probed,
until the longest vectors are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vestibule.llm.shared import ddl, map_arrow, written, written_and_counted

TABLES = 8
PROBES = 16
SEED = 7
# Vectors and queries of a bucket that meet in one task.
BLOCK_VECTORS = 1024
BLOCK_QUERIES = 1024
# Scores this close to the last one kept are computed again before they are ranked.
SLACK = 1e-9
# Steps of the histogram of lengths in each doubling, and the part of a step by which
# its bounds lie above the powers of two, where rounding would split unit vectors.
STEPS = 4
ABOVE = 0.01


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The normalised fast Hadamard transform of every row; the width is a power of two."""
    n, width = rows.shape
    half = 1
    while half < width:
        pairs = rows.reshape(n, width // (2 * half), 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2)
        rows, half = rows.reshape(n, width), 2 * half
    return rows / np.sqrt(width)


class CrossPolytope:
    """The hash functions of all tables for vectors of one dimension."""

    def __init__(self, dim: int, longest: float, equal_lengths: bool, tables: int, seed: int):
        self.longest, self.equal = longest, equal_lengths
        used = dim if equal_lengths else dim + 1
        self.width = 1 << max(0, used - 1).bit_length()
        random = np.random.default_rng(seed)
        self.signs = random.choice([-1.0, 1.0], (tables, 3, self.width))

    def _axes(self, rows: np.ndarray, table: int) -> np.ndarray:
        for signs in self.signs[table]:
            rows = hadamard(rows * signs)
        both = np.empty((len(rows), 2 * self.width))
        both[:, 0::2], both[:, 1::2] = rows, -rows
        return both

    def _unit(self, rows: np.ndarray, query: bool) -> np.ndarray:
        out = np.zeros((len(rows), self.width))
        length = np.linalg.norm(rows, axis=1)
        if query or self.equal:
            out[:, : rows.shape[1]] = rows / length[:, None]
        else:
            out[:, : rows.shape[1]] = rows / self.longest
            rest = 1 - np.minimum(length / self.longest, 1) ** 2
            out[:, rows.shape[1]] = np.sqrt(rest)
        return out

    def codes(self, rows: np.ndarray) -> np.ndarray:
        """The bucket of every row in each table."""
        unit = self._unit(rows, False)
        return np.stack([self._axes(unit, t).argmax(1) for t in range(len(self.signs))], 1)

    def probes(self, rows: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` buckets of each table nearest to every row, as a query."""
        unit, n = self._unit(rows, True), min(n, 2 * self.width)
        return np.stack(
            [
                np.argsort(-self._axes(unit, t), 1, kind="stable")[:, :n]
                for t in range(len(self.signs))
            ],
            1,
        )


def usable(vector: Column) -> Column:
    """True for a vector without null and non-finite components that is not zero."""
    infinite = float("inf")
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == infinite)
    )
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def length_step(vector: Column) -> Column:
    """The step of the histogram that a usable vector's length falls into."""
    largest = F.array_max(F.transform(vector, F.abs))
    squares = F.aggregate(vector, F.lit(0.0), lambda s, x: s + (x / largest) * (x / largest))
    log2 = F.log2(largest) + F.log2(squares) / 2
    return F.ceil(log2 * STEPS - ABOVE)


class Bands:
    """Bands of doubling length above the median, and the buckets probed in each.

    The first band also holds all shorter vectors. A band of which every bucket would
    be probed is a single bucket of the first table; no band lies beyond it.
    """

    def __init__(self, histogram: dict[int, int], probes: int, axes: int):
        self.axes, self.probes = axes, probes
        self.last = 0
        while probes << self.last < axes:
            self.last += 1
        half, self.median = sum(histogram.values()) / 2, 0
        for step in sorted(histogram):
            half -= histogram[step]
            self.median = step
            if half <= 0:
                break
        self.held = sorted({self.of(step) for step in histogram})

    def of(self, step: int) -> int:
        """The band of a vector whose length falls into ``step``."""
        return min(self.last, max(0, -((self.median - step) // STEPS)))

    def filed(self, step: int, codes: list[int]) -> list[int]:
        """The bucket of a vector in each table that it is filed in."""
        band = self.of(step)
        if band == self.last:
            return [band * self.axes]
        return [band * self.axes + code for code in codes]

    def probed(self, nearest: list[list[int]]) -> list[list[int]]:
        """The buckets of each table that a query looks into, from its axes in order."""
        hashed = [band for band in self.held if band < self.last]
        out = [
            [band * self.axes + code for band in hashed for code in near[: self.probes << band]]
            for near in nearest
        ]
        if self.last in self.held:
            out[0].append(self.last * self.axes)
        return out

    @property
    def most(self) -> int:
        """The most buckets of a hashed band that a query looks into."""
        return max((self.probes << band for band in self.held if band < self.last), default=1)


_CODED = pa.schema(
    [
        ("vec_id", pa.int64()),
        ("is_query", pa.bool_()),
        ("vector", pa.binary()),
        ("codes", pa.list_(pa.int32())),
        ("probes", pa.list_(pa.list_(pa.int32()))),
    ]
)


def _rows(vectors: pa.Array, dim: int) -> np.ndarray:
    """Double rows of one width; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), dim))
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))
    sizes = np.diff(ends, prepend=0)
    row = np.repeat(np.arange(len(vectors)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return out


def _coded(vectors: DataFrame, hashes: CrossPolytope, dim: int, bands: Bands) -> DataFrame:
    def code(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _rows(batch.column("vector"), dim)
            # Scaled, so that no square of a component is too large or too small.
            scaled = rows / np.abs(rows).max(1)[:, None]
            query = batch.column("is_query").to_numpy(zero_copy_only=False)
            found = iter(hashes.probes(scaled[query], bands.most).tolist() if query.any() else ())
            steps = batch.column("step").to_pylist()
            codes = zip(steps, hashes.codes(scaled).tolist(), strict=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "vec_id": batch.column("vec_id"),
                    "is_query": batch.column("is_query"),
                    "vector": [row.tobytes() for row in rows],
                    "codes": [bands.filed(step, own) for step, own in codes],
                    "probes": [bands.probed(next(found)) if q else None for q in query],
                },
                schema=_CODED,
            )

    return map_arrow(vectors, code, _CODED)


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def best_of(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int
) -> list[tuple[int, int, float]]:
    """The ``k`` best ids for each query, ties to the smaller id, itself left out.

    An id counts once, by its best row.
    """
    out = []
    by_id = np.argsort(ids, kind="stable")
    ids, rows = ids[by_id], rows[by_id]
    distinct, first, times = np.unique(ids, return_index=True, return_counts=True)
    rough = queries @ rows.T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    for i, query_id in enumerate(query_ids.tolist()):
        near = np.maximum.reduceat(rough[i], first)
        own = int(np.isneginf(near).sum())
        kept = min(k, len(distinct) - own)
        if kept <= 0:
            continue
        last = np.partition(near, len(near) - kept)[len(near) - kept]
        # Each pair's sum is formed in one order, so equal vectors tie exactly.
        close = near >= last - SLACK * max(1.0, abs(last))
        at = np.flatnonzero(np.repeat(close, times))
        exact = (rows[at] * queries[i]).sum(1)
        order = np.lexsort((-exact, ids[at]))
        order = order[np.unique(ids[at][order], return_index=True)[1]]
        order = order[np.lexsort((ids[at][order], -exact[order]))][:kept]
        out += [(query_id, int(ids[at[j]]), float(exact[j])) for j in order]
    return out


def _n_blocks(count: Column, per: int) -> Column:
    return F.ceil(count / F.lit(per))


def _met(
    filed: DataFrame, asked: DataFrame, bucket: list[str], dim: int, k: int, seed: int
) -> DataFrame:
    """The best rows that each block of a bucket's queries finds in each block of its vectors.

    Both sides name the numbers of blocks, ``v_blocks`` and ``q_blocks``.
    """

    def blocks(rows: DataFrame, own: str, other: str, ident: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(ident, F.lit(seed)), F.col(own)).alias(own)
        every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(other) - 1)).alias(other)
        kept = [c for c in rows.columns if c not in (own, other)]
        return rows.select(*kept, mine, every)

    keys = [*bucket, "v_blocks", "q_blocks"]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            rows, queries = (
                np.frombuffer(b"".join(t.column(c).to_pylist()), np.float64).reshape(-1, dim)
                for t, c in ((left, "vector"), (right, "query"))
            )
            ids, query_ids = left.column("vec_id").to_numpy(), right.column("query_id").to_numpy()
            found = best_of(query_ids, queries, ids, rows, k)
        columns = list(zip(*found, strict=True)) or [()] * 3
        return pa.table(
            [pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND
        )

    v, q = (
        blocks(filed, "v_blocks", "q_blocks", "vec_id").groupBy(keys),
        blocks(asked, "q_blocks", "v_blocks", "query_id").groupBy(keys),
    )
    return v.cogroup(q).applyInArrow(meet, ddl(_FOUND))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best ids of each query, each by its best score."""
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest_vectors(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    vector: str = "embedding",
    tables: int = TABLES,
    probes: int = PROBES,
    seed: int = SEED,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found rows per query.

    Nearness is the inner product in double precision, ties go to the smaller id.
    Queries are rows of ``vectors`` for which ``is_query`` holds; a row is no
    candidate of its own id, so repeated ids do not find each other, and a repeated
    id is listed once, by its best score. Vectors that are null, empty, zero or hold
    null or non-finite components take no part, nor do rows without an id; a shorter
    vector ends in zeros. A query gets fewer than ``k`` rows only when the table has
    fewer other ids: one whose buckets hold too few is compared with all vectors. An
    empty table gives no rows. Extra columns are not read.

    Every vector is indexed, whatever its length. ``probes`` counts for vectors up to the
    median length; longer ones are looked for in more buckets. A bucket of any size is dealt out in blocks, and its
    queries likewise, each block of queries meeting each block of vectors once.
    """
    value = F.col(vector)
    part = vectors.filter(F.col("vec_id").isNotNull() & usable(value)).select(
        "vec_id",
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
        value.cast("array<double>").alias("vector"),
    )
    part = part.withColumn("step", length_step(F.col("vector")))
    steps = part.groupBy("step").agg(F.max(F.size("vector")).alias("dim"), F.count("*").alias("n"))
    # As many rows as the lengths take steps, a few thousand at most.
    steps = steps.collect()
    dim = max((row.dim for row in steps), default=1)
    hashes = CrossPolytope(dim, 1.0, True, tables, seed)
    bands = Bands({row.step: row.n for row in steps}, probes, 2 * hashes.width)
    coded = written(_coded(part, hashes, dim, bands), "hashed-vectors")

    filed = coded.select("vec_id", "vector", F.posexplode("codes").alias("table", "code"))
    queries = coded.filter("is_query").select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), "probes"
    )
    asked = queries.select("query_id", "query", F.posexplode("probes").alias("table", "near"))
    asked = asked.select("query_id", "query", "table", F.explode("near").alias("code"))
    bucket = ["table", "code"]
    sizes = (
        filed.groupBy(bucket)
        .agg(_n_blocks(F.count("*"), BLOCK_VECTORS).alias("v_blocks"))
        .join(
            asked.groupBy(bucket).agg(
                _n_blocks(F.count("*"), BLOCK_QUERIES).alias("q_blocks")
            ),
            bucket,
        )
    )
    found = _met(filed.join(sizes, bucket), asked.join(sizes, bucket), bucket, dim, k, seed)
    found = written(_ranked(found, k), "nearest-found")

    # No more than k ids other than a query's own are wanted.
    others = coded.select("vec_id").distinct().limit(k + 1).count() - 1
    held = found.groupBy("query_id").agg(F.count("*").alias("n"))
    short = (
        queries.select("query_id")
        .distinct()
        .join(held, "query_id", "left")
        .filter(F.coalesce("n", F.lit(0)) < others)
        .select("query_id")
    )
    short, n_short = written_and_counted(short, "short-queries")
    if not n_short:
        return found
    again = written(queries.drop("probes").join(short, "query_id", "left_semi"), "asked-again")
    counts = (
        _n_blocks(F.lit(coded.count()), BLOCK_VECTORS).alias("v_blocks"),
        _n_blocks(F.lit(again.count()), BLOCK_QUERIES).alias("q_blocks"),
    )
    whole = _met(
        coded.select("vec_id", "vector", *counts), again.select("*", *counts), [], dim, k, seed
    )
    return found.join(short, "query_id", "left_anti").unionByName(_ranked(whole, k))
