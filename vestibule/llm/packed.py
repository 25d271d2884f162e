"""Counting 64-bit values over all data by exchanging packed sorted arrays.

Texts are dealt into batches of bounded size. Each batch sends its distinct
values, with how often it has them, in one packed row per bucket of the value
range; a bucket adds up what all batches sent and answers each one. A value of
any frequency travels once per batch, so nothing is hot, and the answer goes back
to where the text is, so values are never joined row by row. Rows are batches times buckets:
where executors have more memory than a few GB, larger ones make fewer rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vestibule.llm.shared import ddl

# Bytes of text in a batch, and values in a bucket, on average.
BATCH_BYTES = 8 << 20
BUCKET_VALUES = 1 << 20
# Even small inputs are dealt out a little, so that they use several tasks.
LEAST = 24


def pack(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed; ascending ones are small as differences."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(kind).reshape(-1)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def batch_of(key: Column, batches: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(batches)).cast("int")


def batch_count(total_bytes: int) -> int:
    return max(LEAST, -(-total_bytes // BATCH_BYTES))


REQUEST = pa.schema(
    [
        ("bucket", pa.int32()),
        ("batch", pa.int32()),
        ("found", pa.binary()),
        ("times", pa.binary()),
        ("check", pa.binary()),
    ]
)
ANSWER = pa.schema([("batch", pa.int32()), ("bucket", pa.int32()), ("answer", pa.binary())])


def bucket_bounds(values: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket, an equal share of the 64-bit range, begins in sorted values."""
    edges = [(b << 64) // buckets for b in range(buckets)]
    first = np.searchsorted(values, np.array(edges, np.uint64))
    return np.append(first, len(values))


def requests(
    batch: int, values: np.ndarray, times: np.ndarray, buckets: int, check: np.ndarray | None = None
) -> pa.Table:
    """Rows that ask for the totals of sorted distinct ``values``, one per bucket in use.

    Where ``check``, another 32 bits per value, is given, only values that agree in
    it count together.
    """
    first = bucket_bounds(values, buckets)
    used = [b for b in range(buckets) if first[b] < first[b + 1]]
    parts = [slice(int(first[b]), int(first[b + 1])) for b in used]
    return pa.table(
        {
            "bucket": used,
            "batch": [batch] * len(used),
            "found": [pack_sorted(values[p]) for p in parts],
            "times": [pack(times[p].astype(np.uint32)) for p in parts],
            "check": [None if check is None else pack(check[p].astype(np.uint32)) for p in parts],
        },
        schema=REQUEST,
    )


def totals(asked: DataFrame, answer) -> DataFrame:
    """``(batch, bucket, answer)``: ``answer(values, totals)`` packs what a batch learns."""

    def count(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        found = [unpack_sorted(data) for data in rows["found"]]
        times = [unpack(data, np.uint32) for data in rows["times"]]
        every = np.concatenate(found)
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
        weights = np.concatenate(times)[order].astype(np.uint64)
        total = np.add.reduceat(weights, first)
        distinct = every[first]
        answers = [total[np.searchsorted(distinct, v)] for v in found]
        if rows["check"][0] is not None:
            checks = [unpack(data, np.uint32) for data in rows["check"]]
            joined = np.concatenate(checks)[order]
            low, high = np.minimum.reduceat(joined, first), np.maximum.reduceat(joined, first)
            for value in distinct[low != high]:  # two values in one: counted apart
                _count_apart(value, found, times, checks, answers)
        answers = [answer(v, n) for v, n in zip(found, answers, strict=True)]
        return pa.table(
            {"batch": rows["batch"], "bucket": rows["bucket"], "answer": answers}, schema=ANSWER
        )

    return asked.groupBy("bucket").applyInArrow(count, ddl(ANSWER))


def _count_apart(value, found, times, checks, answers) -> None:
    places = [(i, int(np.searchsorted(v, value))) for i, v in enumerate(found)]
    places = [(i, k) for i, k in places if k < len(found[i]) and found[i][k] == value]
    for i, k in places:
        answers[i][k] = sum(int(times[j][m]) for j, m in places if checks[j][m] == checks[i][k])


def in_bucket_order(table: pa.Table) -> Iterator[bytes]:
    """The answers that a batch got, by bucket and so by value."""
    rows = sorted(zip(table.column("bucket").to_pylist(), table.column("answer").to_pylist()))
    return (data for _, data in rows)
