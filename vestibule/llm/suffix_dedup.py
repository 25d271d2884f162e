"""Suffix-array dedup: repeated byte strings found by a hash-compared suffix sort.

Every suffix of every text, cut to the length that counts, is a candidate. Which
ones can have an equal elsewhere is settled first: the smallest k-gram hash in a
suffix is its anchor, equal suffixes have equal anchors at equal places, and
anchors that stand only once in all texts leave. The others are dealt into runs by
anchor and place and sorted by a mergesort that compares two suffixes in a
logarithmic number of steps: prefix polynomial hashes tell whether their first
``m`` bytes agree, so a binary search finds how far they do, and the next byte
decides. Neighbours that agree throughout are checked byte by byte. The sorted
runs of all batches are merged by the hash of the whole suffix, with a second hash
modulo a prime to tell collisions apart; a suffix that stands in two places marks its
bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vestibule.llm import packed
from vestibule.llm.shared import ddl, small_batches, utf8, written
from vestibule.llm.words import mix

LENGTH = 400
GRAM = 64
# Bytes of text in a batch, and suffixes in a bucket, on average.
BATCH_BYTES = 4 << 20
BUCKET_VALUES = 1 << 20
# Bytes of text that are hashed at a time; longer texts go in overlapping pieces.
PIECE_BITS = 19
PIECE = 1 << PIECE_BITS

_RANDOM = np.random.default_rng(400)
_ODD = np.uint64(0xD1342543DE82EF95)


class _Wide:
    """Polynomial hashes modulo 2 ** 64, which numpy does by itself.

    Strings made for it (those of Thue and Morse) collide under any base.
    """

    def __init__(self, base: int):
        self.bytes = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64)
        self.power = self._powers(base, PIECE + 1)
        self.inverse = self._powers(pow(base, -1, 1 << 64), PIECE + 1)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def reduce(self, values: np.ndarray) -> np.ndarray:
        return values

    def span(self, h: np.ndarray, start: np.ndarray, length) -> np.ndarray:
        """Hash of ``length`` bytes from ``start``; equal for equal bytes anywhere."""
        return h[start + length] - h[start] * self.power[length]


class _Prime(_Wide):
    """The same modulo a prime, in 31 bits, independent of the other."""

    modulus = (1 << 31) - 1

    def __init__(self, base: int):
        self.bytes = _RANDOM.integers(1, self.modulus, 256, dtype=np.uint64)
        self.power = self._powers(base, PIECE + 1)
        self.inverse = self._powers(pow(base, -1, self.modulus), PIECE + 1)

    @classmethod
    def _powers(cls, base: int, n: int) -> np.ndarray:
        out = np.ones(1, np.uint64)
        while len(out) < n:
            out = np.append(out, out * np.uint64(pow(base, len(out), cls.modulus)) % cls.modulus)
        return out[:n]

    def reduce(self, values: np.ndarray) -> np.ndarray:
        return values % np.uint64(self.modulus)

    def span(self, h: np.ndarray, start: np.ndarray, length) -> np.ndarray:
        whole = h[start + length] + np.uint64(self.modulus * self.modulus)
        return self.reduce(whole - h[start] * self.power[length])


WIDE = _Wide(0x5851F42D4C957F2D)
PRIME = _Prime(0x2545F491 % _Prime.modulus)


def prefix_hashes(block: np.ndarray, which: _Wide = WIDE) -> np.ndarray:
    """``h[i]``: polynomial hash of the first ``i`` bytes, for any number of bytes."""
    out = np.zeros(len(block) + 1, np.uint64)
    for start in range(0, len(block), PIECE):
        part = which.bytes[block[start : start + PIECE]]
        n = len(part)
        part = which.reduce(part * which.inverse[1 : n + 1])
        np.cumsum(part, out=part)
        part = which.reduce(part + out[start])
        out[start + 1 : start + n + 1] = which.reduce(part * which.power[1 : n + 1])
    return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, from running minima of blocks."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def common_extension(h: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many bytes, up to ``most``, agree from ``a`` and from ``b`` on."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), most)
    for _ in range(int(most).bit_length()):
        middle = (low + high + 1) // 2
        same = WIDE.span(h, a, middle) == WIDE.span(h, b, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


@dataclass
class _Hashes:
    """Prefix hashes of a block, and the starts of its suffixes."""

    wide: np.ndarray
    prime: np.ndarray
    starts: np.ndarray

    def whole(self, starts: np.ndarray, length: int) -> np.ndarray:
        """Both hashes of suffixes as one number."""
        prime = PRIME.span(self.prime, starts, length)
        return mix(WIDE.span(self.wide, starts, length) ^ prime * _ODD)


def is_before(block, h, whole, a, b, most: int, or_equal: np.ndarray) -> np.ndarray:
    """Whether suffix ``a`` sorts before ``b``; ``or_equal`` says what holds for equal ones.

    The second hash confirms what the first says about the common extension; where it
    does not, the suffixes themselves are compared.
    """
    out = or_equal.copy()
    apart = np.flatnonzero(whole[a] != whole[b])
    if len(apart):
        x, y = h.starts[a[apart]], h.starts[b[apart]]
        n = common_extension(h.wide, x, y, most)
        wrong = (n == most) | (PRIME.span(h.prime, x, n) != PRIME.span(h.prime, y, n))
        n = np.minimum(n, most - 1)
        out[apart] = block[x + n] < block[y + n]
        for k in np.flatnonzero(wrong).tolist():
            out[apart[k]] = _bytes_at(block, x[k], most) < _bytes_at(block, y[k], most)
    return out


def _bytes_at(block: np.ndarray, start: int, length: int) -> bytes:
    return block[start : start + length].tobytes()


def merge_sort(block: np.ndarray, h: _Hashes, whole: np.ndarray, keys: np.ndarray, most: int):
    """Positions into ``h.starts`` sorted by key, then by suffix.

    Runs of equal keys are sorted bottom-up, all merges of a round at once: each
    suffix finds its place in the other run by bisection.
    """
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    size = np.diff(np.append(first, len(keys)))
    many = np.repeat(size > 1, size)
    at = np.flatnonzero(many)  # places whose run has more than one suffix
    begin = np.repeat(first, size)[at]
    end = begin + np.repeat(size, size)[at]
    width = 1
    while len(at) and width < size.max():
        within = at - begin
        left = within // width % 2 == 0
        own = begin + within // width * width
        other = np.where(left, own + width, own - width)
        low = np.minimum(other, end)
        high = np.minimum(np.minimum(other + width, end), np.where(left, end, own))
        base = np.where(left, own, other)
        start_low = low.copy()
        while True:
            busy = np.flatnonzero(low < high)
            if not len(busy):
                break
            middle = (low[busy] + high[busy]) // 2
            # Equal suffixes keep their order: those of the left run come first.
            ahead = is_before(
                block, h, whole, order[middle], order[at[busy]], most, ~left[busy]
            )
            low[busy] = np.where(ahead, middle + 1, low[busy])
            high[busy] = np.where(ahead, high[busy], middle)
        merged = order.copy()
        merged[base + (at - own) + (low - start_low)] = order[at]
        order = merged
        width *= 2
    return order


class Batch:
    """The texts of a batch as one block of bytes, and their candidate suffixes."""

    def __init__(self, raws: list[bytes], length: int, gram: int):
        self.length, self.gram = length, gram
        self.sizes = np.fromiter(map(len, raws), np.int64, len(raws))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.block = np.frombuffer(b"".join(raws), np.uint8)

    def _spans(self) -> Iterator[tuple[int, int]]:
        """Stretches of the block with whole texts, or pieces of one, for a bounded array.

        A piece overlaps the next one so that every suffix lies whole in one piece.
        """
        start = 0
        ends = (self.begins + self.sizes).tolist()
        for i, end in enumerate(ends):
            if end - start > PIECE:
                if start < self.begins[i]:
                    yield start, int(self.begins[i])
                start = int(self.begins[i])
                while end - start > PIECE:
                    yield start, start + PIECE
                    start += PIECE - self.length + 1
        if ends and start < ends[-1]:
            yield start, ends[-1]

    def _inside(self, start: int, n: int) -> np.ndarray:
        """Which of ``n`` places from ``start`` on begin a suffix that its text holds whole."""
        out = np.zeros(n, bool)
        i = max(0, int(np.searchsorted(self.begins, start, "right")) - 1)
        while i < len(self.begins) and self.begins[i] < start + n:
            first = self.begins[i] - start
            last = first + self.sizes[i] - self.length
            if last >= 0:
                out[max(0, first) : last + 1] = True
            i += 1
        return out

    def anchors(self):
        """Per stretch: suffix runs as ``(anchor hash, anchor, first suffix, last suffix)``."""
        for start, end in self._spans():
            if end - start < self.length:
                continue
            h = prefix_hashes(self.block[start:end])
            grams = mix(WIDE.span(h, np.arange(end - start - self.gram + 1), self.gram))
            mark = (grams >> np.uint64(PIECE_BITS + 1) << np.uint64(PIECE_BITS + 1)) | np.arange(
                len(grams), dtype=np.uint64
            )
            least = sliding_min(mark, self.length - self.gram + 1)
            anchor = (least & np.uint64((1 << (PIECE_BITS + 1)) - 1)).astype(np.int64)
            # A suffix must lie in one text, so those of two texts are never neighbours.
            inside = self._inside(start, len(anchor))
            change = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
            first = np.flatnonzero(np.append(True, change))
            last = np.append(first[1:], len(anchor)) - 1
            kept = inside[first]
            first, last = first[kept], last[kept]
            yield grams[anchor[first]], start + anchor[first], start + first, start + last

    def suffixes(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the suffixes with a repeated anchor, and a key from anchor and place."""
        starts, keys = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for values, anchor, first, last in self.anchors():
            if not len(repeated):
                break
            at = np.minimum(np.searchsorted(repeated, values), len(repeated) - 1)
            kept = repeated[at] == values
            n = (last - first + 1)[kept]
            total = np.cumsum(n)
            start = np.arange(n.sum()) + np.repeat(first[kept] - total + n, n)
            place = (np.repeat(anchor[kept], n) - start).astype(np.uint64)
            starts.append(start)
            keys.append(mix(np.repeat(values[kept], n) + place * np.uint64(0x9E3779B97F4A7C15)))
        return np.concatenate(starts), np.concatenate(keys)

    def hashes(self, starts: np.ndarray) -> _Hashes:
        return _Hashes(prefix_hashes(self.block), prefix_hashes(self.block, PRIME), starts)

    def sorted_classes(self, starts: np.ndarray, keys: np.ndarray):
        """Hash, number and second hash of each class of equal suffixes, from the suffix sort.

        Classes come in the order of their hashes. Two strings that agree in both hashes,
        95 bits, are counted apart: what stands more often counts for both.
        """
        if not len(starts):
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint32)
        h = self.hashes(starts)
        whole = h.whole(starts, self.length)
        order = merge_sort(self.block, h, whole, keys, self.length)
        order, equal = self._verified(order, starts, whole, keys)
        first = np.flatnonzero(~equal)
        times = np.diff(np.append(first, len(order)))
        values, place = np.unique(whole[order[first]], return_inverse=True)
        most = np.zeros(len(values), np.int64)
        np.maximum.at(most, place, times)
        one = np.empty(len(values), np.int64)
        one[place] = starts[order[first]]
        return values, most, PRIME.span(h.prime, one, self.length).astype(np.uint32)

    def _verified(self, order: np.ndarray, starts: np.ndarray, whole: np.ndarray, keys: np.ndarray):
        """The order, and which suffixes equal the one before them, byte by byte.

        Where neighbours with equal hashes differ, the suffixes of that hash are sorted
        once more as they are.
        """
        ordered, same_key = whole[order], keys[order]
        alike = np.append(False, (ordered[1:] == ordered[:-1]) & (same_key[1:] == same_key[:-1]))
        equal = alike.copy()
        equal[alike] = self._same_as_before(starts[order], np.flatnonzero(alike))
        for value in np.unique(ordered[alike & ~equal]):
            at = np.flatnonzero(ordered == value)
            at = at[np.argsort(same_key[at], kind="stable")]
            texts = [_bytes_at(self.block, s, self.length) for s in starts[order[at]]]
            by_text = sorted(range(len(at)), key=lambda k: (same_key[at[k]], texts[k]))
            order[at] = order[at[by_text]]
            texts = [texts[k] for k in by_text]
            equal[at] = [k > 0 and texts[k] == texts[k - 1] for k in range(len(at))]
        return order, equal

    def _same_as_before(self, starts: np.ndarray, at: np.ndarray) -> np.ndarray:
        view = np.lib.stride_tricks.sliding_window_view(self.block, self.length)
        out = np.empty(len(at), bool)
        for k in range(0, len(at), 4096):
            part = at[k : k + 4096]
            out[k : k + 4096] = (view[starts[part]] == view[starts[part - 1]]).all(1)
        return out


def _standing(docs: pa.Table, told: pa.Table) -> tuple[list[bytes], list[int | None]]:
    """The texts of a batch that take part, and for each row the place of its text there.

    Of rows with equal texts a single one, in one batch, takes part for all; their
    texts stand twice from end to end, so no place is given.
    """
    copied = {
        (doc_id, digest): lead
        for doc_id, digest, lead, stage in zip(
            *(told.column(c).to_pylist() for c in ("doc_id", "digest", "lead", "stage")),
            strict=True,
        )
        if stage == 0
    }
    ids = {doc_id for doc_id, _ in copied}
    taking_part, places, done = [], [], set()
    for doc_id, raw in zip(
        docs.column("doc_id").to_pylist(), docs.column("raw").to_pylist(), strict=True
    ):
        key = (doc_id, hashlib.md5(raw).hexdigest()) if doc_id in ids else None
        alone = key not in copied
        places.append(len(taking_part) if alone else None)
        if alone or copied[key] and key not in done:
            done.add(key)
            taking_part.append(raw)
    return taking_part, places


def _copies(rows: DataFrame, length: int) -> DataFrame:
    """``(doc_id, digest, lead)`` of the rows whose text, ``length`` bytes or more, stands twice."""
    keys = rows.filter(F.octet_length("raw") >= length).select(
        "doc_id", F.md5("raw").alias("digest")
    )
    keys = written(keys, "text-digests")
    several = keys.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    # Written, so that Spark can split the rows of a text with very many copies.
    several = written(several.filter("n > 1").select("digest", "first"), "equal-texts")
    lead = F.col("doc_id").eqNullSafe(F.col("first")).alias("lead")
    return keys.join(several, "digest").select("doc_id", "digest", lead).distinct()


def _told(rows: pa.Table, stage: int) -> list[bytes]:
    part = rows.filter(pc.equal(rows.column("stage"), stage))
    return list(packed.in_bucket_order(part))


def _repeated(rows: pa.Table) -> np.ndarray:
    """The batch's anchors that stand in more than one place."""
    parts = [packed.unpack_sorted(data) for data in _told(rows, 1)]
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _answer_values(values: np.ndarray, total: np.ndarray) -> bytes:
    return packed.pack_sorted(values[total >= 2])


def _answer_bits(values: np.ndarray, total: np.ndarray) -> bytes:
    """One bit per value asked for: whether it stands in more than one place."""
    return len(values).to_bytes(8, "little") + np.packbits(total >= 2).tobytes()


def _flags(rows: pa.Table, stage: int) -> np.ndarray:
    parts = []
    for data in _told(rows, stage):
        n = int.from_bytes(data[:8], "little")
        parts.append(np.unpackbits(np.frombuffer(data, np.uint8, offset=8), count=n))
    return np.concatenate(parts).astype(bool) if parts else np.empty(0, bool)


def _found(batch: Batch, rows: pa.Table) -> np.ndarray:
    """Starts of the suffixes that stand in more than one place."""
    starts = np.sort(batch.suffixes(_repeated(rows))[0])
    if not len(starts):
        return starts
    whole = batch.hashes(starts).whole(starts, batch.length)
    _, inverse = np.unique(whole, return_inverse=True)
    return starts[_flags(rows, 2)[inverse]]


_RESULT = pa.schema(
    [
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("kept", pa.binary()),
    ]
)


def _spans_of(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The bytes that suffixes cover, as maximal spans."""
    if not len(starts):
        return []
    first = np.flatnonzero(np.append(True, np.diff(starts) > length))
    last = np.append(first[1:], len(starts)) - 1
    return list(zip(starts[first].tolist(), (starts[last] + length).tolist(), strict=True))


def whole_characters(raw: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans without the UTF-8 characters that they hold only in part."""
    out = []
    for start, end in spans:
        while start < end and raw[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def repeated_spans(
    docs: DataFrame,
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    carry: Sequence[str] = ("doc_id",),
    characters: bool = False,
    words: int = 0,
) -> DataFrame:
    """``(row, n_bytes, n_removed, spans, kept)`` per row of ``docs``.

    ``spans`` are the bytes ``[start, end)`` covered by a string of ``length`` bytes
    that also starts elsewhere in any row, the same one included, overlapping or
    not; ``kept`` is what is left. With ``characters`` only whole characters are cut,
    so ``kept`` stays a text; with ``words`` only spans of at least so many words, those
    cut by the span's ends included. ``row`` is a struct of the columns named in ``carry``;
    others are not read. Null, empty and short texts have no such string. Repeated
    rows repeat each other's strings. An empty table gives no rows. Batches hold
    whole texts, so a very long text makes a batch of its own size.
    """
    small_batches(docs.sparkSession)
    raw = utf8(F.col(text)).alias("raw")
    rows = docs.select("doc_id", raw, F.struct(*carry).alias("row"))
    total_bytes = rows.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    n_batches = max(packed.LEAST, -(-total_bytes // BATCH_BYTES))
    buckets = max(packed.LEAST, -(-total_bytes // (8 * BUCKET_VALUES)))
    width = gram if gram < length else length

    def batch_of(table: pa.Table, told: pa.Table) -> Batch:
        return Batch(_standing(table, told)[0], length, width)

    def ask_anchors(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        found = [values for values, *_ in batch_of(table, told).anchors()]
        values = np.concatenate(found) if found else np.empty(0, np.uint64)
        values, times = np.unique(values, return_counts=True)
        return packed.requests(key[0].as_py(), values, times, buckets)

    def ask_suffixes(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        batch = batch_of(table, told)
        values, times, check = batch.sorted_classes(*batch.suffixes(_repeated(told)))
        return packed.requests(key[0].as_py(), values, times, buckets, check)

    def cut(table: pa.Table, told: pa.Table) -> pa.Table:
        taking_part, places = _standing(table, told)
        batch = Batch(taking_part, length, width)
        starts = _found(batch, told)
        bounds = np.searchsorted(starts, np.append(batch.begins, len(batch.block)))
        out = {name: [] for name in _RESULT.names}
        for raw, place in zip(table.column("raw").to_pylist(), places, strict=True):
            spans, kept, at = [(0, len(raw))], [], 0
            if place is not None:
                own = starts[bounds[place] : bounds[place + 1]] - batch.begins[place]
                spans = _spans_of(own, length)
            if characters:
                spans = whole_characters(raw, spans)
            if words:
                spans = [(s, e) for s, e in spans if len(raw[s:e].split()) >= words]
            for start, end in spans:
                kept.append(raw[at:start])
                at = end
            kept.append(raw[at:])
            out["spans"].append([{"start": s, "end": e} for s, e in spans])
            out["n_removed"].append(sum(e - s for s, e in spans))
            out["n_bytes"].append(len(raw))
            out["kept"].append(b"".join(kept))
        return pa.table(out, schema=_RESULT).add_column(0, "row", table.column("row"))

    def batch(digest) -> Column:
        """Dealt by id and text: neither one id nor rows without any make a hot batch."""
        return packed.batch_of(F.struct("doc_id", digest), n_batches).alias("batch")

    dealt = rows.select("doc_id", "raw", "row", batch(F.md5("raw").alias("digest")))
    dealt = dealt.groupBy("batch")
    request = ddl(packed.REQUEST)

    def answers(asked: DataFrame, answer, stage: int) -> DataFrame:
        return packed.totals(asked, answer).withColumn("stage", F.lit(stage))

    copies = written(_copies(rows, length), "copies")
    told = copies.select(batch(F.col("digest")), "doc_id", "digest", "lead", F.lit(0).alias("stage"))
    asked = dealt.cogroup(told.groupBy("batch")).applyInArrow(ask_anchors, request)
    told = told.unionByName(answers(asked, _answer_values, 1), allowMissingColumns=True)
    asked = dealt.cogroup(told.groupBy("batch")).applyInArrow(ask_suffixes, request)
    told = told.unionByName(answers(asked, _answer_bits, 2), allowMissingColumns=True)
    result = StructType([rows.schema["row"], *StructType.fromDDL(ddl(_RESULT)).fields])
    return dealt.cogroup(told.groupBy("batch")).applyInArrow(cut, result)

