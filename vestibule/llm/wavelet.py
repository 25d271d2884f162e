"""Token ids as one compressed wavelet matrix per shard.

A shard's ids are split into bit-planes from the highest bit down; after each
plane the ids are parted stably by its bit, zeros first. The file has the count of ones
before every block of a plane and where each compressed block lies, so any id is read,
counted or found again from the few blocks it takes, without unpacking the others.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vestibule.llm.shared import map_arrow, record, slices, utf8, written
from vestibule.llm.token_ids import ENCODE_ROWS, encoder

END_ID = 2
SHARD_IDS = 1 << 20
MAGIC = b"WVM2"
# Magic, number of ids, of planes and of documents, and bytes of the documents' table. Then
# come the ones before each block, the end of each block, that table and the blocks.
_HEADER = struct.Struct("<4sQIII")
BLOCK_BYTES = 1 << 13
_BITS = 8 * BLOCK_BYTES
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


class WaveletMatrix:
    """Bit-planes of a sequence of ids, with rank and select.

    ``ranks[level, k]`` counts the ones before block ``k`` of a plane, with all of them at
    the end; ``load(level, k)`` gives a block, the lowest bit of a byte first.
    """

    def __init__(self, n: int, ranks: np.ndarray, load: Callable[[int, int], np.ndarray]):
        self.n, self.ranks, self.load = n, ranks, load
        self.zeros = [n - int(ones) for ones in ranks[:, -1]]

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        top = int(ids.max()).bit_length() if len(ids) else 0
        kind = np.uint16 if top <= 16 else np.uint32
        rest, planes = ids.astype(kind), []
        for bit in range(top - 1, -1, -1):
            ones = (rest >> kind(bit) & kind(1)).astype(bool)
            planes.append(np.packbits(ones, bitorder="little"))
            rest = np.concatenate([rest[~ones], rest[ones]])
        n_blocks = -(-len(ids) // _BITS)
        ranks = np.zeros((top, n_blocks + 1), np.uint32)
        for level, plane in enumerate(planes):
            counts = np.add.reduceat(_POPCOUNT[plane], range(0, len(plane), BLOCK_BYTES), dtype=np.uint32)
            np.cumsum(counts, out=ranks[level, 1:])
        return cls(len(ids), ranks, lambda level, k: planes[level][k * BLOCK_BYTES : (k + 1) * BLOCK_BYTES])

    @property
    def levels(self) -> int:
        return len(self.ranks)

    def ids(self) -> np.ndarray:
        """All ids in order."""
        rest = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            plane = np.concatenate([self.load(level, k) for k in range(self.ranks.shape[1] - 1)])
            ones = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            before = np.empty_like(rest)
            before[~ones] = rest[: self.zeros[level]]
            bit = rest.dtype.type(1 << self.levels - 1 - level)
            before[ones] = rest[self.zeros[level] :] | bit
            rest = before
        return rest.astype(np.uint32)

    def _blocks(self, block: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Each block in use, and which entries use it."""
        for k in np.unique(block).tolist():
            yield k, np.flatnonzero(block == k)

    def _rank_bits(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ones before each place of a plane, and the bit there (0 behind the end)."""
        ones, bits = np.empty(len(at), np.int64), np.zeros(len(at), np.int64)
        for k, own in self._blocks(at // _BITS):
            ones[own] = self.ranks[level, k]
            if k < self.ranks.shape[1] - 1:
                plane, inside = self.load(level, k), at[own] - k * _BITS
                full = np.concatenate([[0], np.cumsum(_POPCOUNT[plane], dtype=np.int64)])
                last = np.append(plane, np.uint8(0))[inside // 8].astype(np.int64)
                ones[own] += full[inside // 8] + _POPCOUNT[last & ((1 << inside % 8) - 1)]
                bits[own] = last >> inside % 8 & 1
        return ones, bits

    def _select_bits(self, level: int, k: np.ndarray, bit: int) -> np.ndarray:
        """The place of the ``k``-th bit of a kind on a plane."""
        before = self.ranks[level].astype(np.int64)
        if not bit:
            before = np.minimum(np.arange(len(before)) * _BITS, self.n) - before
        out, block = np.empty(len(k), np.int64), np.searchsorted(before, k, "right") - 1
        for b, own in self._blocks(block):
            width = min(_BITS, self.n - b * _BITS)
            plane = np.unpackbits(self.load(level, b), count=width, bitorder="little")
            out[own] = b * _BITS + np.flatnonzero(plane == bit)[k[own] - before[b]]
        return out

    def access_all(self, at: np.ndarray) -> np.ndarray:
        """The ids at some places."""
        value = np.zeros(len(at), np.int64)
        for level in range(self.levels):
            ones, bits = self._rank_bits(level, at)
            at = np.where(bits == 1, self.zeros[level] + ones, at - ones)
            value = value << 1 | bits
        return value

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        return int(self.access_all(np.array([at]))[0])

    def _bits_of(self, value: int) -> list[int] | None:
        if value < 0 or value.bit_length() > self.levels:
            return None
        return [value >> b & 1 for b in range(self.levels - 1, -1, -1)]

    def _range(self, value: int, at: int) -> tuple[int, int]:
        """Where the ids equal to ``value`` before ``at`` lie behind the last plane."""
        bits = self._bits_of(value)
        if bits is None:
            return 0, 0
        ends = np.array([0, min(max(at, 0), self.n)])
        for level, bit in enumerate(bits):
            ones, _ = self._rank_bits(level, ends)
            ends = self.zeros[level] + ones if bit else ends - ones
        return int(ends[0]), int(ends[1])

    def rank(self, value: int, at: int) -> int:
        """How often ``value`` stands before position ``at``."""
        start, end = self._range(value, at)
        return end - start

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def find_all(self, value: int) -> np.ndarray:
        """Every position of ``value``, in order: up from the last plane, all at once."""
        at = np.arange(*self._range(value, self.n))
        for level in range(self.levels - 1, -1, -1):
            if not len(at):
                break
            bit = self._bits_of(value)[level]
            at = self._select_bits(level, at - self.zeros[level] * bit, bit)
        return at

    def select(self, value: int, k: int) -> int:
        """The position of the ``k``-th ``value``, from 0."""
        start, end = self._range(value, self.n)
        if not 0 <= k < end - start:
            raise IndexError(k)
        at = np.array([start + k])
        for level in range(self.levels - 1, -1, -1):
            bit = self._bits_of(value)[level]
            at = self._select_bits(level, at - self.zeros[level] * bit, bit)
        return int(at[0])

    def find(self, value: int) -> Iterator[int]:
        return iter(self.find_all(value).tolist())


def write_shard(ids: np.ndarray, doc_ids: np.ndarray, valid: np.ndarray, ends: np.ndarray) -> bytes:
    """A shard file: ids of its documents, where each one ends, and the planes in blocks."""
    matrix, pack = WaveletMatrix.of(ids), zstandard.ZstdCompressor(level=1).compress
    table = [doc_ids.astype("<i8"), valid.astype(np.uint8), np.diff(ends, prepend=0).astype("<u4")]
    docs = pack(b"".join(column.tobytes() for column in table))
    n_blocks = matrix.ranks.shape[1] - 1
    blocks = [
        pack(matrix.load(level, k).tobytes()) for level in range(matrix.levels) for k in range(n_blocks)
    ]
    offsets = np.cumsum([0, *map(len, blocks)]).astype("<u4")
    header = _HEADER.pack(MAGIC, matrix.n, matrix.levels, len(doc_ids), len(docs))
    return b"".join([header, matrix.ranks.astype("<u4").tobytes(), offsets.tobytes(), docs, *blocks])


class ShardFile:
    """A shard file that unpacks what is asked for, and counts the bytes it reads for it."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)
        magic, n, levels, self.n_docs, self.docs_size = _HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a shard file")
        self.n_blocks = -(-n // _BITS)
        ranks = np.frombuffer(data, "<u4", levels * (self.n_blocks + 1), _HEADER.size)
        at = _HEADER.size + ranks.nbytes
        self.offsets = np.frombuffer(data, "<u4", levels * self.n_blocks + 1, at)
        self.docs_at = at + self.offsets.nbytes
        self.bytes_read, self.blocks = self.docs_at, {}
        ranks = ranks.reshape(levels, self.n_blocks + 1)
        self.matrix = WaveletMatrix(n, ranks, self.block)
        self.unpack = zstandard.ZstdDecompressor().decompress

    def block(self, level: int, k: int) -> np.ndarray:
        number = level * self.n_blocks + k
        if number not in self.blocks:
            start, end = self.offsets[number : number + 2].tolist()
            first = self.docs_at + self.docs_size
            self.bytes_read += end - start
            packed = self.data[first + start : first + end]
            self.blocks[number] = np.frombuffer(self.unpack(packed), np.uint8)
        return self.blocks[number]

    def docs(self) -> tuple[list, np.ndarray]:
        """The document ids (None for null ones) and where each document ends."""
        self.bytes_read += self.docs_size
        n = self.n_docs
        table = self.unpack(self.data[self.docs_at : self.docs_at + self.docs_size])
        ids, valid = np.frombuffer(table, "<i8", n), np.frombuffer(table, np.uint8, n, 8 * n)
        ends = np.cumsum(np.frombuffer(table, "<u4", n, 9 * n).astype(np.int64))
        return [d if v else None for d, v in zip(ids.tolist(), valid.tolist(), strict=True)], ends


def read_shard(data: bytes) -> tuple[WaveletMatrix, list, np.ndarray]:
    """The matrix, the document ids (None for null ones) and where each document ends."""
    file = ShardFile(data)
    return file.matrix, *file.docs()


_SHARDS = pa.schema(
    [("part", pa.int64()), ("shard", pa.int64()), ("n_ids", pa.int64()), ("file", pa.binary())]
)


def write_token_shards(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    end_id: int = END_ID,
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """``(part, shard, n_ids, file)``: the ids of all texts in ascending order of doc_id.

    ``part`` and ``shard`` number the files in that order. A file ends with the
    document that reaches ``shard_ids`` ids; a longer document, up to the longest text, has
    a file of its own size. A null or empty text is the end id alone. Rows without an id come
    first; rows that share one follow each other in the order of their bytes. An
    empty table gives no file. Other columns are not read. A task holds one shard.
    """

    def encode(batches):
        part, shard = TaskContext.get().partitionId(), 0
        ids, doc_ids, sizes, held = [], [], [], 0

        def closed():
            known = np.array([d is not None for d in doc_ids])
            numbers = np.array([d if d is not None else 0 for d in doc_ids], np.int64)
            data = write_shard(np.concatenate(ids), numbers, known, np.cumsum(sizes))
            return pa.RecordBatch.from_pydict(
                {"part": [part], "shard": [shard], "n_ids": [held], "file": [data]}, schema=_SHARDS
            )

        for rows in slices(batches, ENCODE_ROWS):
            found, first = encoder(tokenizer).encode(rows["raw"])
            for i, doc_id in enumerate(rows["doc_id"]):
                own = np.append(found[first[i] : first[i + 1]], np.uint32(end_id))
                ids.append(own)
                doc_ids.append(doc_id)
                sizes.append(len(own))
                held += len(own)
                if held >= shard_ids:
                    yield closed()
                    ids, doc_ids, sizes, held = [], [], [], 0
                    shard += 1
        if doc_ids:
            yield closed()

    rows = docs.select("doc_id", utf8(F.col(text)).alias("raw"))
    in_order = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "raw")
    return map_arrow(in_order, encode, _SHARDS)


_READ = pa.schema(
    [
        ("part", pa.int64()),
        ("shard", pa.int64()),
        ("doc_id", pa.int64()),
        ("within", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


def _read_files(batches):
    for rows in slices(batches, 1):
        matrix, docs, ends = read_shard(rows["file"][0])  # all of it is wanted
        raw = memoryview(matrix.ids().astype("<u4")).cast("B")
        starts = [0, *ends.tolist()[:-1]]
        yield pa.RecordBatch.from_pydict(
            {
                "part": rows["part"] * len(docs),
                "shard": rows["shard"] * len(docs),
                "doc_id": docs,
                "within": starts,
                "n_tokens": (ends - starts).tolist(),
                "ids_crc32": [
                    zlib.crc32(raw[4 * s : 4 * e])
                    for s, e in zip(starts, ends.tolist(), strict=True)
                ],
            },
            schema=_READ,
        )


def shard_bases(shards: DataFrame) -> DataFrame:
    """``(part, shard, base, n_ids)``: how many ids all shards before each one have.

    Per part its files in order, then the parts, of which there are as many as there
    were tasks.
    """
    back = Window.unboundedPreceding
    in_part = Window.partitionBy("part").orderBy("shard").rowsBetween(back, -1)
    sizes = shards.select(
        "part", "shard", "n_ids", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0)).alias("in_part")
    )
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(back, -1)
    bases = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    base = (F.col("before") + F.col("in_part")).alias("base")
    return sizes.join(bases, "part").select("part", "shard", base, "n_ids")


def read_token_shards(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, read from the files.

    ``start`` counts the ids of all documents before.
    """
    rows = map_arrow(shards.select("part", "shard", "file"), _read_files, _READ)
    starts = shard_bases(shards).drop("n_ids")
    return rows.join(starts.hint("merge"), ["part", "shard"]).select(
        "doc_id",
        (F.col("base") + F.col("within")).cast("bigint").alias("start"),
        "n_tokens",
        "ids_crc32",
    )


_TOKENS = pa.schema([("position", pa.int64()), ("token", pa.int64()), ("bytes_read", pa.int64())])
_TOTALS = pa.schema([("token", pa.int64()), ("n", pa.int64()), ("bytes_read", pa.int64())])


def token_at(shards: DataFrame, places: DataFrame, shard_ids: int = SHARD_IDS) -> DataFrame:
    """``(position, token, bytes_read)`` for the distinct ``position`` s of ``places``.

    A position counts ids over all shards, as ``start`` does. Null positions and those
    without an id give no row. Each file unpacks only the blocks that its positions lead
    through; ``bytes_read`` says how many bytes of the file that took, for all of them.
    """
    bases = shard_bases(shards)
    cell = lambda at: F.floor(at / F.lit(shard_ids)).cast("bigint")
    last = F.col("base") + F.col("n_ids") - 1
    cells = bases.withColumn("cell", F.explode(F.sequence(cell(F.col("base")), cell(last))))
    asked = places.select("position").distinct().withColumn("cell", cell(F.col("position")))
    inside = (F.col("position") >= F.col("base")) & (F.col("position") <= last)
    # At most as many as the shard has ids.
    lists = (
        asked.join(cells, "cell").filter(inside)
        .groupBy("part", "shard", "base")
        .agg(F.collect_list("position").alias("positions"))
    )

    def read(batches):
        for rows in slices(batches, 1):
            file, base = ShardFile(rows["file"][0]), rows["base"][0]
            at = np.sort(np.array(rows["positions"][0], np.int64))
            found = file.matrix.access_all(at - base)
            read_for = np.full(len(at), file.bytes_read)
            yield record(_TOKENS, position=at, token=found, bytes_read=read_for)

    files = shards.select("part", "shard", "file").join(lists, ["part", "shard"])
    return map_arrow(files.select("file", "base", "positions"), read, _TOKENS)


def count_tokens(shards: DataFrame, tokens: Sequence[int]) -> DataFrame:
    """``(token, n, bytes_read)``: how often each of ``tokens`` stands in all shards.

    Two places per plane are looked up in each file. Tokens that stand nowhere count 0.
    """
    wanted = sorted(set(tokens))

    def count(batches):
        for rows in slices(batches, 1):
            file = ShardFile(rows["file"][0])
            found = [file.matrix.count(token) for token in wanted]
            yield record(_TOTALS, token=wanted, n=found, bytes_read=[file.bytes_read] * len(wanted))

    per_shard = map_arrow(shards.select("file"), count, _TOTALS)
    return per_shard.groupBy("token").agg(
        F.sum("n").alias("n"), F.sum("bytes_read").alias("bytes_read")
    )


def find_tokens(shards: DataFrame, tokens: Sequence[int]) -> DataFrame:
    """``(position, token, bytes_read)``: every place of each of ``tokens`` in all shards."""
    wanted = sorted(set(tokens))

    def find(batches):
        for rows in slices(batches, 1):
            file, base = ShardFile(rows["file"][0]), rows["base"][0]
            for token in wanted:
                at = file.matrix.find_all(token) + base
                same = [np.full(len(at), value) for value in (token, file.bytes_read)]
                yield record(_TOKENS, position=at, token=same[0], bytes_read=same[1])

    files = shards.select("part", "shard", "file").join(shard_bases(shards), ["part", "shard"])
    return map_arrow(files.select("file", "base"), find, _TOKENS)


def token_shards(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write the shard files to the shared folder and read them back."""
    shards = write_token_shards(docs, tokenizer, **options)
    return read_token_shards(written(shards, "token-shards"))
