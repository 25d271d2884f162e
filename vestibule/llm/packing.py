"""Best-fit packing of documents into sequences after Martello-Toth dominance reduction.

Only the lengths of the pieces matter, and there are at most as many lengths as
a sequence has tokens: the packing is worked out on the histogram of lengths,
whatever the number of pieces, as a plan that says which ranks of a length go to
which sequences. Every piece then finds its place by its rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vestibule.llm.shared import map_arrow, slices, utf8, written
from vestibule.llm.token_ids import ENCODE_ROWS, encoder

CAPACITY = 4096
END_ID = 1


@dataclass
class Plan:
    """Slots ``(length, first rank, ranks, first sequence, offset)`` for whole runs of pieces."""

    capacity: int
    left: dict[int, int]
    lengths: list[int] = field(init=False)
    next_rank: Counter = field(default_factory=Counter)
    slots: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    sequences: int = 0

    def __post_init__(self):
        self.left = {length: n for length, n in self.left.items() if n > 0}
        if any(not 0 < length <= self.capacity for length in self.left):
            raise ValueError("a piece does not fit a sequence")
        self.lengths = sorted(self.left)

    def put(self, length: int, n: int, sequence: int, offset: int) -> None:
        """The next ``n`` pieces of ``length`` go to ``n`` neighbouring sequences."""
        self.slots.append((length, self.next_rank[length], n, sequence, offset))
        self.next_rank[length] += n
        self.left[length] -= n
        if not self.left[length]:
            del self.left[length]
            self.lengths.pop(bisect_left(self.lengths, length))

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def fix(self, items: list[int]) -> bool:
        """Put ``items`` together as often as there are pieces for it."""
        times = min(self.left.get(x, 0) // k for x, k in Counter(items).items())
        if not times:
            return False
        first, offset = self.open(times), 0
        for length in items:
            self.put(length, times, first, offset)
            offset += length
        return True

    def fitting(self, room: int, without: Counter) -> int | None:
        """The longest length up to ``room`` with a piece left beside ``without``."""
        for i in range(bisect_right(self.lengths, room) - 1, -1, -1):
            if self.left[self.lengths[i]] > without[self.lengths[i]]:
                return self.lengths[i]
        return None

    def shortest(self, without: int, n: int) -> list[int]:
        """The ``n`` shortest pieces left beside one of length ``without``."""
        found: list[int] = []
        for length in self.lengths:
            found += [length] * min(n - len(found), self.left[length] - (length == without))
            if len(found) == n:
                break
        return found


def reduce_dominated(plan: Plan) -> None:
    """Fix every set of up to three pieces that provably dominates all others with its longest.

    A set dominates another when the other's pieces can be grouped so that each
    group fits into a piece of the first. With the longest piece ``x`` and room ``r``:

    * nothing else fits: ``x`` alone;
    * a piece fills ``r`` exactly: with it;
    * no two more fit: with the longest that fits;
    * no three more fit, and beside the longest ``a`` that fits the next one ``b``
      is no shorter than any piece up to half of ``r``: with both.

    A fixed set never costs a sequence more than the best packing. Removing pieces
    can make more sets dominate, so passes follow until none is fixed.
    """
    changed = True
    while changed:
        changed = False
        for x in reversed(plan.lengths.copy()):
            while plan.left.get(x) and (items := _dominating(plan, x)):
                changed |= plan.fix(items)


def _dominating(plan: Plan, x: int) -> list[int] | None:
    room, one = plan.capacity - x, Counter([x])
    a = plan.fitting(room, one)
    if a is None:
        return [x]
    if a == room:
        return [x, a]
    few = plan.shortest(x, 3)
    if len(few) < 2 or few[0] + few[1] > room:
        return [x, a]
    if len(few) < 3 or sum(few) > room:
        b = plan.fitting(room - a, Counter([x, a]))
        half = plan.fitting(room // 2, one)
        if b is not None and half is not None and b >= half:
            return [x, a, b]
    return None


def best_fit(plan: Plan) -> None:
    """Longest first, each into the fullest sequence that has room, else into a new one.

    Sequences with equal room form runs and are filled a run at a time.
    """
    rooms: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, how many)

    def add(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append((first, n))

    while plan.lengths:
        x = plan.lengths[-1]
        at = bisect_left(rooms, x)
        if at < len(rooms):
            room = rooms[at]
            first, n = runs[room].pop()
            if not runs[room]:
                del runs[room]
                rooms.pop(at)
            some = min(n, plan.left[x])
            plan.put(x, some, first, plan.capacity - room)
            add(room - x, first, some)
            add(room, first + some, n - some)
        else:
            each = min(plan.capacity // x, plan.left[x])
            n = plan.left[x] // each
            first = plan.open(n)
            for k in range(each):
                plan.put(x, n, first, k * x)
            add(plan.capacity - each * x, first, n)


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan for a histogram of lengths."""
    plan = Plan(capacity, dict(counts))
    reduce_dominated(plan)
    best_fit(plan)
    return plan


_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("task", pa.int64()),
        ("rank", pa.int64()),
    ]
)


def cut_pieces(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, task, rank)`` of every document's pieces.

    ``rank`` counts the pieces of equal length within a task, from 0.
    """

    def cut(batches):
        task, seen = TaskContext.get().partitionId(), Counter()
        for rows in slices(batches, ENCODE_ROWS):
            found, first = encoder(tokenizer).encode(rows["raw"])
            out = {name: [] for name in _PIECES.names}
            for i, doc_id in enumerate(rows["doc_id"]):
                own = np.append(found[first[i] : first[i + 1]], np.uint32(end_id)).astype("<u4")
                for piece, start in enumerate(range(0, len(own), capacity)):
                    ids = own[start : start + capacity]
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(ids.tobytes()))
                    out["task"].append(task)
                    out["rank"].append(seen[len(ids)])
                    seen[len(ids)] += 1
            yield pa.RecordBatch.from_pydict(out, schema=_PIECES)

    return map_arrow(docs.select("doc_id", utf8(F.col(text)).alias("raw")), cut, _PIECES)


_PLACED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` per piece.

    Documents longer than ``capacity`` ids are cut, others never. Null and empty
    texts are the end id alone; very long ones are encoded whole, by one task. Equal
    lengths go in any order; repeated rows and ids are packed once each; an empty table
    gives no sequence; other columns are not read. The driver sees the histogram, at most ``capacity`` rows, and the
    plan has a few times as many slots.
    """
    pieces = written(cut_pieces(docs, tokenizer, text, capacity, end_id), "pieces")
    counts = written(pieces.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    histogram = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()
    plan = pack_lengths({row.length: row.n for row in histogram}, capacity)
    slots = np.array(sorted(plan.slots), np.int64).reshape(-1, 5)
    keys = (slots[:, 0] << 44) + slots[:, 1]

    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = counts.select(
        "task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank, base = (
                batch.column(c).to_numpy() for c in ("length", "rank", "base")
            )
            rank = rank + base
            slot = slots[np.searchsorted(keys, (length << 44) + rank, "right") - 1]
            columns = {name: batch.column(name) for name in _PLACED.names[:5]}
            columns["sequence_id"] = pa.array(slot[:, 3] + rank - slot[:, 1])
            columns["offset"] = pa.array(slot[:, 4])
            yield pa.RecordBatch.from_pydict(columns, schema=_PLACED)

    # There are as many bases as tasks times lengths: never a broadcast.
    return map_arrow(pieces.join(bases.hint("merge"), ["task", "length"]), place, _PLACED)
