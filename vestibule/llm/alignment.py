"""Which tokens of two tokenizers cover the same bytes of a text.

The tokens of A and of B each cut the bytes of a text; where both cut, a group ends.
A fragment of the alignment is what a range of the text settles by itself: closed
groups between the first and the last place where both cut, an open prefix before and
an open suffix behind. Fragments of neighbouring ranges compose: the suffix of one and
the prefix of the next make a gap, which closes what the two sides together decide.
Composing is associative, so the chunks of a very long text are encoded by different
tasks and their fragments, without the closed groups, are reduced in a tree; the
groups that a gap closes join those closed before. A text of one chunk is one fragment
with nothing open.

A-B pairs are counted over all texts by an exchange of packed arrays: every batch sends
its distinct pairs with the number of texts that hold them to the bucket of the A id,
and gets back how many texts hold each and whether no pair of that A id has more.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vestibule.llm import packed
from vestibule.llm.pieces import SPACE, piece_model
from vestibule.llm.shared import (
    byte_slices,
    ddl,
    map_arrow,
    record,
    slices,
    utf8,
    written,
    written_and_counted,
)
from vestibule.llm.words import mix

# Characters of a chunk, bytes of text in a batch, and fragments composed at a time.
CHUNK = 1 << 16
BATCH_BYTES = 2 << 20
FAN_IN = 8
# Batches that send their pairs to one task, and bytes of text per bucket of A ids.
SALT_BATCHES = 4096
BUCKET_BYTES = 32 << 20
# Bits of an id, and of the number of a run among those of a batch.
ID_BITS, RUN_BITS = np.uint64(20), np.uint64(24)
# The first number of a batch with runs of cut texts.
CUT = 1 << 62

# The splitting pattern of the byte-level vocabulary, and the printable
# characters that stand for themselves in it; the other bytes follow from U+0100 on.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


class ByteModel:
    """A byte-level vocabulary file; its ids in order are its merges in order."""

    # Where a text may be cut without changing its tokens: the pattern has no match that
    # goes from a visible character to a space, or from a letter to punctuation or a digit.
    cut = re.compile(r"(?<=\S)(?=[ \t\n\r])|(?<=[A-Za-z぀-ヿ一-龥가-힣])(?=[!-@\[-`{-~、。])")

    def __init__(self, path: str):
        import tiktoken

        others = (b for b in range(256) if b not in set(PRINTABLE))
        of_char = {chr(b): b for b in PRINTABLE} | {chr(256 + k): b for k, b in enumerate(others)}
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        special = {token["id"] for token in stored["added_tokens"]}
        entries = ((e, i) for e, i in stored["model"]["vocab"].items() if i not in special)
        ranks = {bytes(map(of_char.__getitem__, entry)): i for entry, i in entries}
        self.encoding = tiktoken.Encoding(
            "bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.raws = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self.raws[i] = raw

    def encode(self, text: str) -> np.ndarray:
        ids = self.encoding.encode_to_numpy(text, disallowed_special=())
        return np.asarray(ids).astype(np.int32)


class Sides:
    """Both vocabularies, with the bytes of every token."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteModel(byte_path), piece_model(piece_path)
        self.sizes = [np.array([*map(len, m.raws)], np.int64) for m in (self.a, self.b)]
        # Every token with the sign that stands before it: a group's first A id has ";",
        # its first B id "|", all others ",". Those of B follow those of A.
        self.behind_a = 2 * len(self.a.raws)
        self.shown = [f"{sign}{i}" for sign in ",;" for i in range(len(self.a.raws))]
        self.shown += [f"{sign}{i}" for sign in ",|" for i in range(len(self.b.raws))]

    def encode(self, a_text: str, b_text: str, b: np.ndarray | None = None):
        """Ids of both; none if the bytes of their tokens are not those of the texts."""
        a = self.a.encode(a_text)
        b = self.b.encode_as_is([b_text.replace(" ", SPACE)])[0] if b is None else b
        # A's tokens are pieces of the text itself, so their length tells; B's may have a
        # space for another sign.
        if self.sizes[0][a].sum() != len(a_text.encode()):
            return None
        if b"".join(map(self.b.raws.__getitem__, b.tolist())) != b_text.encode():
            return None
        return a, b


@cache
def sides(byte_path: str, piece_path: str) -> Sides:
    return Sides(byte_path, piece_path)


@dataclass
class Gap:
    """Tokens of both sides from ``starts`` on: bytes of the text, one start per side."""

    starts: tuple[int, int]
    ids: tuple[np.ndarray, np.ndarray]

    def split(self, sizes) -> tuple[Gap, Gap, Gap] | None:
        """What lies before, between and behind the places where both sides cut, if any.

        The parts before and behind are open, the middle is closed at both ends.
        """
        edges = [
            np.cumsum(np.concatenate([[start], size[ids]]))
            for start, ids, size in zip(self.starts, self.ids, sizes, strict=True)
        ]
        both = np.intersect1d(*edges)
        if not len(both):
            return None
        first, last = int(both[0]), int(both[-1])
        at = [np.searchsorted(edge, (first, last)) for edge in edges]
        before, inside, behind = (
            tuple(ids[part(k)] for ids, k in zip(self.ids, at, strict=True))
            for part in (
                lambda k: slice(0, k[0]),
                lambda k: slice(k[0], k[1]),
                lambda k: slice(k[1], None),
            )
        )
        return Gap(self.starts, before), Gap((first, first), inside), Gap((last, last), behind)

    def __add__(self, behind: Gap) -> Gap:
        joined = tuple(np.concatenate(two) for two in zip(self.ids, behind.ids, strict=True))
        return Gap(self.starts, joined)


@dataclass
class Fragment:
    """A range of a text: its open prefix and suffix; no suffix if no place closes a group.

    The closed groups between the two lie elsewhere. ``right.starts`` is where they end.
    """

    ok: bool
    left: Gap
    right: Gap | None

    @staticmethod
    def of(gap: Gap, sizes, ok: bool = True) -> tuple[Fragment, Gap | None]:
        """The fragment of encoded tokens, and the run of groups that it closes."""
        parts = gap.split(sizes)
        if parts is None:
            return Fragment(ok, gap, None), None
        return Fragment(ok, parts[0], parts[2]), parts[1]

    def then(self, behind: Fragment, sizes) -> tuple[Fragment, Gap | None]:
        """This fragment and the one behind it as one, and the run of groups that closes."""
        gap = (self.left if self.right is None else self.right) + behind.left
        middle, run = Fragment.of(gap, sizes)
        left = middle.left if self.right is None else self.left
        right = middle.right if behind.right is None else behind.right
        return Fragment(self.ok and behind.ok, left, right), run


# Runs of closed groups, many to a row: which text each belongs to and where it starts,
# how many tokens it has, and all ids packed. Runs of cut texts have the row's number.
_RUNS = pa.schema(
    [
        ("batch", pa.int64()),
        ("doc_id", pa.list_(pa.int64())),
        ("rid", pa.list_(pa.int64())),
        ("start", pa.list_(pa.int64())),
        ("n_a", pa.list_(pa.int64())),
        ("n_b", pa.list_(pa.int64())),
        ("a", pa.binary()),
        ("b", pa.binary()),
    ]
)


def _numbered(first: int) -> Iterator[int]:
    """Numbers for the batches of a task, apart from those of all other tasks."""
    number = first + (TaskContext.get().partitionId() << 32)
    while True:
        yield number
        number += 1


def _pack_runs(number: int, runs: list[tuple]) -> pa.RecordBatch:
    """One row from ``(doc_id, rid, start, a ids, b ids)``."""
    columns = list(zip(*runs, strict=True))
    empty = np.empty(0, np.int32)
    sizes = {f"n_{side}": [[len(ids) for ids in columns[k]]] for side, k in (("a", 3), ("b", 4))}
    ids = {side: [packed.pack(np.concatenate([empty, *columns[k]]))] for side, k in (("a", 3), ("b", 4))}
    heads = {name: [list(columns[k])] for k, name in enumerate(("doc_id", "rid", "start"))}
    return record(_RUNS, batch=[number], **heads, **sizes, **ids)


class Runs:
    """One such row: its groups and its links, for all runs at once.

    A run ends where both sides cut, so the runs may stand one behind another as if they
    were one text. Between two neighbouring cuts of either side there is one link.
    """

    def __init__(self, row: dict, sizes):
        self.row = row
        self.ids = [packed.unpack(row[side], np.int32) for side in "ab"]
        ends = [np.cumsum(size[ids]) for size, ids in zip(sizes, self.ids, strict=True)]
        self.first = [np.cumsum([0, *row[f"n_{side}"]]) for side in "ab"]
        last = np.concatenate([[0], ends[0]])[self.first[0]]
        # Every byte that ends a token of A, of B or of both, as 1, 2 or 3.
        marks = np.zeros(int(last[-1]) + 1, np.uint8)
        marks[ends[0]] = 1
        marks[ends[1]] += 2
        cuts = np.flatnonzero(marks)
        self.first_cut = np.searchsorted(cuts, last, "right")
        self.marks = marks[cuts]

    def _before(self, of: np.ndarray) -> np.ndarray:
        """For each cut how many of the cuts before it are ``of`` a kind."""
        return np.cumsum(of, dtype=np.int32) - of

    def links(self) -> np.ndarray:
        """The pair of each link: the A id above the B id."""
        a, b = (ids[self._before(self.marks >> k & 1)] for k, ids in enumerate(self.ids))
        return a.astype(np.uint64) << np.uint64(32) | b.astype(np.uint64)

    def held(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that each run holds, once each, by pair; and the runs."""
        links = self.links()
        run = np.repeat(np.arange(len(self.first_cut) - 1), np.diff(self.first_cut))
        # Both ids and the run in one number, which sorts fast.
        a, b = links >> np.uint64(32), links & np.uint64(0xFFFFFFFF)
        both = np.sort(((a << ID_BITS) | b) << RUN_BITS | run.astype(np.uint64))
        both = both[np.append(True, both[1:] != both[:-1])[: len(both)]]
        pair, run = both >> RUN_BITS, both & ((np.uint64(1) << RUN_BITS) - np.uint64(1))
        b = pair & ((np.uint64(1) << ID_BITS) - np.uint64(1))
        return (pair >> ID_BITS) << np.uint64(32) | b, run.astype(np.int64)

    def holdings(self) -> tuple[np.ndarray, np.ndarray]:
        """The pairs, sorted, and how many runs hold each."""
        held, _ = self.held()
        first = np.flatnonzero(np.append(True, held[1:] != held[:-1])[: len(held)])
        return held[first], np.diff(np.append(first, len(held)))

    def per_run(self, values: np.ndarray) -> np.ndarray:
        """The sum over every run's cuts."""
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return np.diff(total[self.first_cut])

    def texts(self, models: Sides) -> list[str]:
        """The groups of every run as text: ``a1,a2|b1;a3|b2,b3``."""
        own = self._before(self.marks == 3)
        (a, b), (group_a, group_b) = self.ids, (own[(self.marks & k) > 0] for k in (1, 2))
        n_groups = int(own[-1]) + 1 if len(own) else 0
        before = [
            np.concatenate([[0], np.cumsum(np.bincount(g, minlength=n_groups))])
            for g in (group_a, group_b)
        ]
        opens = [np.diff(g, prepend=-1) > 0 for g in (group_a, group_b)]
        codes = np.empty(len(a) + len(b), np.int32)
        codes[np.arange(len(a)) + before[1][group_a]] = a + opens[0] * len(models.a.raws)
        codes[np.arange(len(b)) + before[0][group_b + 1]] = (
            b + opens[1] * len(models.b.raws) + models.behind_a
        )
        first = (self.first[0] + self.first[1]).tolist()
        shown = models.shown
        return [
            "".join(map(shown.__getitem__, codes[s:e].tolist()))[1:]
            for s, e in zip(first[:-1], first[1:], strict=True)
        ]


# --- The chunks of very long texts. ---

_CHUNKS = pa.schema(
    [
        ("rid", pa.int64()),
        ("node", pa.int64()),
        ("a_start", pa.int64()),
        ("b_start", pa.int64()),
        ("a_raw", pa.binary()),
        ("b_raw", pa.binary()),
    ]
)
_IDS = pa.list_(pa.int32())
_FRAGMENTS = pa.schema(
    [
        ("rid", pa.int64()),
        ("node", pa.int64()),
        ("run", pa.bool_()),
        ("ok", pa.bool_()),
        ("a_start", pa.int64()),
        ("b_start", pa.int64()),
        ("left_a", _IDS),
        ("left_b", _IDS),
        ("right_start", pa.int64()),
        ("right_a", _IDS),
        ("right_b", _IDS),
    ]
)


def _row_of(rid: int, node: int, found: Fragment) -> dict:
    (a_start, b_start), (left_a, left_b) = found.left.starts, found.left.ids
    row = {"rid": rid, "node": node, "run": False, "ok": found.ok, "a_start": a_start}
    row |= {"b_start": b_start, "left_a": left_a, "left_b": left_b}
    if found.right is not None:
        right_a, right_b = found.right.ids
        row |= {"right_start": found.right.starts[0], "right_a": right_a, "right_b": right_b}
    return row


def _rows_of(rid: int, node: int, found: Fragment, runs: list[Gap | None]) -> Iterator[dict]:
    """A fragment as a row, behind rows of the runs it has closed; a run has a left part only."""
    for run in runs:
        if run is not None and len(run.ids[0]):
            yield _row_of(rid, node, Fragment(True, run, None)) | {"run": True}
    yield _row_of(rid, node, found)


def _fragment_of(row: dict) -> Fragment:
    def gap(side: str, starts: tuple) -> Gap:
        ids = tuple(np.array(row[f"{side}_{which}"], np.int32) for which in "ab")
        return Gap(starts, ids)

    right = None
    if row["right_start"] is not None:
        right = gap("right", (row["right_start"], row["right_start"]))
    return Fragment(row["ok"], gap("left", (row["a_start"], row["b_start"])), right)


def _cut(model, text: str, at: int) -> int:
    """The first place from ``at`` on where ``model`` may cut."""
    found = model.cut.search(text, at)
    return found.start() if found else len(text)


def _long_runs(long: DataFrame, paths: tuple[str, str], chunk: int) -> tuple[DataFrame, DataFrame]:
    """``(rid, ok)`` of numbered texts, and all their closed runs, chunk by chunk."""

    def split(batches):
        models = sides(*paths)
        for rows in byte_slices(batches, "raw"):
            for rid, raw in zip(rows["rid"], rows["raw"], strict=True):
                text = " " + raw.decode("utf-8", "replace")
                # The piece model sees spaces by their sign.
                shown = (text, text.replace(" ", SPACE))
                cuts = [
                    [0] + [_cut(model, s, k) for k in range(chunk, len(text), chunk)] + [len(text)]
                    for model, s in zip((models.a, models.b), shown, strict=True)
                ]
                starts = [0, 0]
                for node in range(len(cuts[0]) - 1):
                    parts = [text[c[node] : c[node + 1]].encode() for c in cuts]
                    yield record(
                        _CHUNKS, rid=[rid], node=[node], a_start=[starts[0]],
                        b_start=[starts[1]], a_raw=[parts[0]], b_raw=[parts[1]],
                    )
                    starts = [s + len(p) for s, p in zip(starts, parts, strict=True)]

    def encode(batches):
        models = sides(*paths)
        for rows in byte_slices(batches, "a_raw"):
            out = []
            for rid, node, *starts, a_raw, b_raw in zip(*rows.values(), strict=True):
                ids = models.encode(a_raw.decode(), b_raw.decode())
                gap = Gap(tuple(starts), ids or (np.empty(0, np.int32),) * 2)
                found, run = Fragment.of(gap, models.sizes, ids is not None)
                out += _rows_of(rid, node, found, [run])
            yield pa.RecordBatch.from_pylist(out, schema=_FRAGMENTS)

    def compose(key: tuple, table: pa.Table) -> pa.Table:
        models, runs = sides(*paths), []
        rows = sorted(table.to_pylist(), key=lambda row: row["node"])
        found = _fragment_of(rows[0])
        for row in rows[1:]:
            found, run = found.then(_fragment_of(row), models.sizes)
            runs.append(run)
        node = rows[0]["node"] // FAN_IN
        return pa.Table.from_pylist(
            list(_rows_of(rows[0]["rid"], node, found, runs)), schema=_FRAGMENTS
        )

    chunks = map_arrow(long.select("rid", "raw"), split, _CHUNKS).repartition("rid", "node")
    level = written(map_arrow(chunks, encode, _FRAGMENTS), "fragments")
    runs, open_ones = level.filter("run"), level.filter("not run")
    last = open_ones.agg(F.max("node")).first()[0] or 0
    while last > 0:
        parent = F.floor(F.col("node") / FAN_IN).alias("parent")
        level = open_ones.groupBy("rid", parent).applyInArrow(compose, ddl(_FRAGMENTS))
        level = written(level, "fragments")
        runs, open_ones = runs.unionByName(level.filter("run")), level.filter("not run")
        last //= FAN_IN
    # Both sides start at 0 and end with the text, so a whole alignment has nothing open.
    nothing_open = (F.size("left_a") + F.size("left_b") + F.size("right_a") + F.size("right_b")) == 0
    ok = F.col("ok") & F.coalesce(nothing_open, F.lit(False))
    return open_ones.select("rid", ok.alias("ok")), runs


# --- How many texts hold a pair. ---

_REQUEST = pa.schema(
    [
        ("bucket", pa.int32()),
        ("salt", pa.int32()),
        ("batch", pa.int64()),
        ("found", pa.binary()),
        ("times", pa.binary()),
    ]
)
_ANSWER = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("answer", pa.binary())])


def _by_bucket(pairs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of sorted pairs by bucket, the buckets in use, and where each begins."""
    bucket = mix(pairs >> np.uint64(32)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    used, first = np.unique(bucket[order], return_index=True)
    return order, used.astype(np.int64), np.append(first, len(pairs))


def _requests(batch: int, pairs, times, buckets: int, salts: int) -> pa.RecordBatch:
    order, used, first = _by_bucket(pairs, buckets)
    parts = [order[s:e] for s, e in zip(first[:-1], first[1:], strict=True)]
    return record(
        _REQUEST,
        bucket=used,
        salt=[batch % salts] * len(used),
        batch=[batch] * len(used),
        found=[packed.pack_sorted(pairs[p]) for p in parts],
        times=[packed.pack(times[p].astype(np.uint64)) for p in parts],
    )


def _summed(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All distinct pairs of some requests, and their sums."""
    found = [packed.unpack_sorted(data) for data in table.column("found").to_pylist()]
    times = [packed.unpack(data, np.uint64) for data in table.column("times").to_pylist()]
    every = np.concatenate(found)
    order = np.argsort(every, kind="stable")  # they are sorted runs, which merge fast
    every = every[order]
    first = np.flatnonzero(np.append(True, every[1:] != every[:-1]))
    return every[first], np.add.reduceat(np.concatenate(times)[order], first)


def _sum_up(key: tuple, table: pa.Table) -> pa.Table:
    """The requests of many batches as one."""
    pairs, total = _summed(table)
    row = {"bucket": key[0].as_py(), "salt": key[1].as_py(), "batch": 0}
    row |= {"found": packed.pack_sorted(pairs), "times": packed.pack(total)}
    return pa.Table.from_pylist([row], schema=_REQUEST)


def _judge(key: tuple, table: pa.Table) -> pa.Table:
    """Twice the number of texts of each pair, and one more where its A id has no larger."""
    pairs, total = _summed(table)
    side = pairs >> np.uint64(32)
    first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
    most = np.repeat(np.maximum.reduceat(total, first), np.diff(np.append(first, len(pairs))))
    verdict = total * np.uint64(2) + (total == most)
    row = {"bucket": key[0].as_py(), "salt": 0, "batch": 0}
    row |= {"found": packed.pack_sorted(pairs), "times": packed.pack(verdict)}
    return pa.Table.from_pylist([row], schema=_REQUEST)


def _tell(asked: pa.Table, judged: pa.Table) -> pa.Table:
    """For each request the verdicts on its pairs."""
    if not asked.num_rows:  # a bucket and salt that nobody asked
        return pa.Table.from_pylist([], schema=_ANSWER)
    pairs = packed.unpack_sorted(judged.column("found")[0].as_py())
    verdict = packed.unpack(judged.column("times")[0].as_py(), np.uint64)
    rows = asked.select(["batch", "bucket", "found"]).to_pylist()
    answers = [verdict[np.searchsorted(pairs, packed.unpack_sorted(r["found"]))] for r in rows]
    return pa.table(
        {
            "batch": [r["batch"] for r in rows],
            "bucket": [r["bucket"] for r in rows],
            "answer": [packed.pack(a) for a in answers],
        },
        schema=_ANSWER,
    )


_HELD = pa.schema([("rid", pa.int64()), ("pair", pa.int64())])
_ALIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("rid", pa.int64()),
        ("start", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("n_best", pa.int64()),
        ("count_sum", pa.int64()),
        ("groups", pa.string()),
    ]
)


def _answers(
    runs: DataFrame, n_batches: int, total_bytes: int, paths: tuple[str, str]
) -> tuple[DataFrame, int]:
    """What every batch of runs learns about its pairs, and the number of buckets."""
    buckets = max(packed.LEAST, -(-total_bytes // BUCKET_BYTES))
    salts = max(1, n_batches // SALT_BATCHES)

    def ask(batches):
        models = sides(*paths)
        for rows in batches:
            for row in rows.to_pylist():
                pairs, times = Runs(row, models.sizes).holdings()
                if row["batch"] >= CUT:  # counted once per text, in whatever runs
                    times = np.zeros_like(times)
                yield _requests(row["batch"], pairs, times, buckets, salts)

    def hold(batches):
        """The pairs of runs of cut texts, with the text's number."""
        models = sides(*paths)
        for rows in batches:
            for row in rows.to_pylist():
                pair, run = Runs(row, models.sizes).held()
                rid = np.array(row["rid"], np.int64)[run]
                yield record(_HELD, rid=rid, pair=pair.astype(np.int64))

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        pairs, times = (table.column(c).to_numpy() for c in ("pair", "n"))
        order = np.argsort(pairs)
        asked = _requests(-1, pairs[order].astype(np.uint64), times[order], buckets, 1)
        return pa.Table.from_batches([asked])

    held = map_arrow(runs.filter(F.col("batch") >= CUT), hold, _HELD).distinct()
    held = held.groupBy("pair").agg(F.count("*").alias("n"))
    part = F.pmod(F.xxhash64(F.shiftright("pair", 32)), F.lit(buckets))
    extra = held.groupBy(part.alias("part")).applyInArrow(gather, ddl(_REQUEST))
    asked = written(map_arrow(runs, ask, _REQUEST), "pairs")
    summed = asked.unionByName(extra).groupBy("bucket", "salt").applyInArrow(_sum_up, ddl(_REQUEST))
    judged = summed.groupBy("bucket").applyInArrow(_judge, ddl(_REQUEST))
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    judged = written(judged, "pair-counts").select("bucket", "found", "times", every)
    told = asked.groupBy("bucket", "salt").cogroup(judged.groupBy("bucket", "salt"))
    return written(told.applyInArrow(_tell, ddl(_ANSWER)), "pair-answers"), buckets


@dataclass
class Alignment:
    """Rows ``(doc_id, rid, start, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)``.

    ``whole`` has a row per text that was not cut, with ``rid`` null and ``start`` 0.
    ``runs`` has a row per run of groups that a chunk of a cut text or a gap between
    chunks closes, with the text's number ``rid`` and the byte where the run starts, and
    one of zeros with its ``doc_id``.
    """

    whole: DataFrame
    runs: DataFrame


def align_tokens(
    docs: DataFrame, byte_path: str, piece_path: str, text: str = "text", chunk: int = CHUNK
) -> Alignment:
    """The groups of tokens of both vocabularies that cover the same bytes, for all texts.

    A is the byte-level vocabulary, B the piece vocabulary, both over a space and the
    whole text; a text of more than ``chunk`` bytes is cut. ``n_links`` counts overlapping
    tokens of A and B, ``n_best`` those whose pair is held by as many texts as any pair of
    that A id, ``count_sum`` sums how many texts hold the pair. Null and empty texts, and
    those that the tokens do not give back byte by byte (U+2581 in the text), are one row
    of zeros. Repeated rows and ids each count as a text; an empty table gives no rows;
    other columns are not read.
    """
    paths = (byte_path, piece_path)
    rows = docs.select(F.col("doc_id").cast("bigint"), utf8(F.col(text)).alias("raw"))
    size = F.octet_length("raw")
    total_bytes = rows.agg(F.sum(size)).first()[0] or 0

    def encode(batches):
        models, numbers = sides(*paths), _numbered(0)
        for rows in byte_slices(batches, "raw", BATCH_BYTES):
            texts = [raw.decode("utf-8", "replace") for raw in rows["raw"]]
            pieces = models.b.library.encode(texts, num_threads=1)
            runs = []
            for doc_id, text, b in zip(rows["doc_id"], texts, pieces, strict=True):
                shown = " " + text
                ids = models.encode(shown, shown, np.array(b, np.int32)) if text else None
                runs.append((doc_id, None, 0, *(ids or (np.empty(0, np.int32),) * 2)))
            yield _pack_runs(next(numbers), runs)

    def pack(batches):
        numbers = _numbered(CUT)
        for batch in batches:
            for at in range(0, batch.num_rows, 16):  # runs of at most a chunk, but for odd texts
                rows = batch.slice(at, 16).to_pydict()
                ids = [[np.array(i, np.int32) for i in rows[c]] for c in ("left_a", "left_b")]
                none = [None] * len(rows["rid"])
                parts = zip(none, rows["rid"], rows["a_start"], *ids, strict=True)
                yield _pack_runs(next(numbers), list(parts))

    number = F.monotonically_increasing_id().alias("rid")
    long = written(rows.filter(size > chunk).select(number, "doc_id", "raw"), "long-texts")
    texts, cut_runs = _long_runs(long, paths, chunk)
    whole = texts.filter("ok").select("rid")
    packed_runs = map_arrow(rows.filter(size <= chunk), encode, _RUNS).unionByName(
        map_arrow(
            cut_runs.join(whole, "rid", "left_semi").select("rid", "a_start", "left_a", "left_b"),
            pack,
            _RUNS,
        )
    )
    runs, n_batches = written_and_counted(packed_runs, "token-runs")
    answers, buckets = _answers(runs, n_batches, total_bytes, paths)

    def finish(table: pa.Table, told: pa.Table) -> pa.Table:
        models = sides(*paths)
        found = Runs(table.to_pylist()[0], models.sizes)
        links = found.links()
        pairs = np.unique(links)
        order, *_ = _by_bucket(pairs, buckets)
        parts = [packed.unpack(data, np.uint64) for data in packed.in_bucket_order(told)]
        verdict = np.empty(len(order), np.int64)
        verdict[order] = np.concatenate([np.empty(0, np.uint64), *parts]).astype(np.int64)
        verdict = verdict[np.searchsorted(pairs, links)]
        row = found.row
        return pa.table(
            {
                "doc_id": row["doc_id"],
                "rid": row["rid"],
                "start": row["start"],
                "n_a": row["n_a"],
                "n_b": row["n_b"],
                "n_groups": found.per_run(found.marks == 3),
                "n_links": np.diff(found.first_cut),
                "n_best": found.per_run(verdict & 1),
                "count_sum": found.per_run(verdict >> 1),
                "groups": found.texts(models),
            },
            schema=_ALIGNED,
        )

    # Both parts are run by themselves: whoever reads one does not pay for the other.
    whole, cut = (
        runs.filter(part).groupBy("batch").cogroup(answers.filter(part).groupBy("batch"))
        .applyInArrow(finish, ddl(_ALIGNED))
        for part in (F.col("batch") < CUT, F.col("batch") >= CUT)
    )
    # The ids of cut texts, once per text, so that one without tokens has its row too.
    zeros = [F.lit(0).cast("bigint").alias(c) for c in _ALIGNED.names[2:-1]]
    heads = long.select("doc_id", "rid", *zeros, F.lit("").alias("groups"))
    return Alignment(whole, cut.unionByName(heads))


_COUNTS = _ALIGNED.names[3:-1]
_WHOLE = pa.schema([_ALIGNED.field(0), *[_ALIGNED.field(c) for c in _COUNTS], ("groups_sha256", pa.string())])


def _put_together(batches):
    """One row per text from its runs, which come in order; holds a digest at a time."""
    rid, counts, doc_id, digest = None, [], None, None

    def done() -> pa.RecordBatch:
        row = {"doc_id": doc_id, "groups_sha256": digest.hexdigest() if counts[0] else ""}
        row |= dict(zip(_COUNTS, counts, strict=True))
        return pa.RecordBatch.from_pylist([row], schema=_WHOLE)

    for rows in slices(batches, 64):
        for k, number in enumerate(rows["rid"]):
            if number != rid:
                if rid is not None:
                    yield done()
                rid, counts, doc_id, digest = number, [0] * len(_COUNTS), None, hashlib.sha256()
            if rows["n_a"][k]:
                digest.update((";" if counts[0] else "").encode() + rows["groups"][k].encode())
            if rows["doc_id"][k] is not None:
                doc_id = rows["doc_id"][k]
            counts = [n + rows[c][k] for n, c in zip(counts, _COUNTS, strict=True)]
    if rid is not None:
        yield done()


def alignment_digests(aligned: Alignment) -> DataFrame:
    """``(doc_id, n_a, ..., count_sum, groups_sha256)``, one row per text of ``align_tokens``.

    The digest of a cut text is sequential, so its runs pass one task, in constant memory.
    """
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    whole = aligned.whole.select("doc_id", *_COUNTS, digest.alias("groups_sha256"))
    runs = aligned.runs.repartition("rid").sortWithinPartitions("rid", "start")
    return whole.unionByName(map_arrow(runs, _put_together, _WHOLE))
