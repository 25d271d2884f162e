"""Repairing the order of roles in conversations by the cheapest edits.

A conversation's rows and the four states of a well-formed one (nothing yet, after the
system's, the user's, the assistant's turn) span a lattice: a column per row, an arc per
edit with an integer cost. The auction algorithm finds the shortest path from its start:
every node has a price, never more than an arc's cost plus the price at its far end; the
path grows along the arc that attains this bound, or, if the price at its end is too low,
raises it and gives the node up. Once the path arrives, the arcs on which prices and
costs agree (tight arcs) carry all cheapest paths, and following the least letter among
them gives the first one in the alphabet.

Conversations of any length are cut into segments of bounded size. The costs from every
state at a segment's start to every state at its end, by the same algorithm, compose to
the price of each state where the next segment begins; with these, each segment is traced
by itself for every state it may start in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import inf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vestibule.llm.shared import map_arrow, slices, written

# What edits cost, the signs that end a turn, and white space.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
ENDS = (".", "!", "?")
BLANKS = " \t\n\x0b\x0c\r"
# Rows of a segment, as a power of two.
SEGMENT_BITS = 6
# The states, those in which a conversation may end, and the turns that may follow each.
STATES = range(4)
START, SYSTEM, USER, ASSISTANT = STATES
ENDING = (START, ASSISTANT)
FOLLOWS = {"s": {START: SYSTEM}, "u": dict.fromkeys((START, SYSTEM, ASSISTANT), USER)}
FOLLOWS["a"] = {USER: ASSISTANT}
ADDED = FOLLOWS["u"] | FOLLOWS["a"]  # where an inserted or changed turn leads
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
# Rows as letters: b blank, d duplicate, else the role's initial (o for any other),
# upper case where the text is cut short.
GONE = "bd"


def edit_cost(edit: str, code: str) -> int:
    """What ``edit`` of a row costs; an insertion has no row."""
    cost = {"D": DELETE, "I": INSERT, "K": 0, "R": REROLE}[edit]
    return cost + (TRUNCATED if edit in "KR" and code.isupper() else 0)


def least_cost(code: str) -> int:
    """What a row costs at least, whatever comes before and behind."""
    if code in GONE:
        return DELETE
    return min(DELETE, edit_cost("R" if code in "oO" else "K", code))


class Lattice:
    """A segment of rows; node ``4 * row + state``, the goal is the last number.

    ``leave`` has the cost of going on from each state behind the last row. Turns may be
    inserted there only at the very end, or two segments would both offer it. Prices start
    as what the rows ahead cost at least, which no arc undercuts.
    """

    def __init__(self, codes: str, leave: list[float], last: bool):
        n, self.goal = len(codes), 4 * len(codes) + 4
        self.arcs = [[] for _ in range(self.goal)]
        self.price = [0.0] * (self.goal + 1)
        ahead = min(leave)
        for row in range(n, -1, -1):
            code = codes[row] if row < n else None
            ahead += least_cost(code) if code else 0
            for state in STATES:
                self.price[4 * row + state] = ahead
                self.arcs[4 * row + state] = list(self._arcs(row, state, code, last, leave))
        self.price[self.goal] = 0.0

    def _arcs(self, row: int, state: int, code: str | None, last: bool, leave: list[float]):
        """``(letter, node, cost)`` in the order of the letters."""
        if code:
            yield "D", 4 * (row + 1) + state, DELETE
        if code or last:
            yield "I", 4 * row + ADDED[state], INSERT
        if code and code not in GONE:
            kept = FOLLOWS.get(code.lower(), {}).get(state)
            if kept is not None:
                yield "K", 4 * (row + 1) + kept, edit_cost("K", code)
            yield "R", 4 * (row + 1) + ADDED[state], edit_cost("R", code)
        if not code and leave[state] < inf:
            yield "", self.goal, leave[state]

    def cost_from(self, start: int) -> float:
        """The shortest way from a state before the first row to the goal."""
        price, arcs, goal, path = self.price, self.arcs, self.goal, [start]
        while path[-1] != goal:
            node, best, ahead = path[-1], inf, goal
            for _, end, cost in arcs[node]:
                if cost + price[end] < best:
                    best, ahead = cost + price[end], end
            if best <= price[node]:
                path.append(ahead)
                continue
            price[node] = best
            if len(path) > 1:
                path.pop()
            elif best == inf:
                break
        return price[start]

    def trace(self, start: int) -> str | None:
        """The first of the cheapest edit sequences from a state, once its cost is known."""
        if self.price[start] == inf:
            return None
        letters, path, dead = [], [start], set()
        while path[-1] != self.goal:
            node = path[-1]
            for letter, end, cost in self.arcs[node]:
                if end not in dead and self.price[node] == cost + self.price[end]:
                    path.append(end)
                    letters.append(letter)
                    break
            else:
                dead.add(path.pop())
                letters.pop()
        return "".join(letters)


def reachable(codes: str, state: int, end: int) -> bool:
    """Whether some edits lead from ``state`` before some rows to ``end`` behind them."""
    if end == SYSTEM:
        return state == SYSTEM or state == START and any(c in "sS" for c in codes)
    return end != START or state == START


def segment_costs(codes: str, last: bool) -> list[float]:
    """The least cost from every state to every state, row by row."""
    costs = [[inf] * 4 for _ in STATES]
    for end in STATES:
        lattice = Lattice(codes, [0.0 if q == end else inf for q in STATES], last)
        for state in STATES:
            if reachable(codes, state, end):
                costs[state][end] = lattice.cost_from(state)
    return [cost for row in costs for cost in row]


def segment_edits(codes: str, leave: list[float], last: bool, first: bool) -> list[str | None]:
    """The edits of a segment for each state it may begin in; a first one begins at the start."""
    lattice = Lattice(codes, leave, last)
    states = [START] if first else STATES
    for state in states:
        if any(leave[end] < inf and (last or reachable(codes, state, end)) for end in STATES):
            lattice.cost_from(state)
        else:
            lattice.price[state] = inf
    return [lattice.trace(state) if state in states else None for state in STATES]


AT_END = [0.0 if state in ENDING else inf for state in STATES]


def damaged_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)``: rows broken in five ways by a checksum of their place.

    Of twenty remainders of the CRC-32 of ``conv_id:turn``, 0 drops the row, 1 empties its
    text, 2 removes the signs that end sentences, 3 repeats it, 4 makes it the user's. A
    null is read as one space, but ids and turns stay null.
    """
    space = F.lit(" ")
    parts = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    place = F.concat(parts[0], F.lit(":"), parts[1])
    way = F.pmod(F.crc32(place.cast("binary")), F.lit(20))
    role, text = (F.coalesce(F.col(c).cast("string"), space) for c in ("role", "text"))
    several = F.when(way == 0, 0).when(way == 3, 2).otherwise(1)
    return turns.select(
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
        F.when(way == 4, "user").otherwise(role).alias("role"),
        F.when(way == 1, "")
        .when(way == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text)
        .alias("text"),
        F.explode(F.array_repeat(F.lit(0), several)).alias("copy"),
    ).drop("copy")


def in_order(turns: DataFrame) -> DataFrame:
    """``(at, conv_id, turn, role, text)``, written: ``at`` ascends by conversation and turn.

    Rows of one turn go by role, then by the MD5 of their text: the ranges are made from
    a sample, which texts themselves would make large. A conversation that holds most
    rows is many tasks' work, and ``at`` numbers rows next to each other in one task one
    by one.
    """
    by = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest", "rid")]
    rows = turns.select(
        *[F.col(c) for c in ("conv_id", "turn", "role", "text")],
        F.md5("text").alias("digest"),
        F.monotonically_increasing_id().alias("rid"),
    )
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    at = F.monotonically_increasing_id().alias("at")
    return written(rows.select(at, "conv_id", "turn", "role", "text"), "turns-in-order")


def row_codes(ordered: DataFrame) -> DataFrame:
    """``(conv_id, at, code)``: every row as a letter. Only the first fault of a row counts."""
    ends = F.rtrim("text", F.lit(BLANKS))
    blank = ends == ""
    initial = F.left("role", F.lit(1))
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    cut_short = ~F.right(ends, F.lit(1)).isin(*ENDS)
    # A text seen before is known by its digest: texts themselves need not travel.
    seen = ordered.groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("at").alias("at"))
    seen = seen.select("at", F.lit(True).alias("new"))
    rows = ordered.select(
        "conv_id", "at", blank.alias("blank"),
        F.when(cut_short, F.upper(initial)).otherwise(initial).alias("letter"),
    )
    code = F.when(F.col("blank"), "b").when(F.col("new").isNull(), "d").otherwise(F.col("letter"))
    return rows.join(seen, "at", "left").select("conv_id", "at", code.alias("code"))


_SEGMENT = [("conv_id", pa.int64()), ("block", pa.int64())]
_COSTS = pa.schema([*_SEGMENT, ("costs", pa.list_(pa.float64()))])
_LEAVE = pa.schema([*_SEGMENT, ("leave", pa.list_(pa.float64()))])
_PLAN = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("at", pa.int64()),
        ("codes", pa.string()),
        ("edits", pa.list_(pa.string())),
    ]
)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches):
        costs = [segment_costs(*each) for each in zip(rows["codes"], rows["last"], strict=True)]
        columns = {"conv_id": rows["conv_id"], "block": rows["block"], "costs": costs}
        yield pa.RecordBatch.from_pydict(columns, schema=_COSTS)


def _price_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each state costs behind every segment; segments come last one first."""
    known, conv, ahead = False, None, AT_END
    for rows in slices(batches):
        leave = []
        for conv_id, costs in zip(rows["conv_id"], rows["costs"], strict=True):
            if not known or conv_id != conv:
                known, conv, ahead = True, conv_id, AT_END
            leave.append(ahead)
            ahead = (np.array(costs).reshape(4, 4) + np.array(ahead)).min(1).tolist()
        columns = {"conv_id": rows["conv_id"], "block": rows["block"], "leave": leave}
        yield pa.RecordBatch.from_pydict(columns, schema=_LEAVE)


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in slices(batches):
        edits = [
            segment_edits(codes, leave or AT_END, last, first)
            for codes, leave, last, first in zip(
                *(rows[c] for c in ("codes", "leave", "last", "first")), strict=True
            )
        ]
        columns = {name: rows[name] for name in ("conv_id", "at", "codes")} | {"edits": edits}
        yield pa.RecordBatch.from_pydict(columns, schema=_PLAN)


def plan_repairs(codes: DataFrame) -> DataFrame:
    """``(conv_id, at, codes, edits)`` per segment: its edits for each state it may begin in.

    ``codes`` as from ``row_codes``. Numbers ``at`` that agree but for the last bits lie
    next to each other, so a conversation's rows among them are a segment.
    """
    block = F.shiftright("at", SEGMENT_BITS).alias("block")
    letters = F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda row: row.code)
    segments = codes.groupBy("conv_id", block).agg(
        F.min("at").alias("at"), F.array_join(letters, "").alias("codes")
    )
    segments = written(segments, "segments")
    ends = segments.groupBy("conv_id").agg(
        F.min("block").alias("first_block"), F.max("block").alias("last_block")
    )
    ends = ends.withColumnRenamed("conv_id", "whose")
    segments = segments.join(ends, F.col("conv_id").eqNullSafe(F.col("whose"))).select(
        "conv_id", "block", "at", "codes",
        (F.col("block") == F.col("first_block")).alias("first"),
        (F.col("block") == F.col("last_block")).alias("last"),
    )
    segments = written(segments, "segments")
    alone = F.col("first") & F.col("last")
    several = segments.filter(~alone)
    costs = map_arrow(several.select("conv_id", "block", "codes", "last"), _measure, _COSTS)
    # One small row per segment: a conversation's pass one task, held one at a time.
    backwards = costs.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))
    leave = map_arrow(backwards, _price_back, _LEAVE).withColumnRenamed("conv_id", "whose")
    # A block may hold the ends of two conversations, never two segments of one.
    same = F.col("conv_id").eqNullSafe(F.col("whose")) & (F.col("block") == F.col("of_block"))
    leave = leave.withColumnRenamed("block", "of_block")
    none = F.lit(None).cast("array<double>").alias("leave")
    priced = several.join(leave, same).select(*segments.columns, "leave")
    segments = segments.filter(alone).select("*", none).unionByName(priced)
    return map_arrow(segments.drop("block"), _plan, _PLAN)


_EDITS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("number", pa.int64()),
        ("edit", pa.string()),
        ("code", pa.string()),
        ("turn", pa.int64()),
        ("was", pa.string()),
        ("role", pa.string()),
        ("text", pa.string()),
        ("cost", pa.int64()),
    ]
)


class _Editor:
    """Applies the planned edits to rows as they come by."""

    def __init__(self, conv_id):
        self.conv_id, self.state, self.number, self.edits, self.codes = conv_id, START, 0, "", ""
        self.done, self.row = 0, 0

    def row_of(self, edit: str, code=None, turn=None, was=None, role=None, text=None) -> dict:
        self.number += 1
        cost = edit_cost(edit, code or "") if edit else 0
        values = (self.conv_id, self.number - 1, edit, code, turn, was, role, text, cost)
        return dict(zip(_EDITS.names, values, strict=True))

    def plan(self, codes: str, edits: list[str | None]) -> Iterator[dict]:
        """Begin a segment; insertions behind the last row of the one before come first."""
        yield from self.insert()
        self.codes, self.edits, self.done, self.row = codes, edits[self.state], 0, 0

    def insert(self) -> Iterator[dict]:
        while self.edits[self.done : self.done + 1] == "I":
            self.done += 1
            self.state = ADDED[self.state]
            yield self.row_of("I", role=ROLES[self.state], text="")

    def take(self, turn, role: str, text: str) -> Iterator[dict]:
        yield from self.insert()
        edit, code, new = self.edits[self.done], self.codes[self.row], None
        if edit == "K":
            self.state, new = FOLLOWS[code.lower()][self.state], role
        elif edit == "R":
            self.state = ADDED[self.state]
            new = ROLES[self.state]
        self.done += 1
        self.row += 1
        yield self.row_of(edit, code, turn, role, new, text)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    editor = None
    for rows in slices(batches):
        out = []
        for conv, kind, turn, role, text, codes, edits in zip(
            *(rows[c] for c in ("conv_id", "kind", "turn", "role", "text", "codes", "edits")),
            strict=True,
        ):
            if kind == 0:
                out += editor.insert() if editor else []
                editor = _Editor(conv)
                out.append(editor.row_of(""))
            elif kind == 1:
                out += editor.plan(codes, edits)
            else:
                out += editor.take(turn, role, text)
        yield pa.RecordBatch.from_pylist(out, schema=_EDITS)
    yield pa.RecordBatch.from_pylist(list(editor.insert()) if editor else [], schema=_EDITS)


def repaired_turns(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """``(conv_id, number, edit, code, turn, was, role, text, cost)``: every edit in order.

    A row without ``edit`` opens each conversation, those of ``conversations`` that have
    no rows included. Then come, per row of ``turns`` by turn, nulls first: K keeps it, R
    gives it another role, D deletes it (``role`` null), I inserts an empty turn. ``was``
    is the role before, ``code`` the row as a letter. Kept, changed and inserted turns
    have role initials ``(s?(ua)+)?`` at the least total cost, and of all such edits
    these come first in the alphabet. Blank rows and copies of earlier ones (role and
    text) are deleted. Null roles and texts count as one space; rows without an id are
    one conversation; rows of one turn go by role and the MD5 of the text; repeated rows
    are copies; very long texts are read whole; an empty table gives no rows; other
    columns are not read. Rows of a conversation lie in one partition in order: they
    stream through it, one at a time.
    """
    role, text = (F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text"))
    ordered = in_order(turns.select("conv_id", "turn", role, text))
    every = (turns if conversations is None else conversations).select("conv_id").distinct()
    begins = every.select(
        F.col("conv_id").cast("bigint"),
        F.lit(-1).cast("bigint").alias("at"),
        F.lit(0).alias("kind"),
    )
    plans = plan_repairs(row_codes(ordered)).withColumn("kind", F.lit(1))
    stream = begins.unionByName(plans, allowMissingColumns=True)
    stream = stream.unionByName(ordered.withColumn("kind", F.lit(2)), allowMissingColumns=True)
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "at", "kind")
    return map_arrow(stream, _apply, _EDITS)


_REPORT = pa.schema(
    [
        ("conv_id", pa.int64()),
        *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
    ]
)


class _Reporter:
    """Sums the edits of a conversation up as they come by."""

    def __init__(self, conv_id):
        self.conv_id, self.audit, self.digest, self.kept = conv_id, [], hashlib.sha256(), 0
        self.faults = {"b": 0, "d": 0, "cut": 0}
        self.illegal = self.cost = self.distinct = 0
        self.last = self.first_turn = self.turn = None

    def read(self, edit: str, code, turn, was, role, text: str, cost: int) -> None:
        self.audit.append(edit)
        self.cost += cost
        if was is not None:
            fault = "cut" if code.isupper() else code
            if fault in self.faults:
                self.faults[fault] += 1
            self.illegal += self.last is not None and self.last + was[:1] not in LEGAL
            self.last = was[:1]
        if turn is not None and turn != self.turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turn, self.distinct = turn, self.distinct + 1
        if role is not None:
            self.digest.update(f"{'\n' if self.kept else ''}{role}:{text}".encode())
            self.kept += 1

    def row(self) -> dict:
        gaps = 0 if self.turn is None else self.turn - self.first_turn + 1 - self.distinct
        values = (self.conv_id, gaps, *self.faults.values(), self.illegal, self.cost)
        return dict(
            zip(_REPORT.names, (*values, "".join(self.audit), self.digest.hexdigest()), strict=True)
        )


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    reporter = None
    for rows in slices(batches):
        done = []
        for conv, edit, *values in zip(
            *(rows[c] for c in _EDITS.names if c != "number"), strict=True
        ):
            if not edit:
                done += [reporter.row()] if reporter else []
                reporter = _Reporter(conv)
            else:
                reporter.read(edit, *values)
        yield pa.RecordBatch.from_pylist(done, schema=_REPORT)
    yield pa.RecordBatch.from_pylist([reporter.row()] if reporter else [], schema=_REPORT)


def repair_report(repaired: DataFrame) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``.

    One row per conversation of ``repaired_turns``, read in the order and the partitions
    that it gives. ``audit`` has a letter per edit; the digest is that of the repaired
    turns as lines ``role:text``.
    """
    return map_arrow(repaired, _report, _REPORT)
