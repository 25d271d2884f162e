"""N-gram Jaccard join with token-combination prefixes.

The tokens of a text are its distinct 5-word shingles, ordered from rare to
frequent. Two sets that are similar enough share a token among the first few of
both, their prefixes. A rare token is indexed by itself. Frequent ones, whose
lists would be long, are indexed in pairs: the prefix is extended, its frequent
tokens are dealt into classes, and by the pigeonhole principle two similar sets
whose prefixes meet in frequent tokens only share two of one class.

Equal sets are one node. Of the nodes under one index key the least altered one is
compared with all others; only nodes that this leaves apart, and that their
tokens do not rule out, are compared with the rest, block by block.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vestibule.llm import packed
from vestibule.llm.components import components
from vestibule.llm.shared import (
    byte_slices,
    ddl,
    map_arrow,
    slices,
    utf8,
    written,
    written_and_counted,
)
from vestibule.llm.words import BLANK, grams, mix, words_of

SHINGLE = 5
# Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80
# Sets that may hold a token for it to be indexed by itself.
RARE = 64
# Nodes that are compared with each other in one task.
BLOCK_NODES = 256
# Bytes of text that are split into words at a time.
CHUNK_BYTES = 2 << 20


def shingle_sets(texts: list[bytes], size: int = SHINGLE):
    """The sorted distinct shingle hashes of each text, in order.

    A text of fewer words than ``size`` is one shingle, one without words has none.
    """
    at = 0
    while at < len(texts):
        held, end = 0, at
        while end < len(texts) and (end == at or held + len(texts[end]) <= CHUNK_BYTES):
            held += len(texts[end])
            end += 1
        words = words_of(texts[at:end], BLANK)
        found = grams(words.hashes, size)
        for i in range(end - at):
            first, last = int(words.first[i]), int(words.first[i + 1])
            if last - first >= size:
                yield np.unique(found[first : last - size + 1])
            elif last > first:
                yield grams(words.hashes[first:last], last - first)
            else:
                yield np.empty(0, np.uint64)
        at = end


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits per set, the same for equal sets."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return tuple(np.frombuffer(digest, np.int64).tolist())


def least_overlap(n: np.ndarray | int, other: np.ndarray | int) -> np.ndarray | int:
    """The smallest intersection with which sets of these sizes link."""
    return -(-PERCENT * (n + other) // (100 + PERCENT))


def prefix_length(n: int) -> int:
    """Tokens of a set of ``n`` of which a linked set holds at least one."""
    return n - (-(-PERCENT * n // 100)) + 1


def level_of(n: int) -> int:
    """Sets that link are of the same level or of neighbouring ones."""
    level, bound = 0, 1
    while True:
        bound = bound * 100 // PERCENT + 1
        if n < bound:
            return level
        level += 1


def level_classes(level: int) -> int:
    """Classes of frequent tokens at a level: about as many as the prefix is long."""
    bound = 1
    for _ in range(level):
        bound = bound * 100 // PERCENT + 1
    return max(1, bound * (100 - PERCENT) // 100)


def signatures(shingles: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Index keys of a set whose tokens occur in ``times`` sets each.

    A token that no other set holds gives none.
    """
    n = len(shingles)
    if (times >= 2).sum() < -(-PERCENT * n // 100):
        return np.empty(0, np.uint64)
    order = np.lexsort((shingles, times))
    tokens, times = shingles[order], times[order]
    p = prefix_length(n)
    keys = [mix(tokens[:p][(times[:p] >= 2) & (times[:p] <= RARE)])]
    if times[p - 1] > RARE:
        level = level_of(n)
        for meet in {level, max(level - 1, 0)}:
            classes = level_classes(meet)
            frequent = tokens[: p + classes][times[: p + classes] > RARE]
            keys.append(_pairs(frequent, classes, meet))
    return np.unique(np.concatenate(keys))


def _pairs(tokens: np.ndarray, classes: int, level: int) -> np.ndarray:
    """A key for every two tokens of the same class."""
    own = mix(tokens + np.uint64(classes)) % np.uint64(classes)
    order = np.lexsort((tokens, own))
    tokens, own = tokens[order], own[order]
    keys, step = [], 1
    while step < len(tokens):
        same = own[step:] == own[:-step]
        if not same.any():
            break
        low, high = tokens[:-step][same], tokens[step:][same]
        keys.append(mix(mix(low + np.uint64(level)) + high * np.uint64(3)))
        step += 1
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


_SETS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("key", pa.int64()),
        ("check", pa.int64()),
        ("place", pa.int64()),
        ("n_bytes", pa.int64()),
    ]
)


def _read_sets(batches):
    for rows in byte_slices(batches, "raw"):
        sets = list(shingle_sets(rows["raw"]))
        keys = list(map(set_key, sets))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": rows["doc_id"],
                "n_shingles": list(map(len, sets)),
                "key": [key for key, _ in keys],
                "check": [check for _, check in keys],
                "place": rows["place"],
                "n_bytes": list(map(len, rows["raw"])),
            },
            schema=_SETS,
        )


_NODES = pa.schema(
    [
        ("node", pa.int64()),
        ("n", pa.int64()),
        ("shared", pa.int64()),
        ("keys", pa.list_(pa.int64())),
        ("tokens", pa.binary()),
    ]
)


def _node_sets(docs: pa.Table, nodes: dict[int, dict]):
    """``(node, shingles)`` of the texts that stand for a node, each node once."""
    done = set()
    for batch in docs.to_batches(max_chunksize=256):
        places = batch.column("place").to_pylist()
        kept = [k for k, place in enumerate(places) if place in nodes]
        raws = batch.column("raw").take(pa.array(kept, pa.int64())).to_pylist()
        for k, shingles in zip(kept, shingle_sets(raws), strict=True):
            node = nodes[places[k]].get(set_key(shingles))
            if node is not None and node not in done:
                done.add(node)
                yield node, shingles


def _by_place(rows: pa.Table) -> dict[int, dict]:
    """The nodes by the place of the text that stands for them, then by their set."""
    found: dict = {}
    for place, node, *key in zip(
        *(rows.column(c).to_pylist() for c in ("place", "node", "key", "check")), strict=True
    ):
        if node is not None:
            found.setdefault(place, {})[tuple(key)] = node
    return found


def _request(buckets: int):
    def ask(key: tuple, docs: pa.Table, nodes: pa.Table) -> pa.Table:
        sets = [shingles for _, shingles in _node_sets(docs, _by_place(nodes))]
        values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
        values, times = np.unique(values, return_counts=True)
        return packed.requests(key[0].as_py(), values, times, buckets)

    return ask


def _answer_shared(values: np.ndarray, total: np.ndarray) -> bytes | None:
    """The values that more than one set holds, and in how many."""
    kept = total >= 2
    if not kept.any():
        return None
    times = np.minimum(total[kept], np.uint64(0xFFFFFFFF)).astype(np.uint32)
    data = packed.pack_sorted(values[kept])
    return len(data).to_bytes(8, "little") + data + packed.pack(times)


def _index(docs: pa.Table, rows: pa.Table) -> pa.Table:
    """The index keys of a batch's nodes, from the answers it got."""
    answers = rows.filter(pc.is_valid(rows.column("answer")))
    values, times = [np.empty(0, np.uint64)], [np.empty(0, np.uint32)]
    for data in packed.in_bucket_order(answers):
        cut = 8 + int.from_bytes(data[:8], "little")
        values.append(packed.unpack_sorted(data[8:cut]))
        times.append(packed.unpack(data[cut:], np.uint32))
    known, known_times = np.concatenate(values), np.concatenate(times)
    out = {name: [] for name in _NODES.names}
    for node, shingles in _node_sets(docs, _by_place(rows)):
        if not len(known):
            break
        at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
        held = np.where(known[at] == shingles, known_times[at], 1)
        keys = signatures(shingles, held)
        if len(keys):
            out["node"].append(node)
            out["n"].append(len(shingles))
            out["shared"].append(int((held >= 2).sum()))
            out["keys"].append(keys.view(np.int64))
            out["tokens"].append(shingles[held >= 2].tobytes())
    return pa.table(out, schema=_NODES)


def _may_link(n: Column, shared: Column, m: Column, other_shared: Column) -> Column:
    """False where the tokens that other sets hold cannot make up a large enough overlap."""
    most = F.least(shared, other_shared)
    return F.lit(100) * most >= F.lit(PERCENT) * (n + m - most)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _verify(batches):
    for rows in slices(batches, 128):
        a, b = [], []
        for x, y, n, m, s, t in zip(
            *(rows[c] for c in ("a", "b", "n_a", "n_b", "tokens_a", "tokens_b")), strict=True
        ):
            both = np.concatenate([np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)])
            both.sort()
            if int((both[1:] == both[:-1]).sum()) >= least_overlap(n, m):
                a.append(x)
                b.append(y)
        yield pa.RecordBatch.from_pydict({"a": a, "b": b}, schema=_LINKS)


def _compare(apart: pa.Table, others: pa.Table) -> pa.Table:
    """Links between the nodes of two blocks that are in different components so far."""
    a, b = [], []
    if apart.num_rows and others.num_rows:
        names = ("node", "n", "shared", "component")
        node, n, shared, comp = (others.column(c).to_numpy() for c in names)
        sets = [np.frombuffer(t, np.uint64) for t in others.column("tokens").to_pylist()]
        tokens = np.concatenate(sets)
        first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        for x, k, own, c, data in zip(
            *(apart.column(name).to_pylist() for name in (*names, "tokens")), strict=True
        ):
            need = least_overlap(n, k)
            near = (comp != c) & (np.minimum(shared, own) >= need)
            if not near.any():
                continue
            mine = np.frombuffer(data, np.uint64)
            at = np.minimum(np.searchsorted(mine, tokens), len(mine) - 1)
            same = np.concatenate([[0], np.cumsum(mine[at] == tokens)])
            linked = near & (same[first[1:]] - same[first[:-1]] >= need)
            a += [x] * int(linked.sum())
            b += node[linked].tolist()
    return pa.table({"a": a, "b": b}, schema=_LINKS)


def _star_links(nodes: DataFrame, places: DataFrame) -> DataFrame:
    """Links between the leader of each key and the other nodes under it."""
    pairs = (
        places.filter(
            (F.col("node") != F.col("leader"))
            & _may_link(F.col("n"), F.col("shared"), F.col("leader_n"), F.col("leader_shared"))
        )
        .select(F.col("leader").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    side = lambda name: nodes.select(
        F.col("node").alias(name),
        F.col("n").alias(f"n_{name}"),
        F.col("tokens").alias(f"tokens_{name}"),
    )
    return map_arrow(pairs.join(side("b"), "b").join(side("a"), "a"), _verify, _LINKS)


def _rest_links(nodes: DataFrame, places: DataFrame, found: DataFrame) -> DataFrame:
    """Links that the leaders left open: under their keys, between different components."""
    named = places.join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    leads = named.filter("node = leader").select("key", F.col("component").alias("led"))
    open_keys = (
        named.filter("node <> leader")
        .groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .join(leads, "key")
        .select("key", "led")
    )
    region = (
        named.filter("node <> leader")
        .join(open_keys, "key")
        .select("leader", "node", "component", (F.col("component") != F.col("led")).alias("apart"))
        .distinct()
    )
    region = written(region, "open-nodes")
    n_blocks = lambda count: F.greatest(F.lit(1), F.ceil(count / F.lit(BLOCK_NODES)))
    sizes = region.groupBy("leader").agg(
        n_blocks(F.count_if("apart")).alias("rows"), n_blocks(F.count("*")).alias("columns")
    )
    whole = region.join(nodes.select("node", "n", "shared", "tokens"), "node").join(sizes, "leader")
    spread = lambda n: F.pmod(F.xxhash64("node", F.lit(3)), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    kept = ("leader", "node", "n", "shared", "component", "tokens")
    by_row = (spread("rows").alias("row"), every("columns").alias("column"))
    rows = whole.filter("apart").select(*kept, *by_row)
    again = [F.col(c).alias(c) for c in kept]  # new columns: both sides come from one table
    columns = whole.select(*again, every("rows").alias("row"), spread("columns").alias("column"))
    by = ("leader", "row", "column")
    return rows.groupBy(*by).cogroup(columns.groupBy(*by)).applyInArrow(_compare, ddl(_LINKS))


def jaccard_components(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs``.

    Null and empty texts have no shingles, link with nothing and are components of
    their own. Equal sets always link, so repeated rows and copies share a
    component. Rows that repeat an id with another text are separate documents. Very
    long texts and words are read whole, some megabytes at a time or a longer text
    alone. Extra columns are not read; an empty table gives no rows. Sets are told
    apart by 128 bits, shingles within a comparison by 64.
    """
    raw = utf8(F.col(text))
    # Texts are dealt by id and text: neither one id nor rows without any make a hot batch.
    rows = docs.select("doc_id", raw.alias("raw"), F.xxhash64("doc_id", raw).alias("place"))
    sets = written(map_arrow(rows, _read_sets, _SETS), "shingle-sets")
    reps = written(
        sets.filter("n_shingles > 0")
        .groupBy("key", "check")
        .agg(
            F.min("doc_id").alias("rep"),
            F.min("place").alias("place"),
            F.min("n_bytes").alias("n_bytes"),
            F.max("n_shingles").alias("n"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "shingle-nodes",
    )
    size = reps.agg(F.sum("n_bytes").alias("bytes"), F.sum("n").alias("tokens")).first()
    n_batches = packed.batch_count(size.bytes or 0)
    buckets = max(packed.LEAST, -(-(size.tokens or 0) // packed.BUCKET_VALUES))

    batch = packed.batch_of(F.col("place"), n_batches).alias("batch")
    dealt = rows.select("raw", "place", batch).groupBy("batch")
    standing = reps.select("node", "key", "check", "place", batch)
    asked = dealt.cogroup(standing.groupBy("batch")).applyInArrow(
        _request(buckets), ddl(packed.REQUEST)
    )
    answers = packed.totals(asked, _answer_shared).filter("answer is not null")
    told = standing.select(
        "batch", "node", "key", "check", "place", F.lit(None).cast("int").alias("bucket"),
        F.lit(None).cast("binary").alias("answer"),
    ).unionByName(answers, allowMissingColumns=True)
    nodes = dealt.cogroup(told.groupBy("batch")).applyInArrow(_index, ddl(_NODES))
    nodes = written(nodes, "indexed-nodes")

    keyed = nodes.select("node", "n", "shared", F.explode("keys").alias("key"))
    altered = (F.col("n") - F.col("shared")) / F.col("n")
    leaders = (
        keyed.groupBy("key")
        .agg(
            F.min(F.struct(altered.alias("altered"), "node", "n", "shared")).alias("lead"),
            F.count("*").alias("size"),
        )
        .filter("size > 1")
        .select(
            "key",
            F.col("lead.node").alias("leader"),
            F.col("lead.n").alias("leader_n"),
            F.col("lead.shared").alias("leader_shared"),
        )
    )
    places = written(keyed.join(leaders, "key"), "keyed-nodes")
    stars = components(_star_links(nodes, places))
    rest, n_rest = written_and_counted(_rest_links(nodes, places, stars), "rest-links")
    in_star = stars.select(F.col("component").alias("a"), F.col("node").alias("b"))
    found = components(in_star.unionByName(rest)) if n_rest else stars

    smallest = found.join(reps, "node").groupBy("component").agg(F.min("rep").alias("component_id"))
    named = found.join(smallest, "component").select("node", "component_id")
    of_node = reps.join(named, "node", "left").select(
        "key", "check", F.coalesce("component_id", "rep").alias("component_id")
    )
    # Written, so that Spark can split the rows of a node with very many copies below.
    of_node = written(of_node, "node-components")
    linked = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return sets.join(of_node, ["key", "check"], "left").select(
        "doc_id", "n_shingles", linked.alias("component_id")
    )
