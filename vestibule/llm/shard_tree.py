"""Sharding: a hierarchical weighted hash tree over regions, racks and shards.

A row goes down the tree. At every node each child draws an exponential number, from a
hash of the row's key and the child's name, with the weight below the child as the rate;
the smallest draw wins, so children win in proportion to their weights. Only the
children of the nodes on the way draw: a region, then a rack of it, then a shard of
that. A changed weight changes the draws of the nodes above it alone. Rows move between
regions only into or out of the one whose weight has changed, within it between racks
only into or out of the one that has changed, and so on; what lies elsewhere stays.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vestibule.llm.shared import utf8, written

# Rows that one chunk of a shard holds on average; a window never sees more than a chunk.
CHUNK_ROWS = 4096


@dataclass(frozen=True)
class Shard:
    """A leaf of the tree."""

    region: str
    rack: str
    number: int
    weight: float = 1.0


def topology(shards: int, per_rack: int = 4, racks: int = 3) -> list[Shard]:
    """``shards`` equal leaves: shard ``i`` always has the same place, whatever the count.

    Where all regions are full, one more shard is a region of its own and takes rows only
    into itself; else rows also move within the region that grows.
    """
    return [
        Shard(f"region{i // (per_rack * racks)}", f"rack{i // per_rack % racks}", i)
        for i in range(shards)
    ]


@dataclass(frozen=True)
class _Node:
    """A node by its path, with the weight below it and its children by place in the tree."""

    name: str
    weight: float
    children: tuple[int, ...]
    shard: int | None


def _tree(shards: Sequence[Shard]) -> list[_Node]:
    """All nodes, the root first; what has no weight below it can never win and is left out."""
    weights: dict[tuple, float] = {}
    numbers: dict[tuple, int] = {}
    for s in shards:
        path = (s.region, s.rack, str(s.number))
        if s.weight > 0:
            numbers[path] = s.number
            for depth in range(4):
                weights[path[:depth]] = weights.get(path[:depth], 0.0) + s.weight
    if not weights:
        raise ValueError("no shard has a weight")
    paths = sorted(weights, key=lambda path: (len(path), path))
    place = {path: k for k, path in enumerate(paths)}
    children: dict[tuple, list[int]] = {}
    for path in paths[1:]:
        children.setdefault(path[:-1], []).append(place[path])
    return [
        _Node("/".join(p), weights[p], tuple(children.get(p, ())), numbers.get(p)) for p in paths
    ]


def pick_shard(key: Column, shards: Sequence[Shard]) -> Column:
    """The shard that ``key`` comes to; of equal draws the child with the smaller name wins.

    The tree is one constant of the plan, so its size hardly counts: a row computes a draw
    per child of the three nodes it passes.
    """
    tree = _tree(shards)
    options = F.array(
        *[
            F.array(
                *[
                    F.struct(
                        F.lit(tree[child].name).alias("name"),
                        F.lit(tree[child].weight).alias("weight"),
                        F.lit(child).alias("node"),
                    )
                    for child in node.children
                ]
            )
            for node in tree
            if node.children
        ]
    )

    def drawn(child: Column) -> Column:
        # 53 bits as a number inside (0, 1)
        uniform = F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11) + F.lit(0.5)
        draw = -F.log(uniform / F.lit(2.0**53)) / child["weight"]
        return F.struct(draw.alias("draw"), child["node"].alias("node"))

    # Inner nodes come first, so a node's place among all is its place among those.
    node = F.lit(0)
    for _ in ("region", "rack", "shard"):
        node = F.array_min(F.transform(F.get(options, node), drawn))["node"]
    leaves = F.array(*[F.lit(node.shard if node.shard is not None else -1) for node in tree])
    return F.get(leaves, node)


def assign_shards(
    docs: DataFrame, shards: Sequence[Shard], grown: Sequence[Shard], text: str = "text"
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` per row of ``docs``.

    The law is ``key``: the id and the tree decide, so equal texts need not
    meet and no group of copies makes a hot shard. A null id is a key like any
    other. A null text has size 8 and the checksum of no bytes; very long texts only
    have their bytes counted and summed. Repeated rows go
    to the same shard under slots of their own.

    ``slot`` counts a shard's rows from 0 without gaps. It is counted in chunks of
    some thousand rows, to which the chunks before are added: no task holds a
    whole shard.
    """
    raw = utf8(F.col(text))
    chunks = max(1, docs.count() // (CHUNK_ROWS * len(shards)))
    # Counted rows spread over the chunks even where they repeat; written, so that
    # a retried task finds the same numbers.
    placed = docs.select(
        "doc_id",
        (F.octet_length(raw) + F.lit(8)).cast("bigint").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"),
        pick_shard(F.col("doc_id"), shards).alias("shard"),
        pick_shard(F.col("doc_id"), grown).alias("grown_shard"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks)).alias("chunk"),
    )
    placed = written(placed, "shards")
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = (
        placed.groupBy("shard", "chunk")
        .agg(F.count("*").alias("n"))
        .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .drop("n")
    )
    within = Window.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32")
    numbered = placed.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(bases.hint("merge"), ["shard", "chunk"]).select(
        "doc_id",
        "size",
        "text_crc32",
        "law",
        "shard",
        (F.col("base") + F.col("place")).cast("bigint").alias("slot"),
        "grown_shard",
    )
