"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vestibule.llm.shared import written


def _with_smallest(edges: DataFrame) -> DataFrame:
    """Each directed edge with the smallest of its source and that one's neighbours.

    The smallest are written first: Spark can split the edges of a node with very many
    neighbours only in a join of two plain tables.
    """
    smallest = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return edges.join(written(smallest, "smallest"), "u")


def _observed(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, written, with their number and a checksum."""
    state = Observation()
    checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    out = written(edges.observe(state, F.count("*").alias("n"), checksum.alias("sum")), "links")
    return out, (state.get["n"], state.get["sum"])


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)``; the smallest node names it.

    Large-star and small-star in turn: the first links all larger neighbours of a
    node to the smallest one, the second all smaller ones. The number of links never
    grows, and rounds grow with the logarithm of the longest path. Every round is
    written, and only its number of links and a checksum reach the driver.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges, state = _observed(edges.filter("u <> v").distinct())
    before = None
    while state[0] and state != before:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_smallest(both).filter("v > u")
        small = _with_smallest(large.select(F.col("v").alias("u"), F.col("m").alias("v")))
        moved = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        before = state
        edges, state = _observed(moved.filter("u > v").distinct())
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
