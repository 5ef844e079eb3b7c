"""Connected components of a graph given as edges, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.session import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Connects every larger neighbour of a node to the least node among the node and its neighbours."""
    every = _both_ways(edges)
    least = every.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return every.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Connects a node and its smaller neighbours to the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; the component is its least node.

    `edges` has long columns a and b. Each round is written to the shared folder, which cuts the
    lineage; the number of rounds grows with the logarithm of the longest path. A node with very
    many neighbours is a skewed join key of narrow rows, which adaptive execution splits.
    """
    now = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(now)
    while True:
        now = stored(_small_star(_large_star(now)))
        after = _state(now)
        if after == before:
            break
        before = after
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(now.select(F.col("b"), F.col("b")).distinct())


def _state(edges: DataFrame) -> tuple:
    # Wide enough for the sum of any number of hashes.
    total = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
    return tuple(edges.agg(F.count("*"), total).first())
