"""Connected components of a distributed list of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellops.llm.common import discard, stored


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the neighbourhood."""
    both = edges.union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    tied = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return tied.union(least.select("u", F.col("m").alias("v")))


def joined(links: DataFrame) -> DataFrame:
    """One round: links (u, v) of the same connectivity, each from a node to a smaller one of its component.

    Each half is a minimum per node and a join, both of which split a node with many links over tasks.
    """
    return _small_star(_large_star(links)).distinct()


def components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v); the component is its smallest node.

    Each round is written to ``folder``, and the one before it removed. Their number grows with the logarithm of the longest chain.
    """
    edges, seen, step = links.filter("u <> v"), None, 0
    while True:
        step += 1
        edges = stored(joined(edges), folder, f"{name}-{step}")
        discard(links.sparkSession, folder, f"{name}-{step - 1}")
        if (now := _signature(edges)) == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select("v", "v").distinct())
