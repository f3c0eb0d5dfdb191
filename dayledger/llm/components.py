"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.shared import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    around = _both_ways(edges)
    least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (
        around.where("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are all tied to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return tied.where("a <> b").unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node that is reachable.

    edges: columns a and b, long and not null, in any order, repeated or not; loops are
    ignored. Each round is written to the shared folder, as are the stars at the end. Hot
    nodes are reduced by partial aggregation, and joins on them can be split at runtime.
    Without edges the result is empty.
    """
    current = stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        purpose,
    )
    while True:
        # A forest of stars: each node has one edge, and no edge ends in a node that has one.
        heads = current.agg(F.count("*"), F.count_distinct("a")).first()
        tails = current.select(F.col("b").alias("a")).join(current, "a", "left_semi")
        if heads[0] == heads[1] and tails.isEmpty():
            break
        current = stored(_small_star(_large_star(current)), purpose)
    roots = current.select(F.col("b").alias("node")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
