"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylane.session import staged


def are_stars(edges: DataFrame) -> bool:
    """Whether every node has one lower neighbour and no higher one, or the other way round."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("low")).unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("low")))
    nodes = ends.groupBy("node").agg(F.sum("low").alias("low"), F.count("*").alias("all"))
    return nodes.where("low > 1 or low = 1 and all > 1").limit(1).count() == 0


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, label) for every node in a link; label is the least node of the component.

    Alternating large-star and small-star steps: each links neighbours to the least one around, until only stars are left. Each
    round is written to the shared folder, so a lost executor repeats one round at most. ``links``: (a, b), any order.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        if are_stars(edges):
            break
        # Large star: neighbours above a node are linked to the least node around it.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: a node and its lower neighbours are linked to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
