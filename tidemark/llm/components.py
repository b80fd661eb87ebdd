"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import kept


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
    return both.join(least, "a").where("b > a").select("b", "root").select(F.col("root").alias("a"), "b").where("a < b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to the least of them."""
    least = links.groupBy("b").agg(F.min("a").alias("root"))
    moved = links.join(least, "b").where("a > root").select(F.col("root").alias("a"), F.col("a").alias("b"))
    own = least.select(F.col("root").alias("a"), "b")
    return moved.unionByName(own).distinct()


def _settled(stars: DataFrame) -> bool:
    """Every node is a root or has one root, which is no one's child."""
    ends = stars.select(F.col("a").alias("node"), F.lit(0).alias("child")).unionByName(
        stars.select(F.col("b").alias("node"), F.lit(1).alias("child"))
    )
    nodes = ends.groupBy("node").agg(F.sum("child").alias("roots"), F.min("child").alias("only"))
    return nodes.where("roots > 1 OR (roots = 1 AND only = 0)").isEmpty()


def components(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, component) for all nodes of ``links`` (a, b) that are not the least of their component.

    A round halves long chains at least.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    stars = kept(ordered, "links")
    for _ in range(most_rounds):
        if _settled(stars):
            return stars.select(F.col("b").alias("node"), F.col("a").alias("component"))
        # Kept between the two, as the small star needs its links three times.
        stars = kept(_small_star(kept(_large_star(stars), "large-star")), "links")
    raise RuntimeError("components did not settle")

