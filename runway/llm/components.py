"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stage


def _to_least(near: DataFrame) -> DataFrame:
    """(u, least): the least of each node and its neighbours in the directed pairs (u, v)."""
    return stage(near.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("least")),
                 "star_least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = both.where("v > u").join(_to_least(both), F.col("u") == F.col("node"))
    return linked.select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = _to_least(edges)
    linked = edges.join(least, F.col("u") == F.col("node"))
    moved = linked.select(F.col("v").alias("u"), F.col("least").alias("v")).where("u != v")
    return moved.union(least.select(F.col("node").alias("u"), F.col("least").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the long pairs (u, v); root is the least node that it reaches.

    Self pairs and repeated pairs are ignored.  Each round is written to the shared folder.  Rounds end when the
    edges are stars that no longer change; their number grows with the logarithm of the longest path.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()
    edges, seen = stage(edges, "star_edges"), None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen or not now[0]:
            break
        seen = now
        edges = stage(_small_star(stage(_large_star(edges), "star_large")), "star_edges")
    pairs = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
