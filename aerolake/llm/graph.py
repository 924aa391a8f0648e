"""Connected components of edges in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of every node in the edges (a, b).

    Large-star and small-star steps alternate until the edges are stars around the
    least nodes. Each step is one aggregation by node, kept in a written table, and
    neighbours of a node are never gathered in one place.
    """
    now = stored(_directed(edges.select("a", "b")), "stars")
    while True:
        now_large = stored(_star(now, large=True), "stars")
        new = stored(_star(now_large, large=False), "stars")
        if new.exceptAll(now).isEmpty() and now.exceptAll(new).isEmpty():
            break
        now = new
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct edges from the greater to the lesser node."""
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie neighbours to the least one around each node: the greater neighbours
    in a large star, the lesser and the node itself in a small one."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        tied = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("least"))
        own = least.select("a", F.col("least").alias("b"))
        tied = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(own)
    return _directed(tied)
