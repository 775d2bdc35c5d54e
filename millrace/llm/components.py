"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.sources.storage import materialize


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Point the neighbours of each node at the smallest of them, the node included."""
    mirrored = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = edges.union(mirrored) if larger else mirrored
    least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
    moved = around.join(least, "a")
    if larger:
        moved = moved.where(F.col("b") > F.col("a")).select(F.col("low").alias("a"), "b")
    else:
        own = least.select(F.col("low").alias("a"), F.col("a").alias("b"))
        moved = moved.select(F.col("low").alias("a"), "b").union(own)
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """`node`, `root` (smallest node reachable) for every node of the `pairs` (a, b).

    Large-star and small-star rounds alternate until the pairs stop changing; a
    round is an aggregate and a join, so a hub is split by adaptive execution
    and no list of links is ever built.  Every round is written to the shared
    folder.  Pairs of a node with itself give that node alone; no pairs, no rows.
    """
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    edges = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = materialize(edges.where(F.col("a") != F.col("b")).distinct(), "edges")
    mark = None
    while True:
        count, trace = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == (count, trace) or not count:
            break
        mark = (count, trace)
        edges = materialize(_stars(_stars(edges, True), False), "edges")
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
