"""Nearest neighbours, their graph and its modularity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators import metric_tree
from millrace.operators.aggregates import top_per_group
from millrace.operators.joins import hot_keys, inner_join
from millrace.sources.storage import materialize

HUB_SHARE = 0.05  # share of the edges from which a node's edges are spread over tasks


def nearest_neighbours(
    df: DataFrame,
    key: str,
    vector: str,
    k: int = 10,
    block_rows: int = 4096,
    fanout: int = metric_tree.FANOUT,
    share: float = 1.0,
) -> DataFrame:
    """Exact k nearest rows of every row, itself included, by Euclidean distance.

    Equal vectors are one point of a metric tree (`metric_tree`) and stand for up to
    k rows, those with the smallest keys, which come first among rows at equal
    distance; the answers of a point are those of all its rows.  A `share` below 1 of
    the leaves gives approximate answers.  Result: key, neighbour, distance, rank; rows
    without a vector take no part.
    """
    # single precision is half as much to shuffle
    kind = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).cast(kind).alias("v"))
    points = materialize(rows.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "points")
    best = metric_tree.neighbours(points.select("id", "v"), k, block_rows, fanout, share)
    copied = points.where("copies > 1").select("v", F.col("id").alias("point"))
    if not copied.isEmpty():
        best = materialize(best, "best")
        members = materialize(rows.join(copied, "v").select("point", "id"), "members")
        first = top_per_group(members, ["point"], [F.col("id").asc()], k).groupBy("point").agg(F.collect_list("id").alias("ids"))
        rows_of = best.join(first, best["neighbour"] == first["point"], "left").select(
            best["id"].alias("point"), F.explode(F.coalesce("ids", F.array("neighbour"))).alias("neighbour"), "distance"
        )
        of_points = top_per_group(rows_of, ["point"], [F.col("distance").asc(), F.col("neighbour").asc()], k).drop("rank")
        answers = of_points.groupBy("point").agg(F.collect_list(F.struct("neighbour", "distance")).alias("found"))
        # a point with very many rows: adaptive execution splits the side of the rows
        named = members.join(points.select(F.col("id").alias("point")), "point", "right").select("point", F.coalesce("id", "point").alias("id"))
        best = named.join(answers, "point").select("id", F.inline("found"))
    return top_per_group(best, ["id"], [F.col("distance").asc(), F.col("neighbour").asc()], k).withColumnRenamed("id", key)


def undirected(edges: DataFrame, source: str, target: str, weight: Column | None = None) -> DataFrame:
    """Both directions of every edge once, self-loops dropped: (src, dst, weight)."""
    w = F.lit(1.0) if weight is None else weight
    ends = F.array(
        F.struct(F.col(source).alias("src"), F.col(target).alias("dst")),
        F.struct(F.col(target).alias("src"), F.col(source).alias("dst")),
    )
    both = edges.where(F.col(source) != F.col(target)).select(w.alias("weight"), F.inline(ends))
    return both.groupBy("src", "dst").agg(F.max("weight").alias("weight"))


def modularity(edges: DataFrame, labels: DataFrame, hubs=None) -> DataFrame:
    """Modularity of a clustering (id, cluster) of a symmetric edge table, with its terms summed per cluster."""
    start = labels.select(F.col("id").alias("src"), F.col("cluster").alias("a"))
    end = labels.select(F.col("id").alias("dst"), F.col("cluster").alias("b"))
    # Edges are symmetric, so a node that many edges leave is one that many reach.
    hubs = hot_keys(edges, "src", HUB_SHARE) if hubs is None else hubs
    ends = inner_join(end, inner_join(start, edges, "src", hot=hubs), "dst", hot=hubs)
    per_cluster = (
        ends.groupBy("a")
        .agg(F.sum("weight").alias("degree"), F.sum(F.when(F.col("a") == F.col("b"), F.col("weight")).otherwise(0.0)).alias("inside"))
    )
    everything = per_cluster.agg(F.sum("degree")).scalar()
    share = F.col("degree") / F.col("_all")
    return (
        per_cluster.withColumn("_all", everything)
        .agg(
            F.count("*").alias("clusters"),
            F.sum(F.col("inside") / F.col("_all") - share * share).alias("modularity"),
        )
    )
