"""Equality joins, anti joins and bounded products."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F


def _suffixed(left: DataFrame, right: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    shared = (set(left.columns) & set(right.columns)) - {on}
    l = left.select(on, *[F.col(c).alias(f"{c}_x" if c in shared else c) for c in left.columns if c != on])
    r = right.select(
        F.col(on).alias("_on"),
        *[F.col(c).alias(f"{c}_y" if c in shared else c) for c in right.columns if c != on],
    )
    return l, r


def hot_keys(df: DataFrame, key: str, share: float) -> list[tuple[object, float]]:
    """Keys holding more than `share` of all rows: at most 1/share of them."""
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    rows = counts.where(F.col("_n") > share * total).withColumn("_total", total).collect()
    return [(r[key], r["_n"] / r["_total"]) for r in rows]


def inner_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    hot_share: float | None = 0.05,
    hot: list[tuple[object, float]] | None = None,
) -> DataFrame:
    """Inner join on one column; missing keys match each other, shared columns get _x and _y.

    Keys holding more than `hot_share` of the right side are salted: their right
    rows spread over as many pieces as their share of the shuffle deserves, and
    their left rows are repeated once per piece.  The hot list has at most
    1/hot_share rows, so it is broadcast; `hot` passes one that is known already.
    `hot_share=None` leaves skew to AQE.
    """
    l, r = _suffixed(left, right, on)
    if hot is None:
        hot = hot_keys(right, on, hot_share) if hot_share else []
    if not hot:
        return l.join(r, l[on].eqNullSafe(r["_on"])).drop("_on")
    spark = left.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = [(key, max(2, math.ceil(2 * share * partitions))) for key, share in hot]
    table = spark.createDataFrame(pieces, f"_hot {left.schema[on].dataType.simpleString()}, _pieces int")
    l = (
        l.join(F.broadcast(table), l[on].eqNullSafe(F.col("_hot")), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)))
        .drop("_hot", "_pieces")
    )
    spread = F.xxhash64(*[c for c in r.columns])
    r = (
        r.join(F.broadcast(table), r["_on"].eqNullSafe(F.col("_hot")), "left")
        .withColumn("_salt_r", F.coalesce(F.pmod(spread, F.col("_pieces")), F.lit(0)).cast("int"))
        .drop("_hot", "_pieces")
    )
    return l.join(r, l[on].eqNullSafe(r["_on"]) & (F.col("_salt") == F.col("_salt_r"))).drop(
        "_on", "_salt", "_salt_r"
    )


def batch_ranges(rows: DataFrame, chunk: int) -> DataFrame:
    """Even [start, end) ranges that cut the row count of `rows` into chunks of at most `chunk`.

    The range table stands in for a blocked join's work list; the join itself
    is `inner_join`, whose blocks are shuffle partitions.
    """
    counted = rows.agg(F.count("*").alias("n")).where(F.col("n") > 0)
    size = F.ceil(F.col("n") / F.ceil(F.col("n") / F.lit(float(chunk)))).cast("bigint")
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.col("size"))
    return (
        counted.withColumn("size", size)
        .select("n", "size", F.explode(starts).alias("start"))
        .select("start", F.least(F.col("start") + F.col("size"), F.col("n")).alias("end"))
    )


def pending(plan: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Plan rows without an equal done row."""
    return plan.join(done.select(*keys), keys, "left_anti")


# The letters of two-letter file ids, in index order.
ID_LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def id_index(text: Column) -> Column:
    """Index of a two-letter id: 62 * first + second, both zero-based."""
    letters = F.lit(ID_LETTERS)
    first = F.position(F.substring(text, 1, 1), letters) - 1
    second = F.position(F.substring(text, 2, 1), letters) - 1
    return first * len(ID_LETTERS) + second


def id_text(index: Column) -> Column:
    """Two-letter id of an index below 62 * 62."""
    letters = F.lit(ID_LETTERS)
    first = F.floor(index / len(ID_LETTERS)).cast("int")
    second = (index % len(ID_LETTERS)).cast("int")
    return F.concat(
        F.substring(letters, first + 1, F.lit(1)), F.substring(letters, second + 1, F.lit(1))
    )
