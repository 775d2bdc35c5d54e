"""Grouped summaries that combine before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window


def total(df: DataFrame, column: str, name: str = "total") -> DataFrame:
    return df.agg(F.sum(column).alias(name))


def grouped_total(df: DataFrame, key: str, column: str, name: str = "total") -> DataFrame:
    """Sum per key, sorted by key; rows without a key are left out."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(column).alias(name)).orderBy(key)


def month_of_year_mean(pairs: DataFrame, series: Sequence[str], yyyymm: str, value: str) -> DataFrame:
    """Mean per series and month of the year; missing values are ignored."""
    month = F.right(F.col(yyyymm), F.lit(2)).cast("int")
    return pairs.groupBy(*series, month.alias("month")).agg(F.avg(value).alias("mean"))


def months_by_series(means: DataFrame, series: str, names: Sequence[str]) -> DataFrame:
    """Twelve month rows with one column per listed series; a missing month is NULL."""
    return means.groupBy("month").pivot(series, list(names)).agg(F.first("mean"))


def series_by_month(means: DataFrame, series: Sequence[str]) -> DataFrame:
    """One row per series with columns m1..m12."""
    wide = means.groupBy(*series).pivot("month", list(range(1, 13))).agg(F.first("mean"))
    return wide.select(*series, *[F.col(str(m)).alias(f"m{m}") for m in range(1, 13)])


def class_share(df: DataFrame, label: str) -> DataFrame:
    """Count and proportion of each class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    everything = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / everything)


def minmax_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns scaled to 0..1 in one extra pass; a constant column gives NULL."""
    bounds = df.agg(
        F.struct(
            *[F.min(c).alias(f"lo_{c}") for c in columns],
            *[F.max(c).alias(f"hi_{c}") for c in columns],
        )
    ).scalar()
    scaled = {
        c: F.try_divide(
            (F.col(c) - bounds[f"lo_{c}"]).cast("double"),
            (bounds[f"hi_{c}"] - bounds[f"lo_{c}"]).cast("double"),
        )
        for c in columns
    }
    return df.withColumns(scaled)


def last_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keyed merge where the row last in `order` wins."""
    packed = F.struct(*[F.col(v) for v in values])
    rank = F.struct(*[F.col(o) for o in order])
    last = df.groupBy(*keys).agg(F.max_by(packed, rank).alias("_last"))
    return last.select(*keys, "_last.*")


def distinct_sorted(df: DataFrame, column: Column, name: str) -> DataFrame:
    return df.select(column.alias(name)).distinct().orderBy(name)


def ancestors(path: Column) -> Column:
    """'/a/b/c' to ['/a', '/a/b', '/a/b/c']."""
    parts = F.split(F.ltrim(path, F.lit("/")), "/")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, n), "/")),
    )


def status_rollup(df: DataFrame, path: str, failed: Column, done: Column) -> DataFrame:
    """Status of every node from its leaves up: one error marks the parent, all done completes it.

    Rows are counted per path first, so only distinct paths are spread over
    their ancestors, and the root never sees more than that.
    """
    per_path = df.groupBy(F.col(path).alias("_path")).agg(
        F.count("*").alias("_n"),
        F.count_if(failed).alias("_errors"),
        F.bool_and(done).alias("_done"),
    )
    nodes = per_path.select(F.explode(ancestors(F.col("_path"))).alias("node"), "_n", "_errors", "_done")
    return nodes.groupBy("node").agg(
        F.sum("_n").alias("leaves"),
        F.sum("_errors").alias("errors"),
        (F.sum("_errors") > 0).alias("failed"),
        F.bool_and("_done").alias("done"),
    )


def feature_moments(df: DataFrame, vector: str) -> DataFrame:
    """Mean and population variance per vector position."""
    entries = df.select(F.posexplode(vector).alias("position", "_value"))
    value = F.col("_value").cast("double")
    return entries.groupBy("position").agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("variance")
    )


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First n rows per group; Spark limits each group before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def head_and_tail(df: DataFrame, order: str, n: int = 3) -> DataFrame:
    """The n smallest and n largest rows by a unique column; an overlap appears once."""
    head = df.orderBy(F.col(order).asc()).limit(n)
    tail = df.orderBy(F.col(order).desc()).limit(n)
    return head.unionByName(tail).dropDuplicates([order])


def rename_by_position(names: Sequence[str], categories: Sequence[str]) -> Mapping[str, str]:
    """Old-to-new map for category renaming by sorted position."""
    if len(names) != len(categories):
        raise ValueError("one new name per category")
    return dict(zip(sorted(categories), names))
