"""User-defined aggregates whose partial states merge, combined in two levels."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


def merge_states(
    df: DataFrame,
    by: Sequence[str],
    fold: Callable[[Iterator[pd.DataFrame]], pd.DataFrame],
    merge: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """One state per key from any associative aggregate written in pandas.

    `fold` turns the batches of a task into one state row per key; `merge` turns
    several state rows of one key into one.  States, not rows, are shuffled, so
    a key with most of the rows costs one state per task; each of the two levels
    merges at most about twice the square root of the number of tasks.
    """

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        states = fold(batches)
        if len(states):
            yield states

    states = df.mapInPandas(task, schema)
    level = states.withColumn("__part", F.floor(F.sqrt(F.spark_partition_id())))
    first = level.groupBy(*by, "__part").applyInPandas(lambda part: merge(part.drop(columns="__part")), schema)
    return first.groupBy(*by).applyInPandas(merge, schema)


def spread_states(df: DataFrame, key: str, value: str, key_type: str = "string") -> DataFrame:
    """Count, mean and sum of squared deviations per key by pairwise merging, stable for any offset."""

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        n = part["n"].sum()
        mean = (part["n"] * part["mean"]).sum() / n
        squares = part["squares"].sum() + (part["n"] * (part["mean"] - mean) ** 2).sum()
        return pd.DataFrame({key: [part[key].iloc[0]], "n": [n], "mean": [mean], "squares": [squares]})

    def fold(batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
        states = [
            batch.groupby(key)[value].agg(
                n="count", mean="mean", squares=lambda v: float(np.square(v - v.mean()).sum())
            ).reset_index()
            for batch in batches
            if len(batch)
        ]
        if not states:
            return pd.DataFrame({key: [], "n": [], "mean": [], "squares": []})
        together = pd.concat(states)
        return pd.concat([merge(part) for _, part in together.groupby(key)])

    rows = df.select(key, F.col(value).cast("double").alias(value)).where(F.col(key).isNotNull()).na.drop("any")
    return merge_states(rows, [key], fold, merge, f"{key} {key_type}, n bigint, mean double, squares double")
