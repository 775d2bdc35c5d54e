"""Train and test splits by position, and de-duplicated names."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from millrace.operators.sequences import number_rows, running_sums


def ordered_split(df: DataFrame, order: Sequence[str], test_share: float = 0.2) -> DataFrame:
    """Last ceil(share * n) rows of a stated order are 'test', the rest 'train'; no shuffle of rows."""
    numbered, n = number_rows(df, order, "_at")
    first_test = n - math.ceil(test_share * n)
    part = F.when(F.col("_at") >= first_test, "test").otherwise("train")
    return numbered.withColumn("part", part).drop("_at")


def shuffled_split(
    df: DataFrame, key: str, seed: int, train: float, validate: float, test: float
) -> DataFrame:
    """Seeded shuffle, then fixed counts: the first for training, the next for validation, the last for test.

    Whole numbers are row counts, fractions are shares of all rows rounded
    down.  The order is that of md5(seed:key), so every run and every retry
    shuffles alike.  Where the counts overlap, the earlier part wins.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    numbered, n = number_rows(df.withColumn("_digest", digest), ["_digest", key], "_at")
    train, validate, test = (v if isinstance(v, int) else math.floor(v * n) for v in (train, validate, test))
    at = F.col("_at")
    part = (
        F.when(at < train, "train")
        .when(at < train + validate, "validate")
        .when(at >= n - test, "test")
        .otherwise("unused")
    )
    return numbered.withColumn("part", part).drop("_at", "_digest")


def unique_names(df: DataFrame, name: str, order: Sequence[str]) -> DataFrame:
    """Repeated names get -1, -2, ... in order; the first keeps its name.

    A number whose suffixed name already occurs is skipped.  Such taken numbers
    join the running count: the m-th repeat moves up by one for each taken
    number t (the i-th of its name) with t - i < m.
    """
    repeats = running_sums(df, [name], order, {"_repeat": F.lit(1)}).withColumn("_repeat", F.col("_repeat") - 1)
    looks_taken = F.regexp_extract(name, r"^(.*)-([1-9][0-9]{0,17})$", 2)
    base = F.regexp_extract(name, r"^(.*)-([1-9][0-9]{0,17})$", 1)
    taken = (
        df.where(looks_taken != "")
        .select(base.alias(name), looks_taken.cast("bigint").alias("_number"))
        .distinct()
        .join(df.select(name).distinct(), name, "left_semi")
    )
    suffixed = F.when(F.col("_repeat") > 0, F.concat(F.col(name), F.lit("-"), F.col("_final").cast("string")))
    if taken.isEmpty():
        numbered = repeats.withColumn("_final", F.col("_repeat"))
    else:
        placed = running_sums(taken, [name], ["_number"], {"_i": F.lit(1)}).select(
            name, (F.col("_number") - F.col("_i") + 1).alias("_repeat"), "_i"
        )
        # Taken numbers come before the repeat they push up.
        marked = repeats.withColumns({"_kind": F.lit(1), "_i": F.lit(0).cast("bigint")}).unionByName(
            placed.withColumn("_kind", F.lit(0)), allowMissingColumns=True
        )
        counted = running_sums(
            marked, [name], ["_repeat", "_kind", "_i"], {"_pushed": F.when(F.col("_kind") == 0, 1).otherwise(0)}
        )
        numbered = (
            counted.where("_kind = 1")
            .withColumn("_final", F.col("_repeat") + F.col("_pushed"))
            .drop("_kind", "_i", "_pushed")
        )
    return numbered.withColumn(name, F.coalesce(suffixed, F.col(name))).drop("_repeat", "_final")
