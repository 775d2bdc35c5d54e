"""Genes that set one group of cells apart from the rest.

Inputs are a sparse table (cell, gene, value) with values >= 0 and a table
(cell, group).  Sums per (gene, group) and per gene are enough for every test;
"rest" is total minus group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.operators.aggregates import top_per_group
from millrace.operators.counts import gene_by_group
from millrace.operators.sequences import running_sums


def welch_scores(long: DataFrame, groups: DataFrame) -> DataFrame:
    """Welch t of each gene in each group against all other cells, with degrees of freedom."""
    value = F.col("value")
    sums = (
        long.join(groups, "cell")
        .groupBy("gene", "group")
        .agg(F.sum(value).alias("_s"), F.sum(value * value).alias("_q"))
    )
    per_gene = sums.groupBy("gene").agg(F.sum("_s").alias("_st"), F.sum("_q").alias("_qt"))
    zero = F.lit(0.0)
    table = (
        gene_by_group(long, groups)
        .join(sums, ["gene", "group"], "left")
        .join(per_gene, "gene")
        .withColumns({"_s": F.coalesce("_s", zero), "_q": F.coalesce("_q", zero)})
        .withColumns({"_n": F.col("n_group"), "_nr": F.col("n_cells") - F.col("n_group")})
        .withColumns({"_m": F.col("_s") / F.col("_n"), "_mr": F.try_divide(F.col("_st") - F.col("_s"), F.col("_nr"))})
    )

    def variance(q: Column, mean: Column, n: Column) -> Column:
        return F.greatest(F.try_divide(q - n * mean * mean, n - 1), zero)

    a = variance(F.col("_q"), F.col("_m"), F.col("_n")) / F.col("_n")
    b = F.try_divide(variance(F.col("_qt") - F.col("_q"), F.col("_mr"), F.col("_nr")), F.col("_nr"))
    parts = table.withColumns({"_a": a, "_b": b})
    freedom = F.try_divide(
        F.pow(F.col("_a") + F.col("_b"), F.lit(2.0)),
        F.try_divide(F.col("_a") * F.col("_a"), F.col("_n") - 1)
        + F.try_divide(F.col("_b") * F.col("_b"), F.col("_nr") - 1),
    )
    return parts.select(
        "gene",
        "group",
        F.try_divide(F.col("_m") - F.col("_mr"), F.sqrt(F.col("_a") + F.col("_b"))).alias("score"),
        freedom.alias("freedom"),
        (F.col("_m") - F.col("_mr")).alias("difference"),
    )


def rank_sums(long: DataFrame, groups: DataFrame) -> DataFrame:
    """Sum of average-tie ranks per gene and group, absent zeros included as one block of ties.

    Equal values of a gene are counted first; a running count over distinct
    values gives each its average rank.  The zeros of a gene rank below all
    entries and are never written out.
    """
    entries = long.where(F.col("value") > 0).join(groups, "cell")
    counted = entries.groupBy("gene", "value", "group").agg(F.count("*").alias("_k"))
    by_value = counted.groupBy("gene", "value").agg(
        F.sum("_k").alias("_c"), F.collect_list(F.struct("group", "_k")).alias("_groups")
    )
    running = running_sums(by_value, ["gene"], ["value"], {"_upto": F.col("_c")})
    middle = F.col("_upto") - F.col("_c") + (F.col("_c") + 1) / F.lit(2.0)
    per_group = (
        running.withColumn("_rank", middle)
        .select("gene", "_rank", F.inline("_groups"))
        .groupBy("gene", "group")
        .agg(F.sum(F.col("_k") * F.col("_rank")).alias("_above"), F.sum("_k").alias("_seen"))
    )
    seen = per_group.groupBy("gene").agg(F.sum("_seen").alias("_nnz"))
    zeros = F.col("n_cells") - F.coalesce("_nnz", F.lit(0))
    k = F.coalesce("_seen", F.lit(0))
    total = (
        F.coalesce("_above", F.lit(0.0))
        + k * zeros
        + (F.col("n_group") - k) * (zeros + 1) / F.lit(2.0)
    )
    return (
        gene_by_group(long, groups)
        .join(per_group, ["gene", "group"], "left")
        .join(seen, "gene", "left")
        .select("gene", "group", "n_group", "n_cells", total.alias("rank_sum"))
    )


def rank_sum_scores(long: DataFrame, groups: DataFrame) -> DataFrame:
    """Rank-sum z by normal approximation, without tie correction."""
    n, m = F.col("n_group").cast("double"), (F.col("n_cells") - F.col("n_group")).cast("double")
    spread = F.sqrt(n * m * (F.col("n_cells") + 1) / F.lit(12.0))
    z = F.try_divide(F.col("rank_sum") - n * (F.col("n_cells") + 1) / F.lit(2.0), spread)
    return rank_sums(long, groups).select("gene", "group", "rank_sum", z.alias("score"))


def against_one(long: DataFrame, groups: DataFrame, group: str, reference: str) -> DataFrame:
    """Rank-sum scores of one group against one other group instead of the rest."""
    pair = groups.where(F.col("group").isin(group, reference))
    kept = long.join(pair.select("cell"), "cell", "left_semi")
    return rank_sum_scores(kept, pair).where(F.col("group") == group)


def top_markers(scores: DataFrame, n: int = 25) -> DataFrame:
    return top_per_group(scores, ["group"], [F.col("score").desc_nulls_last(), F.col("gene").asc()], n)


# Tail probabilities, in numpy over Arrow batches. -----------------------------


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz method)."""
    tiny = 1e-300
    guard = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c = np.ones_like(x)
    d = 1.0 / guard(1.0 - (a + b) * x / (a + 1.0))
    result = d.copy()
    for m in range(1, 300):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1.0 / guard(1.0 + even * d)
        c = guard(1.0 + even / c)
        result = result * d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1.0 / guard(1.0 + odd * d)
        c = guard(1.0 + odd / c)
        step = d * c
        result = result * step
        if np.all(np.abs(step - 1.0) < 1e-15):
            break
    return result


def _log_beta(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    return lgamma(a) + lgamma(b) - lgamma(a + b)


def student_two_sided(t: np.ndarray, freedom: np.ndarray) -> np.ndarray:
    """P(|T| > |t|) of Student's t, by the incomplete beta I_x(v/2, 1/2) with x = v / (v + t^2)."""
    t, v = np.asarray(t, float), np.asarray(freedom, float)
    out = np.full(t.shape, np.nan)
    usable = np.isfinite(t) & np.isfinite(v) & (v > 0)
    if not usable.any():
        return out
    t, v = t[usable], v[usable]
    x = v / (v + t * t)
    a, b = v / 2.0, np.full_like(v, 0.5)
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(a * np.log(x) + b * np.log1p(-x) - _log_beta(a, b))
    direct = x < (a + 1.0) / (a + b + 2.0)
    p = np.where(
        direct,
        front * _beta_fraction(a, b, np.where(direct, x, 0.1)) / a,
        1.0 - front * _beta_fraction(b, a, np.where(direct, 0.1, 1.0 - x)) / b,
    )
    out[usable] = np.where(t == 0, 1.0, np.clip(p, 0.0, 1.0))
    return out


@F.pandas_udf(T.DoubleType())
def student_p(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Two-sided p-value of a t statistic and its degrees of freedom."""
    for t, freedom in parts:
        p = student_two_sided(t.to_numpy(float), freedom.to_numpy(float))
        yield pd.Series(p).astype(object).where(~np.isnan(p), None)


@F.pandas_udf(T.DoubleType())
def normal_p(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Two-sided p-value of a z score."""
    for z in parts:
        yield z.map(lambda v: None if pd.isna(v) else math.erfc(abs(v) / math.sqrt(2.0)))
