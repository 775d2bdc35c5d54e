"""Sparse count tables (cell, gene, value): quality control, normalising, variable genes.

Zero entries are absent, so every mean, variance and fraction here takes the
number of cells as its denominator instead of the number of rows.  A cell never
has more entries than there are genes; nothing is grouped by gene without
combining first, so a gene present in all cells is no hot spot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.window import Window

from millrace.operators.filters import keep_entities
from millrace.operators.sequences import running_sums


def cell_totals(long: DataFrame) -> Column:
    return F.sum("value").over(Window.partitionBy("cell"))


def cell_quality(long: DataFrame, flagged: Column) -> DataFrame:
    """Genes seen, total, flagged total and flagged percentage per cell."""
    amount = F.sum("value")
    marked = F.coalesce(F.sum(F.when(flagged, F.col("value"))), F.lit(0.0))
    return long.groupBy("cell").agg(
        F.count_if(F.col("value") > 0).alias("n_genes"),
        amount.alias("total"),
        marked.alias("flagged_total"),
        (100 * F.try_divide(marked, amount)).alias("flagged_pct"),
    )


def below_thresholds(long: DataFrame, quality: DataFrame, max_genes: int, max_pct: float) -> DataFrame:
    """Entries of cells under both quality limits."""
    kept = quality.where((F.col("n_genes") < max_genes) & (F.col("flagged_pct") < max_pct))
    return long.join(kept.select("cell"), "cell", "left_semi")


def cell_count(long: DataFrame) -> Column:
    return long.agg(F.count_distinct("cell")).scalar()


def top_share_genes(long: DataFrame, n: int = 20) -> DataFrame:
    """Genes with the highest mean share of a cell's total, in percent; cells without the gene count as 0."""
    share = 100 * F.try_divide(F.col("value"), F.col("_total"))
    means = (
        long.withColumn("_total", cell_totals(long))
        .groupBy("gene")
        .agg((F.sum(share) / cell_count(long)).alias("mean_pct"))
    )
    return means.orderBy(F.col("mean_pct").desc(), "gene").limit(n)


def normalize_log(long: DataFrame, target: float = 1e4) -> DataFrame:
    """Counts scaled to the same total per cell, then ln(1 + x)."""
    scaled = F.col("value") / F.col("_total") * target
    return long.withColumn("_total", cell_totals(long)).withColumn("value", F.log1p(scaled)).drop("_total")


def variable_genes(
    logged: DataFrame,
    min_mean: float = 0.0125,
    max_mean: float = 3.0,
    min_dispersion: float = 0.5,
    bins: int = 20,
) -> DataFrame:
    """Genes whose variance-to-mean ratio stands out among genes of like mean.

    Means and variances are of the back-transformed values.  Genes fall into
    equal-width bins of log mean, closed on the right; the score is the
    z-score of log dispersion in its bin, 1 for a gene alone in a bin.
    """
    value = F.expm1("value")
    n = cell_count(logged).cast("double")
    sums = logged.groupBy("gene").agg(F.sum(value).alias("_s"), F.sum(value * value).alias("_q"))
    mean = F.col("_s") / F.col("_n")
    variance = F.greatest((F.col("_q") - F.col("_s") * mean) / (F.col("_n") - 1), F.lit(0.0))
    ratio = F.try_divide(variance, mean)
    stats = sums.withColumn("_n", n).select(
        "gene",
        F.log1p(mean).alias("mean"),
        F.when(ratio > 0, F.log(ratio)).alias("dispersion"),
    )
    span = stats.agg(F.struct(F.min("mean").alias("lo"), F.max("mean").alias("hi"))).scalar()
    place = F.try_divide(F.col("mean") - F.col("_span.lo"), F.col("_span.hi") - F.col("_span.lo"))
    number = F.coalesce(F.greatest(F.ceil(place * bins) - 1, F.lit(0)), F.lit(0))
    binned = stats.withColumn("_span", span).withColumn("bin", number.cast("int")).drop("_span")
    by_bin = binned.groupBy("bin").agg(
        F.avg("dispersion").alias("_mean"),
        F.stddev_samp("dispersion").alias("_sd"),
        F.count("dispersion").alias("_genes"),
    )
    score = F.when(F.col("_genes") == 1, F.when(F.col("dispersion").isNotNull(), 1.0)).otherwise(
        F.try_divide(F.col("dispersion") - F.col("_mean"), F.col("_sd"))
    )
    # by_bin has one row per bin.
    scored = binned.join(F.broadcast(by_bin), "bin").withColumn("score", score)
    kept = (F.col("mean") > min_mean) & (F.col("mean") < max_mean) & (F.col("score") > min_dispersion)
    return scored.withColumn("variable", F.coalesce(kept, F.lit(False))).select(
        "gene", "mean", "dispersion", "bin", "score", "variable"
    )


def keep_genes(long: DataFrame, genes: DataFrame) -> DataFrame:
    return keep_entities(long, genes, "gene")


def kept_names(genes: DataFrame) -> list[str]:
    """Kept genes in name order.

    They reach the driver, as the dense steps number them: about 100 bytes per
    gene there, and eight bytes per gene and cell in the tasks.
    """
    return sorted(r["gene"] for r in genes.select("gene").distinct().collect())


def _numbered(spark: SparkSession, names: list[str]) -> DataFrame:
    return F.broadcast(spark.createDataFrame(list(enumerate(names)), "position int, gene string"))


def _scatter(width: int):
    """(positions, values) to a dense array; a cell without entries is all zeros."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def dense(positions: pd.Series, values: pd.Series) -> pd.Series:
        out = np.zeros((len(positions), width))
        for row, (at, v) in enumerate(zip(positions, values)):
            if at is not None:
                out[row, at] = v
        return pd.Series(list(out))

    return dense


def dense_vectors(long: DataFrame, cells: DataFrame, names: list[str]) -> DataFrame:
    """Per listed cell an array with one value per listed gene, zeros filled in."""
    entries = (
        long.join(_numbered(long.sparkSession, names), "gene")
        .groupBy("cell")
        .agg(F.collect_list(F.struct("position", "value")).alias("_e"))
    )
    vector = _scatter(len(names))(F.col("_e.position"), F.col("_e.value"))
    return cells.join(entries, "cell", "left").withColumn("vector", vector).drop("_e")


def regression_slopes(long: DataFrame, cells: DataFrame, covariates: tuple[str, str]) -> DataFrame:
    """Per gene the mean and the two least-squares slopes on centred cell covariates.

    The covariate moments are the same for all genes: one 2x2 matrix, inverted
    on the driver.  Absent zeros add nothing to the cross products.
    """
    a, b = covariates
    m = cells.agg(
        F.count("*").alias("n"),
        F.avg(a).alias("ma"),
        F.avg(b).alias("mb"),
        F.var_pop(a).alias("aa"),
        F.var_pop(b).alias("bb"),
        F.covar_pop(a, b).alias("ab"),
    ).first()
    inverse = np.linalg.pinv(np.array([[m["aa"], m["ab"]], [m["ab"], m["bb"]]]) * m["n"])
    centred = cells.select("cell", (F.col(a) - m["ma"]).alias("_a"), (F.col(b) - m["mb"]).alias("_b"))
    products = (
        long.join(centred, "cell")
        .groupBy("gene")
        .agg(
            (F.sum("value") / F.lit(float(m["n"]))).alias("mean"),
            F.sum(F.col("_a") * F.col("value")).alias("_pa"),
            F.sum(F.col("_b") * F.col("value")).alias("_pb"),
        )
    )
    slope = lambda row: F.lit(float(row[0])) * F.col("_pa") + F.lit(float(row[1])) * F.col("_pb")
    return products.select(
        "gene",
        "mean",
        slope(inverse[0]).alias("slope_a"),
        slope(inverse[1]).alias("slope_b"),
        F.lit(float(m["ma"])).alias("centre_a"),
        F.lit(float(m["mb"])).alias("centre_b"),
    )


def regress_out(long: DataFrame, cells: DataFrame, covariates: tuple[str, str]) -> DataFrame:
    """Residuals of every listed cell and every gene in `long`, which are dense.

    `long` must already be cut to the kept genes: the result has one row per
    cell and kept gene.  The fit, five numbers per kept gene, passes the driver
    and goes to the tasks as arrays, so cells are filled in where they lie.
    """
    a, b = covariates
    fit = sorted(
        regression_slopes(long, cells, covariates).collect(),
        key=lambda r: r["gene"],
    )
    names = [r["gene"] for r in fit]
    mean, slope_a, slope_b, centre_a, centre_b = (
        np.array([r[c] for r in fit]) for c in ("mean", "slope_a", "slope_b", "centre_a", "centre_b")
    )

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def residual(vector: pd.Series, first: pd.Series, second: pd.Series) -> pd.Series:
        observed = np.stack(vector.to_list()).reshape(len(vector), len(names))
        fitted = (
            mean
            + slope_a * (first.to_numpy(float)[:, None] - centre_a)
            + slope_b * (second.to_numpy(float)[:, None] - centre_b)
        )
        return pd.Series(list(observed - fitted))

    vectors = dense_vectors(long, cells, names).withColumn("vector", residual("vector", a, b))
    return long_form(vectors, names)


def long_form(vectors: DataFrame, names: list[str]) -> DataFrame:
    """Dense cell vectors back to (cell, gene, value)."""
    entries = vectors.select("cell", F.posexplode("vector").alias("position", "value"))
    return entries.join(_numbered(vectors.sparkSession, names), "position").select("cell", "gene", "value")


def scale_clip(dense: DataFrame, limit: float = 10.0, lower: float | None = None) -> DataFrame:
    """Each gene to mean 0 and variance 1 (n - 1), cut at `limit` and, if given, at `lower`.

    A gene that does not vary is only centred.
    """
    stats = dense.groupBy("gene").agg(F.avg("value").alias("_m"), F.stddev_samp("value").alias("_s"))
    spread = F.when(F.col("_s") > 0, F.col("_s")).otherwise(F.lit(1.0))
    z = F.least((F.col("value") - F.col("_m")) / spread, F.lit(float(limit)))
    if lower is not None:
        z = F.greatest(z, F.lit(float(lower)))
    scaled = dense.join(stats, "gene")
    return scaled.select("cell", "gene", z.alias("value"))


def gene_by_group(long: DataFrame, groups: DataFrame) -> DataFrame:
    """All genes with all groups, group sizes (n_group) and the number of cells (n_cells).

    The result has a row per gene and group, so the groups reach the genes as one
    list: a number and a name per group.
    """
    sizes = groups.groupBy("group").agg(F.count("*").alias("n_group"))
    listed = sizes.agg(F.collect_list(F.struct("group", "n_group"))).scalar()
    everyone = sizes.agg(F.sum("n_group")).scalar()
    return (
        long.select("gene")
        .distinct()
        .withColumn("s", F.explode(listed))
        .select("gene", "s.group", "s.n_group", everyone.alias("n_cells"))
    )


def group_expression(long: DataFrame, groups: DataFrame) -> DataFrame:
    """Mean and fraction of expressing cells per gene and group; absent entries count as zero.

    `groups` has columns cell and group.
    """
    frame = gene_by_group(long, groups).select("gene", "group", F.col("n_group").alias("cells"))
    sums = (
        long.join(groups, "cell")
        .groupBy("gene", "group")
        .agg(F.sum("value").alias("_sum"), F.count_if(F.col("value") > 0).alias("_seen"))
    )
    return frame.join(sums, ["gene", "group"], "left").select(
        "gene",
        "group",
        "cells",
        (F.coalesce("_sum", F.lit(0.0)) / F.col("cells")).alias("mean"),
        (F.coalesce("_seen", F.lit(0)) / F.col("cells")).alias("fraction"),
    )


def exact_quantiles(long: DataFrame, by: list[str], value: str, shares: list[float]) -> DataFrame:
    """Smallest value at or above each share of the rows, per key; exact for keys of any size."""
    counted = long.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    running = running_sums(counted, by, [value], {"_upto": F.col("_n")})
    totals = counted.groupBy(*by).agg(F.sum("_n").alias("_all"))
    if by:
        ranked = running.join(totals, by)
    else:
        ranked = running.withColumn("_all", counted.agg(F.sum("_n")).scalar())
    reached = [
        F.min(F.when(F.col("_upto") >= F.ceil(F.lit(q) * F.col("_all")), F.col(value))).alias(f"q{round(q * 100)}")
        for q in shares
    ]
    return ranked.groupBy(*by).agg(*reached)
