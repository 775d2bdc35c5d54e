"""Count-matrix queries: cell = customer, gene = part name, value = quantity ordered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators import counts, filters, markers
from millrace.plans.registry import bound, fixed, fixed_sql
from millrace.sources.storage import materialize
from millrace.sources.tables import table

MATRIX_SQL = """
    m AS (
      SELECT o_custkey AS cell, p_name AS gene, sum(l_quantity) AS value
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
      GROUP BY 1, 2)
"""
GROUPS_SQL = 'g AS (SELECT c_custkey AS cell, c_mktsegment AS "group" FROM customer WHERE c_custkey IN (SELECT cell FROM m))'
LOGGED_SQL = """
    x AS (SELECT cell, gene, ln(1 + value / sum(value) OVER (PARTITION BY cell) * 10000) AS value FROM m)
"""


def count_matrix(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = table(spark, root, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, root, "part").select("p_partkey", "p_name")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("cell"), F.col("p_name").alias("gene"))
        .agg(F.sum("l_quantity").alias("value"))
    )


def stored_matrix(spark: SparkSession, root: str) -> DataFrame:
    """The matrix written once, for queries that read it several times."""
    return materialize(count_matrix(spark, root), "matrix")


def cell_groups(spark: SparkSession, root: str, long: DataFrame) -> DataFrame:
    customers = table(spark, root, "customer").select(
        F.col("c_custkey").alias("cell"), F.col("c_mktsegment").alias("group")
    )
    return customers.join(long.select("cell").distinct(), "cell", "left_semi")


def red() -> Column:
    return F.col("gene").startswith("red ")


QUALITY_SQL = """
    q AS (
      SELECT cell, count(*) FILTER (WHERE value > 0) AS n_genes, sum(value) AS total,
             coalesce(sum(value) FILTER (WHERE starts_with(gene, 'red ')), 0) AS flagged_total,
             100 * coalesce(sum(value) FILTER (WHERE starts_with(gene, 'red ')), 0) / sum(value) AS flagged_pct
      FROM m GROUP BY cell)
"""


@bound(
    "cell_qc",
    f"""
    WITH {MATRIX_SQL}, {QUALITY_SQL}
    SELECT cell, n_genes, total, flagged_total, {fixed_sql('flagged_pct')} AS flagged_pct FROM q
    """,
)
def cell_qc(spark: SparkSession, root: str) -> DataFrame:
    matrix = count_matrix(spark, root)
    return counts.cell_quality(matrix, red()).withColumn("flagged_pct", fixed("flagged_pct"))


@bound(
    "qc_threshold_filter",
    f"""
    WITH {MATRIX_SQL}, {QUALITY_SQL}
    SELECT cell, gene, value FROM m
    WHERE cell IN (SELECT cell FROM q WHERE n_genes < 30 AND flagged_pct < 12)
    """,
)
def qc_threshold_filter(spark: SparkSession, root: str) -> DataFrame:
    matrix = stored_matrix(spark, root)
    return counts.below_thresholds(matrix, counts.cell_quality(matrix, red()), 30, 12.0)


@bound(
    "support_filter",
    f"""
    WITH {MATRIX_SQL},
    c AS (SELECT cell FROM m GROUP BY cell HAVING count(*) >= 30),
    k AS (SELECT * FROM m WHERE cell IN (SELECT cell FROM c)),
    gs AS (SELECT gene FROM k GROUP BY gene HAVING count(*) >= (SELECT 0.45 * count(*) FROM c))
    SELECT * FROM k WHERE gene IN (SELECT gene FROM gs)
    """,
)
def support_filter(spark: SparkSession, root: str) -> DataFrame:
    matrix = stored_matrix(spark, root)
    rich = matrix.groupBy("cell").count().where("count >= 30").count()
    least = -(-45 * rich // 100)
    return filters.by_support(matrix, "cell", "gene", 30, least)


@bound(
    "top_share_genes",
    f"""
    WITH {MATRIX_SQL},
    s AS (SELECT cell, gene, 100 * value / sum(value) OVER (PARTITION BY cell) AS pct FROM m)
    SELECT gene, {fixed_sql('sum(pct) / (SELECT count(DISTINCT cell) FROM m)', 6)} AS mean_pct
    FROM s GROUP BY gene ORDER BY mean_pct DESC, gene LIMIT 20
    """,
)
def top_share_genes(spark: SparkSession, root: str) -> DataFrame:
    top = counts.top_share_genes(stored_matrix(spark, root))
    return top.withColumn("mean_pct", fixed("mean_pct", 6))


@bound(
    "normalize_log",
    f"WITH {MATRIX_SQL}, {LOGGED_SQL} SELECT cell, gene, {fixed_sql('value', 6)} AS value FROM x",
)
def normalize_log(spark: SparkSession, root: str) -> DataFrame:
    return counts.normalize_log(count_matrix(spark, root)).withColumn("value", fixed("value", 6))


VARIABLE_SQL = """
    n AS (SELECT count(DISTINCT cell)::DOUBLE AS n FROM m),
    st AS (
      SELECT gene, sum(exp(value) - 1) / any_value(n) AS mu,
             greatest((sum((exp(value) - 1) * (exp(value) - 1)) - sum(exp(value) - 1) * sum(exp(value) - 1) / any_value(n))
               / (any_value(n) - 1), 0) AS v
      FROM x, n GROUP BY gene),
    lg AS (SELECT gene, ln(1 + mu) AS mean, CASE WHEN v > 0 THEN ln(v / mu) END AS dispersion FROM st),
    b AS (
      SELECT *, greatest(ceil((mean - min(mean) OVER ()) / (max(mean) OVER () - min(mean) OVER ()) * 20) - 1, 0)::INTEGER AS bin
      FROM lg),
    z AS (
      SELECT *, CASE WHEN count(dispersion) OVER (PARTITION BY bin) = 1 THEN 1
                     ELSE (dispersion - avg(dispersion) OVER (PARTITION BY bin))
                          / stddev_samp(dispersion) OVER (PARTITION BY bin) END AS score
      FROM b)
"""


@bound(
    "variable_genes",
    f"""
    WITH {MATRIX_SQL}, {LOGGED_SQL}, {VARIABLE_SQL}
    SELECT gene, {fixed_sql('mean', 6)} AS mean, {fixed_sql('dispersion', 6)} AS dispersion, bin,
           {fixed_sql('score', 5)} AS score,
           mean > 0.0125 AND mean < 6 AND score > 0.5 AS variable
    FROM z
    """,
)
def variable_genes(spark: SparkSession, root: str) -> DataFrame:
    logged = materialize(counts.normalize_log(count_matrix(spark, root)), "logged")
    found = counts.variable_genes(logged, max_mean=6.0)
    return found.withColumns(
        {"mean": fixed("mean", 6), "dispersion": fixed("dispersion", 6), "score": fixed("score", 5)}
    )


RESIDUAL_SQL = f"""
    {MATRIX_SQL}, {LOGGED_SQL}, {QUALITY_SQL},
    kept AS (SELECT DISTINCT gene FROM x),
    cov AS (SELECT cell, total - avg(total) OVER () AS a, flagged_pct - avg(flagged_pct) OVER () AS b FROM q),
    s AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb FROM cov),
    d AS (
      SELECT cov.cell, kept.gene, a, b, coalesce(x.value, 0) AS y
      FROM cov, kept LEFT JOIN x ON x.cell = cov.cell AND x.gene = kept.gene),
    p AS (SELECT gene, avg(y) AS mu, sum(a * y) AS pa, sum(b * y) AS pb FROM d GROUP BY gene),
    f AS (
      SELECT gene, mu, (bb * pa - ab * pb) / (aa * bb - ab * ab) AS ba, (aa * pb - ab * pa) / (aa * bb - ab * ab) AS bb2
      FROM p, s),
    r AS (SELECT d.cell, d.gene, y - mu - ba * a - bb2 * b AS value FROM d JOIN f ON d.gene = f.gene)
"""


def residuals(spark: SparkSession, root: str) -> DataFrame:
    matrix = stored_matrix(spark, root)
    quality = materialize(counts.cell_quality(matrix, red()), "quality")
    logged = materialize(counts.normalize_log(matrix), "logged")
    cells = quality.select("cell", "total", "flagged_pct")
    return counts.regress_out(logged, cells, ("total", "flagged_pct"))


@bound(
    "regress_residual",
    f"WITH {RESIDUAL_SQL} SELECT cell, gene, {fixed_sql('value', 5)} AS value FROM r",
)
def regress_residual(spark: SparkSession, root: str) -> DataFrame:
    return residuals(spark, root).withColumn("value", fixed("value", 5))


@bound(
    "scale_clip",
    f"""
    WITH {RESIDUAL_SQL}
    SELECT cell, gene, {fixed_sql('least((value - avg(value) OVER w) / (stddev_samp(value) OVER w), 2.0)', 5)} AS value
    FROM r WINDOW w AS (PARTITION BY gene)
    """,
)
def scale_clip(spark: SparkSession, root: str) -> DataFrame:
    scaled = counts.scale_clip(materialize(residuals(spark, root), "residuals"), limit=2.0)
    return scaled.withColumn("value", fixed("value", 5))


@bound(
    "group_expression",
    f"""
    WITH {MATRIX_SQL}, {LOGGED_SQL}, {GROUPS_SQL},
    sizes AS (SELECT "group", count(*) AS cells FROM g GROUP BY 1),
    genes AS (SELECT DISTINCT gene FROM x),
    e AS (SELECT gene, "group", sum(value) AS s, count(*) AS k FROM x JOIN g USING (cell) GROUP BY 1, 2)
    SELECT genes.gene, sizes."group", cells, {fixed_sql('coalesce(s, 0) / cells', 6)} AS mean,
           {fixed_sql('coalesce(k, 0) / cells', 6)} AS fraction
    FROM genes CROSS JOIN sizes LEFT JOIN e ON e.gene = genes.gene AND e."group" = sizes."group"
    """,
)
def group_expression(spark: SparkSession, root: str) -> DataFrame:
    logged = materialize(counts.normalize_log(count_matrix(spark, root)), "logged")
    summary = counts.group_expression(logged, cell_groups(spark, root, logged))
    return summary.withColumns({"mean": fixed("mean", 6), "fraction": fixed("fraction", 6)})


@bound(
    "qc_quantiles",
    f"""
    WITH {MATRIX_SQL}, {QUALITY_SQL}, {GROUPS_SQL},
    r AS (SELECT "group", total, row_number() OVER (PARTITION BY "group" ORDER BY total) AS i,
                 count(*) OVER (PARTITION BY "group") AS n FROM q JOIN g USING (cell))
    SELECT "group", min(total) FILTER (WHERE i >= ceil(0.25 * n)) AS q25,
           min(total) FILTER (WHERE i >= ceil(0.5 * n)) AS q50,
           min(total) FILTER (WHERE i >= ceil(0.75 * n)) AS q75
    FROM r GROUP BY 1
    """,
)
def qc_quantiles(spark: SparkSession, root: str) -> DataFrame:
    """Quartiles of cell totals by group, the numbers behind a violin plot."""
    matrix = stored_matrix(spark, root)
    quality = counts.cell_quality(matrix, red()).join(cell_groups(spark, root, matrix), "cell")
    return counts.exact_quantiles(quality, ["group"], "total", [0.25, 0.5, 0.75])


@bound(
    "gene_quantiles",
    f"""
    WITH {MATRIX_SQL}, {GROUPS_SQL},
    r AS (SELECT gene, "group", value, row_number() OVER (PARTITION BY gene, "group" ORDER BY value) AS i,
                 count(*) OVER (PARTITION BY gene, "group") AS n FROM m JOIN g USING (cell))
    SELECT gene, "group", min(value) FILTER (WHERE i >= ceil(0.25 * n)) AS q25,
           min(value) FILTER (WHERE i >= ceil(0.5 * n)) AS q50,
           min(value) FILTER (WHERE i >= ceil(0.75 * n)) AS q75
    FROM r GROUP BY 1, 2
    """,
)
def gene_quantiles(spark: SparkSession, root: str) -> DataFrame:
    """Quartiles of the counts present, per gene and group."""
    matrix = stored_matrix(spark, root)
    grouped = matrix.join(cell_groups(spark, root, matrix), "cell")
    return counts.exact_quantiles(grouped, ["gene", "group"], "value", [0.25, 0.5, 0.75])


RANK_SQL = """
    dense AS (
      SELECT gn.gene, g.cell, g."group", coalesce(x.value, 0) AS value
      FROM (SELECT DISTINCT gene FROM x) gn CROSS JOIN g LEFT JOIN x ON x.gene = gn.gene AND x.cell = g.cell),
    ranked AS (
      SELECT gene, "group", rank() OVER (PARTITION BY gene ORDER BY value)
               + (count(*) OVER (PARTITION BY gene, value) - 1) / 2.0 AS r
      FROM dense),
    rs AS (SELECT gene, "group", sum(r)::DOUBLE AS rank_sum, count(*) AS n FROM ranked GROUP BY 1, 2),
    zs AS (
      SELECT gene, "group", rank_sum, (rank_sum - n * (nn + 1) / 2.0) / sqrt(n * (nn - n) * (nn + 1) / 12.0) AS score
      FROM (SELECT *, sum(n) OVER (PARTITION BY gene)::DOUBLE AS nn FROM rs))
"""
TOP_SQL = f"""
    SELECT "group", gene, {fixed_sql('score', 6)} AS score, rank::INTEGER AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY score DESC, gene) AS rank FROM zs)
    WHERE rank <= 25
"""


def logged_with_groups(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    logged = materialize(counts.normalize_log(count_matrix(spark, root)), "logged")
    return logged, cell_groups(spark, root, logged)


@bound(
    "avg_rank",
    f"""
    WITH {MATRIX_SQL}, {LOGGED_SQL}, {GROUPS_SQL}, {RANK_SQL.replace('coalesce(x.value, 0)', 'round(coalesce(x.value, 0), 6)')}
    SELECT gene, "group", n AS n_group, {fixed_sql('rank_sum', 2)} AS rank_sum FROM rs
    """,
)
def avg_rank(spark: SparkSession, root: str) -> DataFrame:
    logged, groups = logged_with_groups(spark, root)
    sums = markers.rank_sums(logged.withColumn("value", F.round("value", 6)), groups)
    return sums.select("gene", "group", "n_group", fixed("rank_sum", 2).alias("rank_sum"))


@bound(
    "ranksum_rank",
    f"WITH {MATRIX_SQL}, x AS (SELECT * FROM m), {GROUPS_SQL}, {RANK_SQL} {TOP_SQL}",
)
def ranksum_rank(spark: SparkSession, root: str) -> DataFrame:
    matrix = stored_matrix(spark, root)
    scores = markers.rank_sum_scores(matrix, cell_groups(spark, root, matrix)).drop("rank_sum")
    return markers.top_markers(scores, 25).select("group", "gene", fixed("score", 6).alias("score"), "rank")


@bound(
    "ranksum_pair",
    f"""
    WITH {MATRIX_SQL}, x AS (SELECT * FROM m),
    {GROUPS_SQL.replace('WHERE', "WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND")}, {RANK_SQL}
    SELECT gene, {fixed_sql('rank_sum', 2)} AS rank_sum, {fixed_sql('score', 6)} AS score FROM zs WHERE "group" = 'BUILDING'
    """,
)
def ranksum_pair(spark: SparkSession, root: str) -> DataFrame:
    matrix = stored_matrix(spark, root)
    scores = markers.against_one(matrix, cell_groups(spark, root, matrix), "BUILDING", "MACHINERY")
    return scores.select("gene", fixed("rank_sum", 2).alias("rank_sum"), fixed("score", 6).alias("score"))


@bound(
    "welch_rank",
    f"""
    WITH {MATRIX_SQL}, {LOGGED_SQL}, {GROUPS_SQL},
    dense AS (
      SELECT gn.gene, g.cell, g."group", coalesce(x.value, 0) AS value
      FROM (SELECT DISTINCT gene FROM x) gn CROSS JOIN g LEFT JOIN x ON x.gene = gn.gene AND x.cell = g.cell),
    zs AS (
      SELECT d.gene, k."group",
             (avg(value) FILTER (WHERE d."group" = k."group") - avg(value) FILTER (WHERE d."group" <> k."group"))
             / sqrt(var_samp(value) FILTER (WHERE d."group" = k."group") / count(*) FILTER (WHERE d."group" = k."group")
                  + var_samp(value) FILTER (WHERE d."group" <> k."group") / count(*) FILTER (WHERE d."group" <> k."group")) AS score
      FROM dense d CROSS JOIN (SELECT DISTINCT "group" FROM g) k GROUP BY 1, 2)
    {TOP_SQL}
    """,
)
def welch_rank(spark: SparkSession, root: str) -> DataFrame:
    logged, groups = logged_with_groups(spark, root)
    top = markers.top_markers(markers.welch_scores(logged, groups), 25)
    return top.select("group", "gene", fixed("score", 6).alias("score"), "rank")


@bound("marker_pvalues")
def marker_pvalues(spark: SparkSession, root: str) -> DataFrame:
    """Two-sided p-values of both tests per gene and group."""
    logged, groups = logged_with_groups(spark, root)
    welch = markers.welch_scores(logged, groups)
    ranked = markers.rank_sum_scores(logged, groups).select("gene", "group", F.col("score").alias("z"))
    return welch.join(ranked, ["gene", "group"]).select(
        "gene",
        "group",
        markers.student_p("score", "freedom").alias("welch_p"),
        markers.normal_p("z").alias("ranksum_p"),
    )
