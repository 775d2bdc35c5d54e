"""Aggregations, evaluation reports and pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.dates import month_text
from millrace.operators import aggregates, evaluation, mergeable, moving
from millrace.plans.registry import bound, fixed, fixed_sql
from millrace.sources.tables import table


@bound("total_sum", "SELECT round(sum(c_acctbal), 2) AS total FROM customer")
def total_sum(spark: SparkSession, root: str) -> DataFrame:
    totals = aggregates.total(table(spark, root, "customer"), "c_acctbal")
    return totals.select(F.round("total", 2).alias("total"))


@bound(
    "group_sum",
    """
    SELECT n_name, round(sum(c_acctbal), 2) AS total
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name IS NOT NULL GROUP BY n_name ORDER BY n_name
    """,
)
def group_sum(spark: SparkSession, root: str) -> DataFrame:
    # Sum per key first: the join then meets one row per nation.
    by_key = aggregates.grouped_total(table(spark, root, "customer"), "c_nationkey", "c_acctbal", "part")
    named = by_key.join(table(spark, root, "nation"), by_key.c_nationkey == F.col("n_nationkey"))
    return aggregates.grouped_total(named, "n_name", "part").withColumn("total", F.round("total", 2))


def priority_pairs(spark: SparkSession, root: str) -> DataFrame:
    """Energy-like series: one per order priority, (yyyymm, value) pairs."""
    return table(spark, root, "orders").select(
        F.col("o_orderpriority").alias("series"),
        month_text(F.col("o_orderdate")).alias("yyyymm"),
        F.col("o_totalprice").alias("value"),
    )


@bound(
    "month_of_year_avg",
    f"""
    SELECT o_orderpriority AS series, month(o_orderdate)::INTEGER AS month,
           {fixed_sql('avg(o_totalprice)', 2)} AS mean
    FROM orders GROUP BY 1, 2
    """,
)
def month_of_year_avg(spark: SparkSession, root: str) -> DataFrame:
    means = aggregates.month_of_year_mean(priority_pairs(spark, root), ["series"], "yyyymm", "value")
    return means.withColumn("mean", fixed("mean", 2))


@bound(
    "month_pivot",
    "SELECT o_orderpriority AS series, "
    + ", ".join(
        fixed_sql(f"avg(o_totalprice) FILTER (WHERE month(o_orderdate) = {m})", 2) + f" AS m{m}"
        for m in range(1, 13)
    )
    + " FROM orders GROUP BY 1",
)
def month_pivot(spark: SparkSession, root: str) -> DataFrame:
    means = aggregates.month_of_year_mean(priority_pairs(spark, root), ["series"], "yyyymm", "value")
    wide = aggregates.series_by_month(means, ["series"])
    return wide.select("series", *[fixed(f"m{m}", 2).alias(f"m{m}") for m in range(1, 13)])


@bound(
    "class_share",
    f"""
    SELECT quality, count(*) AS n, {fixed_sql('count(*) / (SELECT count(*) FROM labels)')} AS share
    FROM labels GROUP BY quality
    """,
)
def class_share(spark: SparkSession, root: str) -> DataFrame:
    shares = aggregates.class_share(table(spark, root, "labels"), "quality")
    return shares.withColumn("share", fixed("share"))


@bound(
    "minmax_scale",
    f"""
    WITH b AS (SELECT min(p_size) a, max(p_size) b, min(p_retailprice) c, max(p_retailprice) d FROM part)
    SELECT p_partkey, {fixed_sql('(p_size - a)::DOUBLE / nullif(b - a, 0)')} AS p_size,
           {fixed_sql('(p_retailprice - c) / nullif(d - c, 0)')} AS p_retailprice,
           NULL::DOUBLE AS flat
    FROM part, b
    """,
)
def minmax_scale(spark: SparkSession, root: str) -> DataFrame:
    parts = table(spark, root, "part").select("p_partkey", "p_size", "p_retailprice", F.lit(1.0).alias("flat"))
    scaled = aggregates.minmax_scale(parts, ["p_size", "p_retailprice", "flat"])
    return scaled.select(
        "p_partkey", fixed("p_size").alias("p_size"), fixed("p_retailprice").alias("p_retailprice"), "flat"
    )


SCORED_SQL = """
    scored AS (
      SELECT quality AS y_true, n_chars / (SELECT max(n_chars) FROM documents)::DOUBLE AS proba,
             (n_chars / (SELECT max(n_chars) FROM documents)::DOUBLE > 0.1)::INTEGER AS pred
      FROM documents JOIN labels USING (doc_id))
"""


def scored_documents(spark: SparkSession, root: str) -> DataFrame:
    """Classifier output stand-in: truth, probability from length, hard prediction."""
    documents = table(spark, root, "documents").select("doc_id", "n_chars")
    longest = documents.agg(F.max("n_chars")).scalar()
    proba = F.col("n_chars") / longest.cast("double")
    return (
        documents.withColumn("proba", proba)
        .join(table(spark, root, "labels"), "doc_id")
        .select(
            F.col("quality").alias("y_true"), "proba", (F.col("proba") > 0.1).cast("int").alias("pred")
        )
    )


@bound(
    "class_report",
    f"""
    WITH {SCORED_SQL},
    labels2 AS (SELECT y_true AS label FROM scored UNION SELECT pred FROM scored),
    per AS (
      SELECT label, (SELECT count(*) FROM scored WHERE y_true = label) AS support,
             (SELECT count(*) FROM scored WHERE pred = label) AS claimed,
             (SELECT count(*) FROM scored WHERE pred = label AND y_true = label) AS hits
      FROM labels2),
    m AS (
      SELECT label::VARCHAR AS label, support, hits,
             CASE WHEN claimed = 0 THEN 0 ELSE hits / claimed END AS precision,
             CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
             CASE WHEN claimed + support = 0 THEN 0 ELSE 2.0 * hits / (claimed + support) END AS f1
      FROM per),
    l AS (
      SELECT label, precision, recall, f1, support FROM m
      UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support), sum(support) FROM m
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM m
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                       sum(f1 * support) / sum(support), sum(support) FROM m)
    SELECT label, {fixed_sql('precision')} AS precision, {fixed_sql('recall')} AS recall,
           {fixed_sql('f1')} AS f1, support::BIGINT AS support
    FROM l
    """,
)
def class_report(spark: SparkSession, root: str) -> DataFrame:
    report = evaluation.classification_report(scored_documents(spark, root), "y_true", "pred")
    return report.select("label", *[fixed(m).alias(m) for m in ("precision", "recall", "f1")], "support")


@bound(
    "roc_sweep",
    f"""
    WITH {SCORED_SQL}, steps AS (SELECT unnest(range(0, 101))::INTEGER AS step)
    SELECT step, {fixed_sql('step / 100.0::DOUBLE')} AS threshold,
           (SELECT count(*) FROM scored WHERE y_true = 1 AND proba > step / 100.0::DOUBLE) AS true_positives,
           (SELECT count(*) FROM scored WHERE y_true = 0 AND proba > step / 100.0::DOUBLE) AS false_positives,
           {fixed_sql("(SELECT count(*) FILTER (WHERE proba > step / 100.0::DOUBLE) / count(*) FROM scored WHERE y_true = 1)")} AS tpr,
           {fixed_sql("(SELECT count(*) FILTER (WHERE proba > step / 100.0::DOUBLE) / count(*) FROM scored WHERE y_true = 0)")} AS fpr
    FROM steps
    """,
)
def roc_sweep(spark: SparkSession, root: str) -> DataFrame:
    swept = evaluation.roc_sweep(scored_documents(spark, root), "y_true", "proba")
    return swept.withColumns({c: fixed(c) for c in ("threshold", "tpr", "fpr")})


@bound(
    "auc_exact",
    f"""
    WITH {SCORED_SQL},
    won AS (
      SELECT sum(CASE WHEN p.proba > n.proba THEN 1.0 WHEN p.proba = n.proba THEN 0.5 ELSE 0.0 END) AS w
      FROM (SELECT proba FROM scored WHERE y_true = 1) p, (SELECT proba FROM scored WHERE y_true = 0) n)
    SELECT (SELECT count(*) FROM scored WHERE y_true = 1) AS positives,
           (SELECT count(*) FROM scored WHERE y_true = 0) AS negatives,
           {fixed_sql('''w::DOUBLE / (SELECT count(*) FILTER (WHERE y_true = 1) * count(*) FILTER (WHERE y_true = 0)
                         FROM scored)''', 6)} AS auc
    FROM won
    """,
)
def auc_exact(spark: SparkSession, root: str) -> DataFrame:
    area = evaluation.area_under_curve(scored_documents(spark, root), "y_true", "proba")
    return area.withColumn("auc", fixed("auc", 6))


@bound(
    "auc_hard",
    f"""
    WITH {SCORED_SQL},
    t AS (
      SELECT count(*) FILTER (WHERE y_true = 1) AS p, count(*) FILTER (WHERE y_true = 0) AS n,
             count(*) FILTER (WHERE y_true = 1 AND pred = 1) AS tp, count(*) FILTER (WHERE y_true = 0 AND pred = 1) AS fp
      FROM scored)
    SELECT p AS positives, n AS negatives, {fixed_sql('(1 + tp::DOUBLE / p - fp::DOUBLE / n) / 2', 6)} AS auc FROM t
    """,
)
def auc_hard(spark: SparkSession, root: str) -> DataFrame:
    """The area of the predictions themselves, beside that of the probabilities."""
    hard = scored_documents(spark, root).withColumn("pred", F.col("pred").cast("double"))
    area = evaluation.area_under_curve(hard, "y_true", "pred")
    return area.withColumn("auc", fixed("auc", 6))


@bound(
    "roc_points",
    f"""
    WITH {SCORED_SQL},
    per AS (SELECT proba AS score, count(*) FILTER (WHERE y_true = 1) AS pos,
                   count(*) FILTER (WHERE y_true = 0) AS neg FROM scored GROUP BY 1),
    cum AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM per)
    SELECT {fixed_sql('score', 8)} AS score, tp::BIGINT AS tp, fp::BIGINT AS fp,
           {fixed_sql('tp / (SELECT sum(pos) FROM per)', 6)} AS tpr,
           {fixed_sql('fp / (SELECT sum(neg) FROM per)', 6)} AS fpr
    FROM cum
    """,
)
def roc_points(spark: SparkSession, root: str) -> DataFrame:
    points = evaluation.roc_points(scored_documents(spark, root), "y_true", "proba")
    return points.withColumns({"score": fixed("score", 8), "tpr": fixed("tpr", 6), "fpr": fixed("fpr", 6)})


@bound(
    "last_wins",
    """
    SELECT user_id, event_type, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events)
    WHERE r = 1
    """,
)
def last_wins(spark: SparkSession, root: str) -> DataFrame:
    return aggregates.last_by_key(
        table(spark, root, "events"), ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "value"]
    )


DAILY_SQL = """
    daily AS (SELECT l_shipdate::DATE AS day, sum(l_quantity) AS value FROM lineitem GROUP BY 1),
    targets AS (
      SELECT day, value, date_trunc('month', day)::DATE AS month, true AS cur FROM daily
      UNION ALL SELECT day, value, (date_trunc('month', day) + INTERVAL 1 MONTH)::DATE, false FROM daily),
    lagged AS (
      SELECT month, cur, day, value AS y,
""" + ",\n".join(
    f"CASE WHEN count(value) OVER (PARTITION BY month ORDER BY day ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) = {w}"
    f" THEN avg(value) OVER (PARTITION BY month ORDER BY day ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) END AS avg_{w}"
    for w in moving.WINDOWS
) + """
      FROM targets),
    features AS (
      SELECT strftime(month, '%Y%m') AS yyyymm, day, avg_1, avg_5, avg_10, avg_15, y FROM lagged
      WHERE cur AND month > (SELECT min(date_trunc('month', day)) FROM daily)),
    complete AS (SELECT * FROM features WHERE avg_1 + avg_5 + avg_10 + avg_15 IS NOT NULL)
"""


def daily_quantity(spark: SparkSession, root: str) -> DataFrame:
    return moving.daily_series(table(spark, root, "lineitem"), "l_shipdate", "l_quantity")


@bound(
    "lagged_moving_avg",
    f"WITH {DAILY_SQL} SELECT yyyymm, day, "
    + ", ".join(f"{fixed_sql(f'avg_{w}')} AS avg_{w}" for w in moving.WINDOWS)
    + ", y FROM complete",
)
def lagged_moving_avg(spark: SparkSession, root: str) -> DataFrame:
    rows = moving.training_rows(daily_quantity(spark, root))
    return rows.withColumns({f"avg_{w}": fixed(f"avg_{w}") for w in moving.WINDOWS})


@bound(
    "r2_by_month",
    f"""
    WITH {DAILY_SQL}
    SELECT yyyymm, count(*) AS n,
           {fixed_sql('1 - sum((y - avg_5) * (y - avg_5)) / nullif(var_pop(y) * count(y), 0)')} AS r2
    FROM complete GROUP BY yyyymm
    """,
)
def r2_by_month(spark: SparkSession, root: str) -> DataFrame:
    rows = moving.training_rows(daily_quantity(spark, root))
    return evaluation.r_squared(rows, "y", "avg_5", ["yyyymm"]).withColumn("r2", fixed("r2"))


@bound(
    "mergeable_spread",
    f"""
    SELECT l_returnflag, count(*) AS n, {fixed_sql('avg(l_extendedprice)')} AS mean,
           {fixed_sql('var_pop(l_extendedprice)', 2)} AS variance
    FROM lineitem GROUP BY l_returnflag
    """,
)
def mergeable_spread(spark: SparkSession, root: str) -> DataFrame:
    """A user-defined aggregate whose states merge pairwise."""
    states = mergeable.spread_states(table(spark, root, "lineitem"), "l_returnflag", "l_extendedprice")
    return states.select(
        "l_returnflag", "n", fixed("mean").alias("mean"), fixed(F.col("squares") / F.col("n"), 2).alias("variance")
    )


@bound("distinct_months", "SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS yyyymm FROM orders ORDER BY 1")
def distinct_months(spark: SparkSession, root: str) -> DataFrame:
    return aggregates.distinct_sorted(
        table(spark, root, "orders"), month_text(F.col("o_orderdate")), "yyyymm"
    )


STATUS_SQL = """
    leaves AS (
      SELECT user_id, event_type, event_type = 'error' AS failed, event_type = 'purchase' AS done FROM events),
    nodes AS (
      SELECT '/poll' AS node, failed, done FROM leaves
      UNION ALL SELECT '/poll/' || user_id::VARCHAR, failed, done FROM leaves
      UNION ALL SELECT '/poll/' || user_id::VARCHAR || '/' || event_type, failed, done FROM leaves),
    status AS (
      SELECT node, count(*) AS leaves, count(*) FILTER (WHERE failed) AS errors,
             bool_or(failed) AS failed, bool_and(done) AS done FROM nodes GROUP BY node)
"""


def event_status(spark: SparkSession, root: str) -> DataFrame:
    events = table(spark, root, "events").withColumn(
        "path", F.concat_ws("/", F.lit("/poll"), F.col("user_id").cast("string"), "event_type")
    )
    kind = F.col("event_type")
    return aggregates.status_rollup(events, "path", kind == "error", kind == "purchase")


@bound("status_rollup", f"WITH {STATUS_SQL} SELECT * FROM status")
def status_rollup(spark: SparkSession, root: str) -> DataFrame:
    return event_status(spark, root)


@bound(
    "feature_moments",
    f"""
    WITH e AS (SELECT unnest(embedding)::DOUBLE AS v, (generate_subscripts(embedding, 1) - 1)::INTEGER AS position FROM embeddings)
    SELECT position, count(*) AS n, {fixed_sql('avg(v)', 6)} AS mean, {fixed_sql('var_pop(v)', 6)} AS variance
    FROM e GROUP BY position
    """,
)
def feature_moments(spark: SparkSession, root: str) -> DataFrame:
    moments = aggregates.feature_moments(table(spark, root, "embeddings"), "embedding")
    return moments.withColumns({"mean": fixed("mean", 6), "variance": fixed("variance", 6)})
