"""Model queries: daily volume regressors and churn classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import aggregates, counts, evaluation, filters, markers, models, moving, splits
from millrace.operators.onehot import signed_one_hot
from millrace.plans.counting import logged_with_groups
from millrace.plans.registry import bound, fixed, fixed_sql
from millrace.plans.summaries import DAILY_SQL, daily_quantity
from millrace.sources.storage import materialize
from millrace.sources.tables import table

AVERAGES = [f"avg_{w}" for w in moving.WINDOWS]


def volume_rows(spark: SparkSession, root: str) -> DataFrame:
    return moving.training_rows(daily_quantity(spark, root))


def volume_backtest(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Score of every month, and of the held-out days."""
    rows = volume_rows(spark, root)
    model, held_out = models.fit_volume(rows, kind, AVERAGES, "y", ["day"])
    months = models.backtest_by_month(model, rows, "y", "yyyymm")
    return months.withColumn("held_out_r2", held_out.select("r2").scalar())


MONTHS_SQL = f"WITH {DAILY_SQL} SELECT yyyymm, count(*) AS n, true AS possible FROM complete GROUP BY yyyymm"


def _volume_check(spark: SparkSession, root: str, kind: str) -> DataFrame:
    found = volume_backtest(spark, root, kind)
    return found.select("yyyymm", "n", F.coalesce(F.col("r2") <= 1, F.lit(True)).alias("possible"))


@bound("volume_linear", MONTHS_SQL)
def volume_linear(spark: SparkSession, root: str) -> DataFrame:
    return _volume_check(spark, root, "linear")


@bound("volume_boosted", MONTHS_SQL)
def volume_boosted(spark: SparkSession, root: str) -> DataFrame:
    return _volume_check(spark, root, "gradient_boost")


@bound("volume_kernel", MONTHS_SQL)
def volume_kernel(spark: SparkSession, root: str) -> DataFrame:
    return _volume_check(spark, root, "svm")


@bound(
    "volume_normal",
    f"""
    WITH {DAILY_SQL}, k AS (SELECT count(*) AS n FROM complete)
    SELECT t AS term, n - ceil(0.2::DOUBLE * n)::BIGINT AS n, 0.0::DOUBLE AS against
    FROM k, (SELECT unnest(['one', {', '.join(f"'{c}'" for c in AVERAGES)}]) AS t)
    """,
)
def volume_normal(spark: SparkSession, root: str) -> DataFrame:
    """Residuals of the linear model on its training days: nothing left along any of its inputs."""
    rows = volume_rows(spark, root)
    train = splits.ordered_split(rows, ["day"], 0.2).where("part = 'train'").drop("part")
    model = models.VolumeModel("linear", train, AVERAGES, "y")
    left = model.predict(train).withColumn("left", F.col("y") - F.col("prediction")).withColumn("one", F.lit(1.0))
    cosine = lambda c: F.sum(F.col("left") * F.col(c)) / F.sqrt(F.sum(F.col("left") * F.col("left")) * F.sum(F.col(c) * F.col(c)))
    terms = ["one", *AVERAGES]
    sums = left.agg(F.count("*").alias("n"), *[fixed(cosine(c), 6).alias(c) for c in terms])
    return sums.unpivot(["n"], terms, "term", "against").select("term", "n", "against")


CONTINUOUS = ["c_acctbal", "n_orders", "mean_price", "balance_by_price", "orders_by_price"]
CHURN_DATE = "2001-01-01"

CHURN_SQL = f"""
    o AS (
      SELECT o_custkey, count(*) AS n_orders, avg(o_totalprice) AS mean_price, max(o_orderdate) AS last
      FROM orders GROUP BY 1),
    c AS (
      SELECT c_custkey, c_acctbal, coalesce(n_orders, 0) AS n_orders, coalesce(mean_price, 0.0) AS mean_price,
             c_acctbal / nullif(mean_price, 0) AS balance_by_price, n_orders / nullif(mean_price, 0) AS orders_by_price,
             CASE WHEN last >= TIMESTAMP '{CHURN_DATE}' THEN 0 ELSE 1 END AS exited,
             CASE WHEN c_acctbal < 0 THEN -1 ELSE 1 END AS in_credit, c_mktsegment, r_name
      FROM customer LEFT JOIN o ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def churn_customers(spark: SparkSession, root: str) -> DataFrame:
    """One row per customer with target and raw features."""
    orders = table(spark, root, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"),
        F.avg("o_totalprice").alias("mean_price"),
        F.max("o_orderdate").alias("last"),
    )
    places = (
        table(spark, root, "nation")
        .join(table(spark, root, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("c_nationkey"), "r_name")
    )
    late = F.col("last") >= F.lit(CHURN_DATE).cast("timestamp_ntz")
    joined = table(spark, root, "customer").join(orders, "c_custkey", "left").join(places, "c_nationkey")
    flagged = joined.withColumns(
        {
            "exited": F.when(late, 0).otherwise(1),
            "in_credit": filters.signed(F.when(F.col("c_acctbal") < 0, 0).otherwise(1)),
        }
    )
    ratios = filters.add_ratios(
        flagged, {"balance_by_price": ("c_acctbal", "mean_price"), "orders_by_price": ("n_orders", "mean_price")}
    )
    return ratios.na.fill({"n_orders": 0, "mean_price": 0.0}).select(
        "c_custkey", "exited", *CONTINUOUS, "in_credit", "c_mktsegment", "r_name"
    )


def churn_features(spark: SparkSession, root: str) -> DataFrame:
    """Scaled, ratio and signed one-hot features per customer; missing ratios become 0."""
    customers = materialize(churn_customers(spark, root), "customers")
    scaled = aggregates.minmax_scale(customers, CONTINUOUS)
    return signed_one_hot(scaled.na.fill(0.0, CONTINUOUS), ["c_mktsegment", "r_name"])


_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def _scaled_sql(column: str) -> str:
    return fixed_sql(
        f"coalesce(({column} - min({column}) OVER ())::DOUBLE / nullif(max({column}) OVER () - min({column}) OVER (), 0), 0)", 6
    ) + f" AS {column}"


@bound(
    "churn_features",
    f"WITH {CHURN_SQL} SELECT c_custkey, exited, in_credit, "
    + ", ".join(_scaled_sql(c) for c in CONTINUOUS)
    + ", "
    + ", ".join(f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE -1 END AS c_mktsegment_{s}" for s in _SEGMENTS)
    + ", "
    + ", ".join(f"CASE WHEN r_name = '{r}' THEN 1 ELSE -1 END AS \"r_name_{r}\"" for r in _REGIONS)
    + " FROM c",
)
def churn_features_query(spark: SparkSession, root: str) -> DataFrame:
    return churn_features(spark, root).withColumns({c: fixed(c, 6) for c in CONTINUOUS})


def churn_rows(spark: SparkSession, root: str) -> DataFrame:
    features = churn_features(spark, root)
    inputs = [c for c in features.columns if c not in ("c_custkey", "exited")]
    vectors = models.feature_vector(features, inputs)
    rows = vectors.select("c_custkey", F.col("exited").cast("double").alias("label"), "features")
    return splits.shuffled_split(rows, "c_custkey", 7, 0.8, 0, 1.0)


DRAWS = 10  # settings tried by each search, on three folds


def churn_predictions(spark: SparkSession, root: str, kind: str) -> tuple[DataFrame, float]:
    """Held-out predictions of the best setting found on the other customers, and its accuracy there."""
    rows = churn_rows(spark, root)
    search = models.random_search(rows.where("part = 'train'").drop("part"), kind, "c_custkey", DRAWS)
    score, _ = models.best_setting(search)
    return models.backtest(search.bestModel, rows.where("part = 'test'"), ["c_custkey"]), score


# What must hold whatever the fit: who is held out and their labels, predictions
# that follow from the probabilities, and a search that beats a coin.
HELD_OUT_SQL = f"""
    {CHURN_SQL.rstrip()},
    placed AS (
      SELECT c_custkey, exited, row_number() OVER (ORDER BY md5('7:' || c_custkey), c_custkey) - 1 AS place, count(*) OVER () AS n FROM c),
    held AS (SELECT c_custkey, exited::INTEGER AS y_true FROM placed WHERE place >= floor(0.8::DOUBLE * n))
"""
CHURN_CHECK_SQL = f"WITH {HELD_OUT_SQL} SELECT c_custkey, y_true, true AS follows, true AS proper, true AS beats_a_coin FROM held"


def _churn_check(spark: SparkSession, root: str, kind: str) -> DataFrame:
    predictions, score = churn_predictions(spark, root, kind)
    return predictions.select(
        "c_custkey",
        "y_true",
        (F.col("pred") == (F.col("proba") > 0.5).cast("int")).alias("follows"),
        F.col("proba").between(0.0, 1.0).alias("proper"),
        F.lit(score > 0.5).alias("beats_a_coin"),
    )


@bound("churn_logistic", CHURN_CHECK_SQL)
def churn_logistic(spark: SparkSession, root: str) -> DataFrame:
    return _churn_check(spark, root, "logistic")


@bound("churn_forest", CHURN_CHECK_SQL)
def churn_forest(spark: SparkSession, root: str) -> DataFrame:
    return _churn_check(spark, root, "random_forest")


@bound("churn_boosted", CHURN_CHECK_SQL)
def churn_boosted(spark: SparkSession, root: str) -> DataFrame:
    return _churn_check(spark, root, "gradient_boost")


@bound("churn_report")
def churn_report(spark: SparkSession, root: str) -> DataFrame:
    """Classification report of the held-out logistic predictions."""
    predictions, _ = churn_predictions(spark, root, "logistic")
    return evaluation.classification_report(predictions, "y_true", "pred")


@bound("marker_logistic")
def marker_logistic(spark: SparkSession, root: str) -> DataFrame:
    logged, groups = logged_with_groups(spark, root)
    names = counts.kept_names(logged)
    vectors = counts.dense_vectors(logged, groups, names)
    return markers.top_markers(models.logistic_markers(vectors, names), 25)
