"""End-to-end flows from input files to stored results.

Each flow reads the original file formats, writes every stage as a table under
`out`, and returns the tables a user looks at first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.arrays import bytes_to_floats
from millrace.functions.dates import month_text
from millrace.operators import aggregates, communities, counts, evaluation, filters, joins, linear, markers, models, moving, neighbours, splits
from millrace.operators.onehot import signed_one_hot
from millrace.operators.sequences import number_rows
from millrace.sources import files, matrix_market

AVERAGES = [f"avg_{w}" for w in moving.WINDOWS]


def _store(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Daily volumes ------------------------------------------------------------------------


def stock(
    spark: SparkSession,
    csv: str,
    out: str,
    start: str = "00000000",
    kinds: Sequence[str] = ("linear", "svm", "gradient_boost"),
) -> dict[str, DataFrame]:
    """Date and Volume -> lagged averages -> one regressor per kind -> score per month.

    Returns features, scores (kind, yyyymm, n, r2) and held_out (kind, n, r2).
    """
    raw = files.read_csv_columns(spark, csv, {"Date": "date", "Volume": "double"})
    files.write_by_month(raw.withColumn("yyyymm", month_text(F.col("Date"))), f"{out}/months", "yyyymm")
    months = files.read_months(spark, f"{out}/months", "Date date, Volume double, yyyymm string", "yyyymm")
    daily = moving.daily_series(months, "Date", "Volume")
    features = _store(moving.training_rows(daily, start=start), f"{out}/features")
    for kind in kinds:
        model, held_out = models.fit_volume(features, kind, AVERAGES, "y", ["day"])
        model.model.write().overwrite().save(f"{out}/models/{kind}")
        scores = models.backtest_by_month(model, features, "y", "yyyymm")
        scores.write.mode("overwrite").parquet(f"{out}/scores/kind={kind}")
        held_out.write.mode("overwrite").parquet(f"{out}/held_out/kind={kind}")
    return {
        "features": features,
        "scores": spark.read.schema("yyyymm string, n bigint, r2 double, kind string").parquet(f"{out}/scores"),
        "held_out": spark.read.schema("n bigint, r2 double, kind string").parquet(f"{out}/held_out"),
    }


# Churn ----------------------------------------------------------------------------------

# Columns of the customer and transaction files, and the derived feature names.
CUSTOMER_COLUMNS = {
    "CustomerId": "bigint", "CreditScore": "double", "Geography": "string", "Gender": "string", "Age": "double",
    "Tenure": "double", "Balance": "double", "NumOfProducts": "double", "HasCrCard": "int",
    "IsActiveMember": "int", "EstimatedSalary": "double", "Exited": "int",
}
TRANSACTION_COLUMNS = {"TransactionId": "bigint", "CustomerId": "bigint", "Amount": "double"}
RATIOS = {
    "BalanceSalaryRatio": ("Balance", "EstimatedSalary"),
    "TenureByAge": ("Tenure", "Age"),
    "CreditScoreGivenAge": ("CreditScore", "Age"),
}
CONTINUOUS = [
    "CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "EstimatedSalary", *RATIOS,
]


def churn_table(rows: DataFrame, key: str) -> DataFrame:
    """Key, Exited and features: ratios, 0/1 flags as -1/1, signed one-hot, continuous columns scaled to 0..1."""
    kept = filters.add_ratios(rows, RATIOS).select(
        key, "Exited", *CONTINUOUS, "HasCrCard", "IsActiveMember", "Geography", "Gender"
    )
    flagged = kept.withColumns({c: filters.signed(F.col(c)) for c in ("HasCrCard", "IsActiveMember")})
    coded = signed_one_hot(flagged, ["Geography", "Gender"])
    return aggregates.minmax_scale(coded, CONTINUOUS).na.fill(0.0, CONTINUOUS)


def churn(
    spark: SparkSession,
    customers_csv: str,
    transactions_csv: str,
    out: str,
    kinds: Sequence[str] = ("logistic", "random_forest", "gradient_boost"),
    draws: int = 10,
    per_transaction: bool = False,
    holdout: float = 0.2,
) -> dict[str, DataFrame]:
    """Customers joined to transactions -> features -> searched classifiers -> reports and curves.

    The join is stored as it is, one row per transaction; features are per
    customer unless `per_transaction`.  Scores come from held-out rows; with
    holdout 0 they are in-sample.
    """
    customers = files.read_csv_columns(spark, customers_csv, CUSTOMER_COLUMNS)
    transactions = files.read_csv_columns(spark, transactions_csv, TRANSACTION_COLUMNS)
    joined = _store(joins.inner_join(customers, transactions, "CustomerId"), f"{out}/joined")
    key = "TransactionId" if per_transaction else "CustomerId"
    with_rows = joined if per_transaction else customers.join(joined.select("CustomerId"), "CustomerId", "left_semi")
    features = _store(churn_table(with_rows, key), f"{out}/features")
    inputs = [c for c in features.columns if c not in (key, "Exited")]
    vectors = models.feature_vector(features, inputs).select(key, F.col("Exited").cast("double").alias("label"), "features")
    split = splits.shuffled_split(vectors, key, 7, 1.0 - holdout, 0, 1.0)
    train = split.where("part = 'train'").drop("part")
    test = split.where("part = 'test'").drop("part") if holdout else train
    for kind in kinds:
        search = models.random_search(train, kind, key, draws)
        search.bestModel.write().overwrite().save(f"{out}/models/{kind}")
        result = _store(models.backtest(search.bestModel, test, [key]), f"{out}/results/kind={kind}")
        reports = {
            "report": evaluation.classification_report(result, "y_true", "pred"),
            "sweep": evaluation.roc_sweep(result, "y_true", "proba"),
            "area": evaluation.area_under_curve(result, "y_true", "proba"),
        }
        for name, table in reports.items():
            table.write.mode("overwrite").parquet(f"{out}/{name}/kind={kind}")
    read = lambda name, schema: spark.read.schema(f"{schema}, kind string").parquet(f"{out}/{name}")
    return {
        "shares": aggregates.class_share(features, "Exited"),
        "features": features,
        "results": read("results", f"{key} bigint, y_true int, proba double, pred int"),
        "report": read("report", "label string, precision double, recall double, f1 double, support bigint"),
        "sweep": read(
            "sweep", "step int, threshold double, true_positives bigint, false_positives bigint, tpr double, fpr double"
        ),
        "area": read("area", "positives bigint, negatives bigint, auc double"),
    }


# Monthly series ------------------------------------------------------------------------------

# The data sets and the patterns of their series ids.
SERIES_PATTERNS = {
    "Heating Degree Days": r"^STEO.ZWHD_[^_]*\.M$",
    "Cooling Degree Days": r"^STEO.ZWCD_[^_]*.M$",
    "Electricity Generation": r"^STEO.NGEPGEN_[^_]*\.M$",
}


def weather(
    spark: SparkSession, jsonl: str, patterns: Mapping[str, str] = SERIES_PATTERNS, digits: int = 2
) -> DataFrame:
    """Month-of-year means of the series of every data set, from one scan: (dataset, series_id, name, m1..m12)."""
    records = files.read_json_lines(spark, jsonl, "series_id string, name string, data array<array<string>>")
    named = F.filter(
        F.array(*[F.when(F.col("series_id").rlike(p), F.lit(n)) for n, p in patterns.items()]),
        lambda n: n.isNotNull(),
    )
    chosen = records.where("series_id is not null").select(
        F.explode(named).alias("dataset"), "series_id", "name", "data"
    )
    keys = ["dataset", "series_id", "name"]
    means = aggregates.month_of_year_mean(files.series_pairs(chosen), keys, "yyyymm", "value")
    wide = aggregates.series_by_month(means, keys)
    return wide.select(*keys, *[F.round(f"m{m}", digits).alias(f"m{m}") for m in range(1, 13)])


# Video labels ----------------------------------------------------------------------------------


def frame_vectors(frames: DataFrame) -> DataFrame:
    """(id, labels, rgb, audio) byte frames to (id, labels, x) with both parts in one float vector."""
    x = F.concat(bytes_to_floats("rgb"), bytes_to_floats("audio"))
    return frames.select("id", "labels", x.alias("x"))


def video_labels(
    spark: SparkSession, train: str, validate: str, out: str, ridges: Sequence[float] = linear.RIDGES, keep: int = 5
) -> dict[str, DataFrame]:
    """Frames -> shared moments -> one linear model per ridge -> best labels per video -> label totals.

    `train` and `validate` are Parquet frames (id, labels, rgb, audio).  The
    validation frames are read once: each video's mean vector serves all models.
    """
    model = _store(linear.ridge_fit(frame_vectors(spark.read.parquet(train)), "x", "labels", ridges), f"{out}/model")
    frames = frame_vectors(spark.read.parquet(validate))
    labels = frames.groupBy("id").agg(F.max("labels").alias("actual"))
    videos = _store(linear.group_means(frames, ["id"], "x").join(labels, "id"), f"{out}/videos")
    for number, ridge in enumerate(ridges):
        own = model.where(F.col("ridge") == float(ridge))
        best = linear.linear_scores(videos, "mean", own, keep).select("id", "actual", "scores")
        best.write.mode("overwrite").parquet(f"{out}/predicted/model={number}")
    predicted = spark.read.schema(
        "id string, actual array<int>, scores array<struct<label:int,score:double>>, model int"
    ).parquet(f"{out}/predicted")
    totals = evaluation.set_confusion(
        predicted.withColumn("labels", F.col("scores.label")), "labels", "actual", ["model"]
    )
    named = F.element_at(F.array(*[F.lit(float(r)) for r in ridges]), F.col("model") + 1)
    return {"model": model, "predicted": predicted, "totals": totals.withColumn("ridge", named)}


# Single cells ------------------------------------------------------------------------------------


def single_cell(
    spark: SparkSession,
    folder: str,
    out: str,
    min_genes: int = 200,
    min_cells: int = 3,
    max_genes: int = 2500,
    max_flagged_pct: float = 5.0,
    flag_prefix: str = "MT-",
    components: int = 40,
    near: int = 10,
    **variable: float,
) -> dict[str, DataFrame]:
    """Count matrix text -> filters -> normalised -> variable genes -> components -> neighbours -> clusters -> markers."""
    raw = _store(matrix_market.read_matrix(spark, folder), f"{out}/raw")
    supported = _store(filters.by_support(raw, "cell", "gene", min_genes, min_cells), f"{out}/supported")
    quality = _store(counts.cell_quality(supported, F.col("gene").startswith(flag_prefix)), f"{out}/quality")
    passed = counts.below_thresholds(supported, quality, max_genes, max_flagged_pct)
    logged = _store(counts.normalize_log(passed), f"{out}/logged")
    genes = _store(counts.variable_genes(logged, **variable), f"{out}/genes")
    kept = counts.keep_genes(logged, genes.where("variable"))
    cells = quality.join(logged.select("cell").distinct(), "cell", "left_semi").select("cell", "total", "flagged_pct")
    scaled = _store(
        counts.scale_clip(_store(counts.regress_out(kept, cells, ("total", "flagged_pct")), f"{out}/residuals")),
        f"{out}/scaled",
    )
    names = counts.kept_names(scaled)
    vectors = _store(counts.dense_vectors(scaled, cells.select("cell"), names), f"{out}/vectors")
    found = linear.principal_components(vectors, "vector", min(components, len(names)))
    variance = spark.createDataFrame(
        [(i, float(v), float(s)) for i, (v, s) in enumerate(zip(found.variance, found.share))],
        "component int, variance double, share double",
    )
    scores = _store(vectors.select("cell", linear.project(F.col("vector"), found).alias("scores")), f"{out}/scores")
    stored = _store(number_rows(scores, ["cell"], "id")[0], f"{out}/numbered")
    graph = _store(
        neighbours.undirected(neighbours.nearest_neighbours(stored, "id", "scores", near), "id", "neighbour"),
        f"{out}/graph",
    )
    groups = communities.cluster_graph(graph)
    clusters = _store(
        stored.join(groups, "id").select("cell", F.col("cluster").cast("string").alias("group")), f"{out}/clusters"
    )
    return {
        "quality": quality,
        "genes": genes,
        "variance": variance,
        "clusters": clusters,
        "modularity": neighbours.modularity(graph, groups),
        "t_markers": markers.top_markers(markers.welch_scores(logged, clusters)),
        "ranksum_markers": markers.top_markers(markers.rank_sum_scores(logged, clusters)),
        "logistic_markers": markers.top_markers(
            models.logistic_markers(
                counts.dense_vectors(logged, clusters, counts.kept_names(genes.where("variable"))),
                counts.kept_names(genes.where("variable")),
            )
        ),
        "expression": counts.group_expression(logged, clusters),
    }


# Small flows ---------------------------------------------------------------------------------------


def cities(spark: SparkSession, csv: str) -> dict[str, DataFrame]:
    """Total and per-state population of a cities file."""
    rows = files.read_csv_columns(spark, csv, {"city": "string", "state": "string", "population": "bigint"})
    return {
        "total": aggregates.total(rows, "population"),
        "by_state": aggregates.grouped_total(rows, "state", "population"),
    }


def titles(spark: SparkSession, csv: str, actors: Sequence[str]) -> DataFrame:
    """Titles by actor from one scan, whatever the number of actors: (actor, title)."""
    rows = files.read_csv_columns(spark, csv, {"title": "string", "cast": "string"})
    named = F.filter(
        F.array(*[F.when(filters.contains_pattern(F.col("cast"), a), F.lit(a)) for a in actors]),
        lambda a: a.isNotNull(),
    )
    return rows.select(F.explode(named).alias("actor"), "title")


def title_record(spark: SparkSession, csv: str, title: str):
    """First record of a title in file order, as a row."""
    text = spark.read.option("header", True).option("escape", '"').csv(csv)
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    rows = text.select("*", *place, F.monotonically_increasing_id().alias("_row"))
    found = filters.first_record(rows, F.col("title") == title, ["_file", "_block", "_row"]).asDict()
    return {name: found[name] for name in text.columns}
