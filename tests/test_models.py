"""Model fits on small frames: quality floors, drawn settings, save and load."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from millrace.operators import models
from millrace.sources.storage import scratch_path


@pytest.fixture(scope="module")
def volumes(spark):
    draw = np.random.default_rng(8)
    days = pd.bdate_range("2019-01-01", periods=400)
    a = draw.uniform(0, 10, (400, 4))
    pdf = pd.DataFrame(a, columns=["avg_1", "avg_5", "avg_10", "avg_15"])
    pdf["y"] = 3 + 2 * pdf["avg_1"] - pdf["avg_10"] + draw.normal(0, 0.1, 400)
    pdf["day"] = days
    df = spark.createDataFrame(pdf).withColumn("day", F.col("day").cast("date"))
    return df.withColumn("yyyymm", F.date_format("day", "yyyyMM")).cache()


@pytest.mark.parametrize("kind, floor", [("linear", 0.99), ("svm", 0.9)])
def test_regressors_fit_the_last_fifth(volumes, kind, floor):
    model, held_out = models.fit_volume(volumes, kind, ["avg_1", "avg_5", "avg_10", "avg_15"], "y", ["day"])
    score = held_out.first()
    assert score["n"] == 80 and score["r2"] > floor
    months = models.backtest_by_month(model, volumes, "y", "yyyymm")
    assert months.count() == volumes.select("yyyymm").distinct().count()


def test_linear_coefficients_are_least_squares(volumes):
    model, _ = models.fit_volume(volumes, "linear", ["avg_1", "avg_5", "avg_10", "avg_15"], "y", ["day"])
    pdf = volumes.orderBy("day").toPandas().head(320)
    design = np.column_stack([pdf[["avg_1", "avg_5", "avg_10", "avg_15"]], np.ones(320)])
    beta, *_ = np.linalg.lstsq(design, pdf["y"], rcond=None)
    assert np.allclose(model.model.coefficients.toArray(), beta[:4]) and model.model.intercept == pytest.approx(beta[4])


def test_unknown_regressor(volumes):
    with pytest.raises(ValueError):
        models.VolumeModel("forest", volumes, ["avg_1"], "y")


@pytest.fixture(scope="module")
def people(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(240, 3))
    label = (x[:, 0] + 0.2 * draw.normal(size=240) > 0.4).astype(float)
    rows = [(i, float(label[i]), *map(float, x[i])) for i in range(240)]
    df = spark.createDataFrame(rows, "id bigint, label double, a double, b double, c double")
    return models.feature_vector(df, ["a", "b", "c"]).cache()


def test_folds_are_balanced_within_classes(people):
    folded = models.stratified_folds(people, "label", "id")
    table = folded.groupBy("label", "fold").count().toPandas().pivot(index="label", columns="fold", values="count")
    assert (table.max(axis=1) - table.min(axis=1) <= 1).all()


def test_search_refits_the_best_and_survives_saving(spark, people):
    search = models.random_search(people, "logistic", "id", draws=2)
    score, setting = models.best_setting(search)
    assert score > 0.9 and score == max(search.avgMetrics) and set(setting) == {"regParam", "tol"}
    path = scratch_path(spark, "model")
    search.bestModel.write().save(path)
    again = LogisticRegressionModel.load(path)
    assert np.allclose(again.coefficients.toArray(), search.bestModel.coefficients.toArray())
    scored = models.backtest(again, people).toPandas()
    assert list(scored.columns) == ["y_true", "proba", "pred"]
    assert ((scored["proba"] > 0.5) == (scored["pred"] == 1)).all()
    assert (scored["y_true"] == scored["pred"]).mean() > 0.9


@pytest.mark.parametrize("kind", ["logistic", "random_forest", "gradient_boost"])
def test_drawn_settings_stay_in_range(spark, kind):
    model, settings = models.search_space(kind, 1000, 4, 50, 3)
    values = [{p.name: v for p, v in s.items()} for s in settings]
    assert len(values) == 50
    if kind == "logistic":
        assert all(1 / (100 * 1000) <= v["regParam"] <= 1 / (0.1 * 1000) for v in values)
    else:
        low, high = (3, 7) if kind == "random_forest" else (3, 4)
        assert all(low <= v["maxDepth"] <= high for v in values)
    if kind == "random_forest":
        assert all(50 <= v["numTrees"] < 100 and int(v["featureSubsetStrategy"]) <= 4 for v in values)
    if kind == "gradient_boost":
        assert all(10 <= v["maxIter"] < 40 and 0.05 <= v["stepSize"] <= 0.3 for v in values)
    with pytest.raises(ValueError):
        models.search_space("xgb", 1, 1, 1, 1)


def test_logistic_markers_point_at_the_right_gene(spark):
    draw = np.random.default_rng(2)
    rows = []
    for i in range(90):
        group = "abc"[i % 3]
        vector = draw.uniform(0, 1, 4)
        vector["abc".index(group)] += 3
        rows.append((group, vector.tolist()))
    df = spark.createDataFrame(rows, "`group` string, vector array<double>")
    got = models.logistic_markers(df, ["ga", "gb", "gc", "gd"]).toPandas()
    best = got.loc[got.groupby("group")["score"].idxmax()].set_index("group")["gene"]
    assert best.to_dict() == {"a": "ga", "b": "gb", "c": "gc"}


def test_stacked_fits_equal_separate_ones(spark):
    draw = np.random.default_rng(21)
    x = draw.normal(size=(240, 4)) * [1, 3, 0.2, 1]
    y = (x @ [1.5, -0.5, 2.0, 0.0] + 0.7 + draw.logistic(size=240) > 0).astype(float)
    people = spark.createDataFrame([(i, float(y[i]), *map(float, x[i])) for i in range(240)], "id bigint, label double, a double, b double, c double, d double")
    rows = models.feature_vector(people, ["a", "b", "c", "d"]).select("id", "label", "features")
    folded = models.stratified_folds(rows, "label", "id")
    packed = folded.select(F.concat(vector_to_array("features"), F.array("label", F.col("fold").cast("double"))).alias("packed")).cache()
    penalties = [0.01, 1.0, 50.0]
    weights = models.stacked_logistic(packed, np.array(penalties), 3)
    for s, penalty in enumerate(penalties[:2]):
        for fold in range(2):
            one = LogisticRegression(labelCol="label", standardization=False, regParam=penalty, tol=1e-10, maxIter=500).fit(folded.where(F.col("fold") != fold))
            assert np.allclose(weights[s, fold], [*one.coefficients, one.intercept], atol=1e-4)
    search = models.random_search(rows, "logistic", "id", draws=3)
    validator = CrossValidator(
        estimator=LogisticRegression(labelCol="label", standardization=False, maxIter=250), estimatorParamMaps=search.settings,
        evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy"), numFolds=3, foldCol="fold",
    )
    estimator, settings = models.search_space("logistic", 240, 4, 3, 7)
    validator.setEstimator(estimator).setEstimatorParamMaps(settings)
    separate = validator.fit(folded).avgMetrics
    assert np.allclose(search.avgMetrics, separate, atol=0.01)
    assert np.argmax(search.avgMetrics) == np.argmax(separate)


def test_separable_classes_still_end(spark):
    rows = spark.createDataFrame([([float(i), float(i > 20), float(i % 3)],) for i in range(40)], "packed array<double>")
    weights = models.stacked_logistic(rows, np.array([1e-3]), 3)
    assert np.isfinite(weights).all()
    assert models.logistic_accuracies(rows, weights)[0] > 0.9
