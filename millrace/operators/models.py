"""Regressors and classifiers on Spark ML, random search, backtests."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.operators.evaluation import r_squared
from millrace.operators.linear import total_of
from millrace.operators.sequences import running_sums
from millrace.operators.splits import ordered_split


def feature_vector(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    values = F.array(*[F.col(c).cast("double") for c in columns])
    return df.withColumn(name, array_to_vector(values))


# Regressors ----------------------------------------------------------------------


class FourierFeatures:
    """Random features whose products approximate an RBF kernel (Rahimi and Recht 2007).

    Stands in for a kernel regressor, which needs all pairs of rows: inputs are
    standardised with the training rows' moments, the kernel width is
    1 / number of inputs.
    """

    def __init__(self, training: DataFrame, columns: Sequence[str], size: int = 128, seed: int = 7):
        self.columns = list(columns)
        row = training.agg(
            *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
        ).first()
        count = len(self.columns)
        self.mean = np.array([row[f"m{i}"] for i in range(count)], float)
        spread = np.array([row[f"s{i}"] for i in range(count)], float)
        self.spread = np.where(spread > 0, spread, 1.0)
        draw = np.random.default_rng(seed)
        self.directions = draw.normal(0.0, math.sqrt(2.0 / count), (count, size))
        self.phases = draw.uniform(0.0, 2.0 * math.pi, size)

    def transform(self, df: DataFrame, name: str = "features") -> DataFrame:
        mean, spread, directions, phases = self.mean, self.spread, self.directions, self.phases

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def lift(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in parts:
                rows = (np.column_stack([c.to_numpy(float) for c in columns]) - mean) / spread
                lifted = np.sqrt(2.0 / len(phases)) * np.cos(rows @ directions + phases)
                yield pd.Series(list(lifted), dtype=object)

        return df.withColumn(name, array_to_vector(lift(*[F.col(c).cast("double") for c in self.columns])))


class VolumeModel:
    """A fitted regressor with its input columns: kind linear, svm or gradient_boost."""

    def __init__(self, kind: str, training: DataFrame, columns: Sequence[str], label: str):
        self.kind, self.columns = kind, list(columns)
        self.lift = FourierFeatures(training, columns) if kind == "svm" else None
        estimators = {
            "linear": lambda: LinearRegression(labelCol=label, solver="normal"),
            "svm": lambda: LinearRegression(labelCol=label, loss="huber", maxIter=100, tol=1e-4),
            "gradient_boost": lambda: GBTRegressor(labelCol=label, maxIter=100, maxDepth=3, stepSize=0.1, seed=7),
        }
        if kind not in estimators:
            raise ValueError("kind is linear, svm or gradient_boost")
        inputs = self._inputs(training).cache()
        self.model: Model = estimators[kind]().fit(inputs)
        inputs.unpersist()

    def _inputs(self, df: DataFrame) -> DataFrame:
        return self.lift.transform(df) if self.lift else feature_vector(df, self.columns)

    def predict(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self._inputs(df)).drop("features")


def fit_volume(
    rows: DataFrame, kind: str, columns: Sequence[str], label: str, order: Sequence[str]
) -> tuple[VolumeModel, DataFrame]:
    """Model fitted on the first 80 % of `rows` in order, and its score on the rest (n, r2)."""
    split = ordered_split(rows, order, 0.2)
    model = VolumeModel(kind, split.where("part = 'train'").drop("part"), columns, label)
    test = model.predict(split.where("part = 'test'").drop("part"))
    return model, r_squared(test, label, "prediction", [])


def backtest_by_month(model: VolumeModel, rows: DataFrame, label: str, month: str) -> DataFrame:
    """Score of every month in one pass: (month, n, r2)."""
    return r_squared(model.predict(rows), label, "prediction", [month])


# Classifiers ---------------------------------------------------------------------


def _log_uniform(draw: random.Random, low: float, high: float) -> float:
    return math.exp(draw.uniform(math.log(low), math.log(high)))


def search_space(kind: str, rows: int, features: int, draws: int, seed: int) -> tuple[Estimator, list[dict]]:
    """Estimator and randomly drawn parameter settings.

    Integer ranges exclude their upper end.  C of the logistic model becomes
    regParam = 1 / (C n); a minimum split size becomes half as many rows per
    leaf; a minimum loss reduction becomes a minimum information gain.
    """
    draw = random.Random(seed)
    if kind == "logistic":
        model = LogisticRegression(labelCol="label", standardization=False, maxIter=250)
        settings = [
            {
                model.regParam: 1.0 / (_log_uniform(draw, 0.1, 100.0) * rows),
                model.tol: _log_uniform(draw, 1e-6, 1e-4),
            }
            for _ in range(draws)
        ]
    elif kind == "random_forest":
        model = RandomForestClassifier(labelCol="label", seed=seed)
        settings = [
            {
                model.maxDepth: draw.randrange(3, 8),
                model.featureSubsetStrategy: str(min(draw.randrange(2, 9), features)),
                model.numTrees: draw.randrange(50, 100),
                model.minInstancesPerNode: math.ceil(draw.randrange(3, 7) / 2),
            }
            for _ in range(draws)
        ]
    elif kind == "gradient_boost":
        model = GBTClassifier(labelCol="label", seed=seed)
        settings = [
            {
                model.maxDepth: draw.choice([3, 4]),
                model.minInfoGain: _log_uniform(draw, 1e-3, 1e-2),
                model.minInstancesPerNode: draw.randrange(1, 10),
                model.stepSize: _log_uniform(draw, 0.05, 0.3),
                model.maxIter: draw.randrange(10, 40),
            }
            for _ in range(draws)
        ]
    else:
        raise ValueError("kind is logistic, random_forest or gradient_boost")
    return model, settings


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 3, seed: int = 7) -> DataFrame:
    """Fold number 0..folds-1 dealt out in turn within each class, in hash order."""
    ordered = df.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key)))
    dealt = running_sums(ordered, [label], ["_h", key], {"_i": F.lit(1)})
    return dealt.withColumn("fold", ((F.col("_i") - 1) % folds).cast("int")).drop("_h", "_i")


@dataclass
class Search:
    """The settings tried, their mean accuracies over the folds, and the best one refitted on all rows."""

    settings: list[dict]
    avgMetrics: list[float]
    bestModel: Model


NEWTON_PASSES = 30
FLAT = 1e-9  # gradient per row at which a fit is done


def stacked_logistic(rows: DataFrame, penalties: np.ndarray, folds: int) -> np.ndarray:
    """Weights (penalty, fold, feature and intercept) of logistic fits that leave out one fold each.

    A penalty is that of Spark's regParam, per row of a fit's own rows.
    `rows` has `packed`: features, then label and fold.  All fits share every pass over
    the rows: a pass adds the gradients and second derivatives of each, 8 d^2
    bytes per fit, and all take their Newton step, halved where the last one
    went too far.  The intercept is not penalised.
    """
    width = len(rows.first()["packed"]) - 1  # features and intercept
    fold = np.tile(np.arange(folds), len(penalties))
    per_row = np.repeat(penalties, folds)[:, None] * np.append(np.ones(width - 1), 0.0)
    fits = len(fold)

    def sums(packed: np.ndarray, weights: np.ndarray) -> np.ndarray:
        x = np.column_stack([packed[:, :-2], np.ones(len(packed))])
        inside = packed[:, -1][:, None] != fold
        margin = x @ weights.T
        chance = 0.5 * (1 + np.tanh(margin / 2))
        loss = (np.logaddexp(0, margin) - packed[:, -2][:, None] * margin) * inside
        slope = x.T @ ((chance - packed[:, -2][:, None]) * inside)
        bend = chance * (1 - chance) * inside
        curves = np.stack([(x * bend[:, m : m + 1]).T @ x for m in range(fits)])
        return np.concatenate([loss.sum(axis=0), inside.sum(axis=0), slope.T.ravel(), curves.ravel()])

    weights, step, before = np.zeros((fits, width)), np.zeros((fits, width)), np.full(fits, np.inf)
    for _ in range(NEWTON_PASSES):
        found = total_of(rows, "packed", lambda packed, w=weights: sums(packed, w))
        loss, counted, slope, curves = np.split(found, np.cumsum([fits, fits, fits * width]))
        strength = per_row * counted[:, None]
        loss = loss + 0.5 * (strength * weights**2).sum(axis=1)
        slope = slope.reshape(fits, width) + strength * weights
        curves = curves.reshape(fits, width, width) + strength[:, :, None] * np.identity(width)
        failed = loss > before * (1 + 1e-12)
        ahead = -np.stack([np.linalg.lstsq(c, s, rcond=None)[0] for c, s in zip(curves, slope)])
        done = ~failed & (np.abs(slope).max(axis=1) <= FLAT * np.maximum(counted, 1))
        if done.all():
            break
        # back to half of the last step, or on with the next one
        base = np.where(failed[:, None], weights - step, weights)
        step = np.where(failed[:, None], step / 2, np.where(done[:, None], 0.0, ahead))
        before = np.where(failed, before, loss)
        weights = base + step
    return weights.reshape(len(penalties), folds, width)


def logistic_accuracies(rows: DataFrame, weights: np.ndarray) -> list[float]:
    """Mean over the folds of the share of rows that the fits without them get right, per penalty."""
    settings, folds, width = weights.shape

    def hits(packed: np.ndarray) -> np.ndarray:
        x = np.column_stack([packed[:, :-2], np.ones(len(packed))])
        right = (x @ weights.reshape(-1, width).T > 0) == (packed[:, -2][:, None] > 0.5)
        own = packed[:, -1][:, None] == np.arange(folds)
        return np.concatenate([(right & np.tile(own, settings)).sum(axis=0), own.sum(axis=0)]).astype(float)

    found = total_of(rows, "packed", hits)
    return (found[:-folds].reshape(settings, folds) / found[-folds:]).mean(axis=1).tolist()


def random_search(
    rows: DataFrame, kind: str, key: str, draws: int = 10, folds: int = 3, seed: int = 7, parallelism: int = 8
) -> Search:
    """Best of `draws` settings by cross-validated accuracy, refitted on all rows.

    `rows` has columns features (vector), label and the key.  All logistic fits
    are one stack of models that share each pass; the trees are fitted one by one.
    """
    folded = stratified_folds(rows, "label", key, folds, seed).cache()
    n = folded.count()
    width = folded.select("features").first()["features"].size
    estimator, settings = search_space(kind, n, width, draws, seed)
    try:
        if kind == "logistic":
            packed = folded.select(
                F.concat(vector_to_array("features"), F.array("label", F.col("fold").cast("double"))).alias("packed")
            ).cache()
            weights = stacked_logistic(packed, np.array([s[estimator.regParam] for s in settings]), folds)
            metrics = logistic_accuracies(packed, weights)
            packed.unpersist()
            best = estimator.fit(folded, settings[int(np.argmax(metrics))])
            return Search(settings, metrics, best)
        validator = CrossValidator(
            estimator=estimator,
            estimatorParamMaps=settings,
            evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy"),
            numFolds=folds,
            foldCol="fold",
            parallelism=parallelism,
            seed=seed,
        )
        found = validator.fit(folded)
        return Search(settings, list(found.avgMetrics), found.bestModel)
    finally:
        folded.unpersist()


def best_setting(search: Search) -> tuple[float, dict[str, object]]:
    """Best mean accuracy and its parameters by name."""
    best = int(np.argmax(search.avgMetrics))
    return search.avgMetrics[best], {p.name: v for p, v in search.settings[best].items()}


def backtest(model: Model, rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(y_true, proba, pred) of a fitted classifier."""
    proba: Column = vector_to_array("probability")[1]
    return model.transform(rows).select(
        *keep,
        F.col("label").cast("int").alias("y_true"),
        proba.alias("proba"),
        F.col("prediction").cast("int").alias("pred"),
    )


def logistic_markers(vectors: DataFrame, names: Sequence[str], max_iter: int = 100) -> DataFrame:
    """Coefficient of every gene in every group of a multinomial logistic model.

    `vectors` has columns group and vector (array, one value per name).
    """
    groups = sorted(r[0] for r in vectors.select("group").distinct().collect())
    label = F.array_position(F.array(*[F.lit(g) for g in groups]), F.col("group")).cast("double") - 1
    rows = vectors.select(array_to_vector("vector").alias("features"), label.alias("label")).cache()
    model = LogisticRegression(
        family="multinomial", regParam=1.0 / rows.count(), standardization=False, maxIter=max_iter
    ).fit(rows)
    rows.unpersist()
    table = model.coefficientMatrix.toArray()
    frame = pd.DataFrame({"group": np.repeat(groups, len(names)), "gene": np.tile(names, len(groups)), "score": table.ravel()})
    return vectors.sparkSession.createDataFrame(frame, "`group` string, gene string, score double")
