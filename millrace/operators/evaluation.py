"""Scores of predictions against truth.

All reports start from counts per (truth, prediction) or per score, so what is
shuffled is as small as the number of classes or distinct scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.sequences import running_sums


def confusion_counts(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def classification_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, f1 and support per class, then accuracy, macro and weighted rows.

    As is usual for this report, a ratio with nothing below the line counts as 0.
    """
    cells = confusion_counts(df, truth, predicted)
    sides = F.array(
        F.struct(F.col("truth").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed")),
    )
    hit = F.when((F.col("truth") == F.col("predicted")) & (F.col("side.support") > 0), F.col("n")).otherwise(0)
    per_class = (
        cells.withColumn("side", F.explode(sides))
        .groupBy(F.col("side.label").alias("label"))
        .agg(
            F.sum("side.support").alias("support"),
            F.sum("side.claimed").alias("claimed"),
            F.sum(hit).alias("hits"),
        )
        .withColumns(
            {
                "precision": F.coalesce(F.try_divide(F.col("hits"), F.col("claimed")), F.lit(0.0)),
                "recall": F.coalesce(F.try_divide(F.col("hits"), F.col("support")), F.lit(0.0)),
            }
        )
        .withColumn(
            "f1",
            F.coalesce(F.try_divide(F.lit(2.0) * F.col("hits"), F.col("claimed") + F.col("support")), F.lit(0.0)),
        )
    )
    measures = ["precision", "recall", "f1"]
    accuracy = F.try_divide(F.sum("hits"), F.sum("support"))
    summary = per_class.agg(
        F.sum("support").alias("support"),
        accuracy.alias("accuracy"),
        *[F.avg(m).alias(f"macro_{m}") for m in measures],
        *[F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}") for m in measures],
    )
    lines = F.array(
        F.struct(
            F.lit("accuracy").alias("label"),
            *[F.col("accuracy").alias(m) for m in measures],
            F.col("support"),
        ),
        *[
            F.struct(
                F.lit(f"{kind} avg").alias("label"),
                *[F.col(f"{kind}_{m}").alias(m) for m in measures],
                F.col("support"),
            )
            for kind in ("macro", "weighted")
        ],
    )
    totals = summary.select(F.inline(lines))
    classes = per_class.select(F.col("label").cast("string").alias("label"), *measures, "support")
    return classes.unionByName(totals)


def _thresholds_below(score: Column, steps: int) -> Column:
    """How many of the thresholds 0/steps .. steps/steps lie strictly below the score.

    The product with `steps` may round over an edge, so the guess is repaired
    against the same quotients the thresholds are made of.
    """
    guess = F.least(F.greatest(F.ceil(score * F.lit(float(steps))), F.lit(0)), F.lit(steps + 1))
    edge = lambda k: k.cast("double") / F.lit(float(steps))
    down = F.when((guess > 0) & (edge(guess - 1) >= score), guess - 1).otherwise(guess)
    return F.when((down <= steps) & (edge(down) < score), down + 1).otherwise(down).cast("int")


def roc_sweep(df: DataFrame, truth: str, score: str, steps: int = 100) -> DataFrame:
    """True and false positive rate at th = 0, 1/steps .. 1, counting score > th.

    Rows fall into at most steps+2 bins per class first; only the bins meet the
    thresholds.
    """
    bins = (
        df.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
        .groupBy(_thresholds_below(F.col(score), steps).alias("_below"))
        .agg(F.count_if(F.col(truth) == 1).alias("_pos"), F.count_if(F.col(truth) == 0).alias("_neg"))
    )
    over = F.col("_below") > F.col("step")
    swept = (
        bins.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps))))
        .groupBy("step")
        .agg(
            F.sum(F.when(over, F.col("_pos")).otherwise(0)).alias("true_positives"),
            F.sum(F.when(over, F.col("_neg")).otherwise(0)).alias("false_positives"),
            F.sum("_pos").alias("_all_pos"),
            F.sum("_neg").alias("_all_neg"),
        )
    )
    return swept.select(
        "step",
        (F.col("step") / F.lit(float(steps))).alias("threshold"),
        "true_positives",
        "false_positives",
        F.try_divide(F.col("true_positives"), F.col("_all_pos")).alias("tpr"),
        F.try_divide(F.col("false_positives"), F.col("_all_neg")).alias("fpr"),
    )


def _cumulative_scores(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Per distinct score, class counts and their running sums from the highest score down."""
    per_score = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).alias("score"))
        .agg(F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) == 0).alias("neg"))
        .withColumn("_descending", -F.col("score"))
    )
    return running_sums(
        per_score, [], ["_descending"], {"tp": F.col("pos"), "fp": F.col("neg")}
    ).drop("_descending")


def roc_points(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Exact curve: one point per distinct score, counting score >= th."""
    points = _cumulative_scores(df, truth, score)
    both = points.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))).scalar()
    return points.select(
        "score",
        "tp",
        "fp",
        F.try_divide(F.col("tp"), both["pos"]).alias("tpr"),
        F.try_divide(F.col("fp"), both["neg"]).alias("fpr"),
    )


def area_under_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Exact area under the curve, ties counted half; NULL when a class is missing."""
    points = _cumulative_scores(df, truth, score)
    above = (F.col("tp") - F.col("pos")).cast("double") + F.col("pos") / F.lit(2.0)
    return points.agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.sum(F.col("neg") * above).alias("_won"),
    ).select(
        "positives",
        "negatives",
        F.try_divide(F.col("_won"), F.col("positives").cast("double") * F.col("negatives")).alias("auc"),
    )


def set_confusion(df: DataFrame, predicted: str, actual: str, by: list[str] | None = None) -> DataFrame:
    """Totals of correct, wrong and missed labels between two label sets per row."""
    size = lambda c: F.sum(F.size(c)).cast("bigint")
    return df.groupBy(*(by or [])).agg(
        size(F.array_intersect(predicted, actual)).alias("true_positive"),
        size(F.array_except(predicted, actual)).alias("false_positive"),
        size(F.array_except(actual, predicted)).alias("false_negative"),
    )


def r_squared(df: DataFrame, truth: str, predicted: str, by: list[str]) -> DataFrame:
    """1 - SSE/SST per group; NULL where the truth does not vary."""
    error = F.pow(F.col(truth) - F.col(predicted), F.lit(2.0))
    return (
        df.groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            F.sum(error).alias("_sse"),
            (F.var_pop(truth) * F.count(truth)).alias("_sst"),
        )
        .select(*by, "n", (1 - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"))
    )
