"""Alert rows routed to recipients; a table sink stands in for messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.streaming.queries import run_to_files


def alert_rows(status: DataFrame, recipients: DataFrame, failed: Column, finished: Column) -> DataFrame:
    """One row per raised condition and recipient subscribed to it.

    `recipients` has columns condition ('error' or 'done') and recipient.  A
    node that fails raises an error even when all its work is done.
    """
    condition = F.when(failed, "error").when(finished, "done")
    raised = status.withColumn("condition", condition).where(F.col("condition").isNotNull())
    return raised.join(recipients, "condition")


def threshold_alerts(scores: DataFrame, score: str, limit: float, recipient: str) -> DataFrame:
    """Rows whose score exceeds the limit, addressed to a recipient."""
    return scores.where(F.col(score) > limit).withColumn("recipient", F.lit(recipient))


class AlertStream:
    """Streaming alerts: each arriving row is routed to its recipients, the raised rows are appended to files."""

    def __init__(self, spark: SparkSession, folder: str, recipients: DataFrame):
        self.spark, self.recipients = spark, recipients
        self.out, self.checkpoint = f"{folder}/alerts", f"{folder}/progress"

    def run(self, stream: DataFrame, failed: Column, finished: Column) -> None:
        run_to_files(alert_rows(stream, self.recipients, failed, finished), self.out, self.checkpoint)

    def alerts(self, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.out)
