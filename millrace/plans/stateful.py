"""Counters, profiles and alerts, in batch and as streams over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.plans.registry import bound
from millrace.plans.summaries import STATUS_SQL, event_status
from millrace.sources.storage import scratch_path
from millrace.sources.tables import table
from millrace.streaming import alerts, counters, profiles

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
ARRIVALS = 3  # the events table arrives in this many portions, in time order


def _portions(spark: SparkSession, root: str) -> list[DataFrame]:
    """The events table cut by time into portions that arrive one after the other."""
    events = table(spark, root, "events")
    start, end = events.agg(F.min("ts"), F.max("ts")).first()
    cuts = [start + (end - start) * i / ARRIVALS for i in range(1, ARRIVALS)]
    edges = [None, *cuts, None]
    portions = []
    for low, high in zip(edges, edges[1:]):
        part = events
        if low is not None:
            part = part.where(F.col("ts") >= F.lit(low).cast("timestamp_ntz"))
        if high is not None:
            part = part.where(F.col("ts") < F.lit(high).cast("timestamp_ntz"))
        portions.append(part)
    return portions


def _arriving(spark: SparkSession, root: str, folder: str, handle) -> None:
    """Append each portion to the watched folder and let the stream catch up."""
    watched = f"{folder}/in"
    for portion in _portions(spark, root):
        portion.write.mode("append").parquet(watched)
        handle(spark.readStream.schema(EVENT_SCHEMA).parquet(watched))


@bound(
    "profile_upsert",
    """
    SELECT username, event_type AS key, value FROM (
      SELECT *, row_number() OVER (PARTITION BY username, event_type ORDER BY ts DESC, event_id DESC) AS r FROM (
        SELECT CASE WHEN user_id = 0 THEN 'hacker' ELSE 'user' || user_id::VARCHAR END AS username, * FROM events))
    WHERE r = 1 AND username <> 'hacker'
    """,
)
def profile_upsert(spark: SparkSession, root: str) -> DataFrame:
    username = F.when(F.col("user_id") == 0, "hacker").otherwise(F.concat(F.lit("user"), "user_id"))
    updates = table(spark, root, "events").select(
        username.alias("username"), F.col("event_type").alias("key"), "value", "ts", "event_id"
    )
    return profiles.latest_profiles(updates, "username", "key", "value", ["ts", "event_id"])


@bound(
    "alert_rows",
    f"""
    WITH {STATUS_SQL},
    recipients AS (SELECT * FROM (VALUES ('error', '#status'), ('error', 'oncall'), ('done', '#status')) t(condition, recipient))
    SELECT node, leaves, errors, s.condition, recipient FROM (
      SELECT *, CASE WHEN failed THEN 'error' WHEN done THEN 'done' END AS condition FROM status) s
    JOIN recipients r ON s.condition = r.condition
    """,
)
def alert_rows(spark: SparkSession, root: str) -> DataFrame:
    recipients = spark.createDataFrame(
        [("error", "#status"), ("error", "oncall"), ("done", "#status")], "condition string, recipient string"
    )
    raised = alerts.alert_rows(event_status(spark, root), recipients, F.col("failed"), F.col("done"))
    return raised.select("node", "leaves", "errors", "condition", "recipient")


@bound(
    "stream_counter",
    """
    WITH spans AS (
      SELECT event_id, user_id, ts, event_type,
             count(*) FILTER (WHERE event_type = 'signup') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS resets
      FROM events)
    SELECT event_id, user_id::VARCHAR AS tag,
           count(*) FILTER (WHERE event_type <> 'signup') OVER (PARTITION BY user_id, resets ORDER BY ts, event_id) AS value
    FROM spans
    """,
)
def stream_counter(spark: SparkSession, root: str) -> DataFrame:
    """Count after each event per user across micro-batches; a signup resets the user's counter."""
    folder = scratch_path(spark, "counter")
    counter = counters.TagCounter(spark, folder, "user_id", ["ts", "event_id"], "event_id")
    _arriving(spark, root, folder, lambda stream: counter.run(stream, F.col("event_type") == "signup"))
    return counter.counted("bigint")


@bound("stream_totals", "SELECT event_type, count(*) AS served FROM events GROUP BY event_type")
def stream_totals(spark: SparkSession, root: str) -> DataFrame:
    """Running totals per tag by a streaming aggregate, read from its state."""
    folder = scratch_path(spark, "totals")
    totals = counters.TagTotals(spark, folder, "event_type")
    _arriving(spark, root, folder, totals.run)
    return totals.totals()


@bound(
    "stream_profiles",
    """
    SELECT user_id::VARCHAR AS username, event_type AS key, props AS value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events)
    WHERE r = 1
    """,
)
def stream_profiles(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_path(spark, "profiles")
    store = profiles.ProfileStore(spark, folder)
    at = F.concat(F.date_format("ts", "yyyyMMddHHmmssSSSSSS"), F.lpad(F.col("event_id").cast("string"), 20, "0"))

    def run(stream: DataFrame) -> None:
        store.run(
            stream.select(
                F.col("user_id").cast("string").alias("username"),
                F.col("event_type").alias("key"),
                F.col("props").alias("value"),
                at.alias("at"),
            )
        )

    _arriving(spark, root, folder, run)
    return store.profiles()


@bound(
    "stream_alerts",
    """
    SELECT event_id, user_id, '#status' AS recipient, 'error' AS condition FROM events WHERE event_type = 'error'
    UNION ALL SELECT event_id, user_id, 'sales', 'done' FROM events WHERE event_type = 'purchase'
    """,
)
def stream_alerts(spark: SparkSession, root: str) -> DataFrame:
    folder = scratch_path(spark, "alerts")
    recipients = spark.createDataFrame([("error", "#status"), ("done", "sales")], "condition string, recipient string")
    stream = alerts.AlertStream(spark, folder, recipients)
    kind = F.col("event_type")
    _arriving(spark, root, folder, lambda rows: stream.run(rows, kind == "error", kind == "purchase"))
    raised = stream.alerts("event_id bigint, user_id bigint, recipient string, condition string")
    return raised.select("event_id", "user_id", "recipient", "condition")
