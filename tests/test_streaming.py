"""Keyed state over arriving files: increments, resets, retries, upserts, alerts."""

import numpy as np
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.sources.storage import scratch_path
from millrace.streaming import alerts, counters, profiles
from millrace.streaming.queries import PROVIDER

HIT_SCHEMA = "id bigint, tag string, gone boolean"


def arrive(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(folder)
    return spark.readStream.schema(schema).json(folder)


def test_counter_goes_on_across_batches_and_resets(spark):
    folder = scratch_path(spark, "counter")
    counter = counters.TagCounter(spark, folder, "tag", ["id"], "id")
    batches = [
        [(1, "a", False), (2, "a", False), (3, "b", False)],
        [(4, "a", False), (5, "b", True), (6, "b", False)],
        [(7, "b", False), (8, "a", False), (9, "c", False), (10, "a", True), (11, "a", False)],
        [(12, "a", False)],
    ]
    for rows in batches:
        counter.run(arrive(spark, f"{folder}/in", rows, HIT_SCHEMA), F.col("gone"))
    got = {r["id"]: r["value"] for r in counter.counted("bigint").collect()}
    assert got == {1: 1, 2: 2, 3: 1, 4: 3, 5: 0, 6: 1, 7: 2, 8: 4, 9: 1, 10: 0, 11: 1, 12: 2}


def test_a_failed_batch_counts_once(spark):
    folder = scratch_path(spark, "retry")
    counter = counters.TagCounter(spark, folder, "tag", ["id"], "id")
    counter.run(arrive(spark, f"{folder}/in", [(1, "a", False), (2, None, False)], HIT_SCHEMA), F.col("gone"))
    stream = arrive(spark, f"{folder}/in", [(n, "a", False) for n in range(3, 50)] + [(50, None, False)], HIT_SCHEMA)
    breaking = F.when(F.col("id") == 49, F.raise_error(F.lit("lost")).cast("boolean")).otherwise(F.col("gone"))
    with pytest.raises(StreamingQueryException, match="lost"):
        counter.run(stream, breaking)
    again = counters.TagCounter(spark, folder, "tag", ["id"], "id")
    again.run(stream, F.col("gone"))
    got = {r["id"]: r["value"] for r in again.counted("bigint").collect()}
    assert got == {1: 1, 2: 1, 50: 2, **{n: n - 1 for n in range(3, 50)}}
    assert sorted(map(tuple, again.counts().collect()), key=str) == [("a", 48), (None, 2)]


def test_a_batch_touches_the_state_of_its_own_tags(spark):
    folder = scratch_path(spark, "touched")
    counter = counters.TagCounter(spark, folder, "tag", ["id"], "id")
    rows = [(n, f"t{n}", False) for n in range(500)]
    counter.run(arrive(spark, f"{folder}/in", rows, HIT_SCHEMA), F.col("gone"))
    second = counter.run(arrive(spark, f"{folder}/in", [(500, "t7", False)], HIT_SCHEMA), F.col("gone"))
    operator = [p["stateOperators"][0] for p in second.recentProgress if p["numInputRows"]][-1]
    assert operator["numRowsUpdated"] == 1 and operator["customMetrics"]["rocksdbGetCount"] < 10
    assert counter.counts().where("value = 2").first()["tag"] == "t7" and counter.counts().count() == 500


def test_served_after():
    resets = np.array([False, False, True, False, True, True, False, False])
    assert counters.served_after(resets, 5).tolist() == [6, 7, 0, 1, 0, 0, 1, 2]
    assert counters.served_after(resets[:2], 0).tolist() == [1, 2]


def test_the_session_keeps_its_own_state_store(spark):
    before = spark.conf.get(PROVIDER, None)
    folder = scratch_path(spark, "own")
    counters.TagCounter(spark, folder, "tag", ["id"], "id").run(arrive(spark, f"{folder}/in", [(1, "a", False)], HIT_SCHEMA), F.col("gone"))
    assert spark.conf.get(PROVIDER, None) == before


def test_profiles_upsert_and_refuse(spark):
    folder = scratch_path(spark, "profiles")
    store = profiles.ProfileStore(spark, folder)
    schema = "username string, key string, value string, at string"
    batches = [
        [("bob", "cool_key", "1", "01"), ("hacker", "k", "v", "02")],
        [("bob", "gr8_key", "2", "03"), ("bob", "cool_key", "9", "05"), ("bob", "cool_key", "5", "04")],
    ]
    for rows in batches:
        store.run(arrive(spark, f"{folder}/in", rows, schema))
    got = sorted(map(tuple, store.profiles().collect()))
    assert got == [("bob", "cool_key", "9"), ("bob", "gr8_key", "2")]
    # after a restart, with nothing new
    assert sorted(map(tuple, profiles.ProfileStore(spark, store.checkpoint.rsplit("/", 1)[0]).profiles().collect())) == got
    maps = profiles.profile_maps(store.profiles(), "username", "key", "value").collect()
    assert [r["data"] for r in maps] == [{"cool_key": "9", "gr8_key": "2"}]


def test_alerts_reach_their_recipients(spark):
    recipients = spark.createDataFrame([("error", "#status"), ("done", "all")], "condition string, recipient string")
    status = spark.createDataFrame([("a", True, True), ("b", False, True), ("c", False, False)], "node string, bad boolean, done boolean")
    got = alerts.alert_rows(status, recipients, F.col("bad"), F.col("done")).select("node", "condition", "recipient")
    assert sorted(map(tuple, got.collect())) == [("a", "error", "#status"), ("b", "done", "all")]
    scores = spark.createDataFrame([(0.9,), (0.85,), (None,)], "score double")
    assert alerts.threshold_alerts(scores, "score", 0.85, "oncall").count() == 1


def test_late_and_unnamed_updates(spark):
    folder = scratch_path(spark, "late")
    store = profiles.ProfileStore(spark, folder)
    batches = [
        [("bob", "k", "new", "05"), ("bob", None, "x", None), ("amy", "k", None, "01")],
        [("bob", "k", "old", "04"), ("bob", None, "y", "00"), ("amy", "k", "v", "01")],
    ]
    for rows in batches:
        store.run(arrive(spark, f"{folder}/in", rows, profiles.ProfileStore.SCHEMA))
    assert sorted(map(tuple, store.profiles().collect()), key=str) == [("amy", "k", "v"), ("bob", "k", "new"), ("bob", None, "y")]


def test_streaming_totals_survive_a_restart(spark):
    folder = scratch_path(spark, "totals")
    for rows in ([(1, "a", False), (2, "a", False), (3, "b", False)], [(4, "b", False), (5, "c", False)]):
        counters.TagTotals(spark, folder, "tag").run(arrive(spark, f"{folder}/in", rows, HIT_SCHEMA))
    got = counters.TagTotals(spark, folder, "tag").totals()
    assert sorted(map(tuple, got.collect())) == [("a", 2), ("b", 2), ("c", 1)]
