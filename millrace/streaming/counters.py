"""Counter per tag: each hit gets the count after it, a reset starts the tag over."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from millrace.operators.sequences import running_sums
from millrace.streaming.queries import run_available, run_to_files, state_rows, state_variables


def counts_with_resets(events: DataFrame, tag: str, order: Sequence[str], reset: Column) -> DataFrame:
    """The tag's counter after each event (`served`), and how many resets came before or with it (`resets`).

    A reset itself shows 0.  A tag with a third of all events is split by
    `running_sums`, first over resets, then over hits between resets.
    """
    marked = events.withColumn("_reset", F.coalesce(reset, F.lit(False)))
    spans = running_sums(marked, [tag], order, {"resets": F.col("_reset").cast("int")})
    hit = F.when(F.col("_reset"), 0).otherwise(F.lit(1).cast("bigint"))
    return running_sums(spans, [tag, "resets"], order, {"served": hit}).drop("_reset")


def served_after(resets: np.ndarray, start: int) -> np.ndarray:
    """The counter after each event in order, from `start` on; a reset sets it to 0."""
    hits = np.cumsum(~resets)
    forgotten = np.maximum.accumulate(np.where(resets, hits, -start))
    return hits - np.where(np.cumsum(resets) > 0, forgotten, -start)


class _Counting(StatefulProcessor):
    """One number per tag; rows are hit, reset and the order columns at0, at1, ..."""

    def __init__(self, orders: int):
        self.order = [f"at{k}" for k in range(orders)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "value bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        hits = pd.concat(list(rows)).sort_values(self.order, kind="stable", na_position="first")
        start = self.count.get()[0] if self.count.exists() else 0
        served = served_after(hits["reset"].to_numpy(bool), start)
        self.count.update((int(served[-1]),))
        yield pd.DataFrame({"hit": hits["hit"], "tag": key[0], "value": served})

    def close(self) -> None:
        pass


class TagCounter:
    """Streaming counter with the count after every hit; state per tag is one value in Spark's state store.

    A micro-batch reads and writes the values of its own tags.  Counting a tag is
    sequential, so its hits of one micro-batch, as (key, order, reset), are one task's;
    the source's admission limits (such as maxBytesPerTrigger) bound them.  Many
    hits per tag at rest are `counts_with_resets`, which splits tags.  Hits
    are ordered within a micro-batch, late ones count when they arrive.
    """

    def __init__(self, spark: SparkSession, folder: str, tag: str, order: Sequence[str], key: str):
        self.spark, self.tag, self.order, self.key = spark, tag, list(order), key
        self.out, self.checkpoint = f"{folder}/out", f"{folder}/progress"

    def run(self, stream: DataFrame, reset: Column) -> StreamingQuery:
        marked = stream.select(
            F.col(self.key).alias("hit"),
            F.col(self.tag).cast("string").alias("tag"),
            F.coalesce(reset, F.lit(False)).alias("reset"),
            *[F.col(c).alias(f"at{k}") for k, c in enumerate(self.order)],
        )
        key_type = stream.schema[self.key].dataType.simpleString()
        with state_variables(self.spark):
            counted = marked.groupBy("tag").transformWithStateInPandas(
                statefulProcessor=_Counting(len(self.order)),
                outputStructType=f"hit {key_type}, tag string, value bigint",
                outputMode="Append",
                timeMode="None",
            )
            return run_to_files(counted.withColumnRenamed("hit", self.key), self.out, self.checkpoint)

    def counted(self, key_type: str) -> DataFrame:
        return self.spark.read.schema(f"{self.key} {key_type}, tag string, value bigint").parquet(self.out)

    def counts(self) -> DataFrame:
        """The counter of every tag now: tag, value."""
        return state_rows(self.spark, self.checkpoint, "count").select("key.tag", "value.value")


def tag_totals(stream: DataFrame, tag: str) -> DataFrame:
    """Running total per tag as a streaming aggregate; partial counts combine before the shuffle."""
    return stream.groupBy(tag).agg(F.count("*").alias("served"))


class TagTotals:
    """Running totals per tag, kept by a streaming aggregate and read from its state."""

    def __init__(self, spark: SparkSession, folder: str, tag: str):
        self.spark, self.tag, self.checkpoint = spark, tag, f"{folder}/progress"

    def run(self, stream: DataFrame) -> None:
        # nothing is written but the state, which is what a reader asks for
        run_available(tag_totals(stream, self.tag).writeStream.outputMode("update").format("noop"), self.checkpoint)

    def totals(self) -> DataFrame:
        return state_rows(self.spark, self.checkpoint).select(f"key.{self.tag}", F.col("value.count").alias("served"))
