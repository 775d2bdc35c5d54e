"""Streaming queries with keyed state in Spark's own state store."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: the store that state variables of a processor need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_variables(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep state variables; the session's own choice returns afterwards."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process what has arrived, then stop; `checkpoint` remembers how far it came and holds the state."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_to_files(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Append what a stream gives to Parquet files; the sink's log counts each micro-batch once."""
    return run_available(rows.writeStream.format("parquet").option("path", folder), checkpoint)


def state_rows(spark: SparkSession, checkpoint: str, variable: str | None = None) -> DataFrame:
    """The state after the last finished micro-batch, read where it is kept."""
    reader = spark.read.format("statestore")
    return (reader.option("stateVarName", variable) if variable else reader).load(checkpoint)
