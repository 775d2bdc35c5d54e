"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Rows without an id get a stand-in from their text, above every real id below 2^62.
_STAND_IN = 1 << 62


def stand_in_id(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The row's id; a row without one is named by its text, after all numbered rows."""
    hashed = F.xxhash64(F.lit("id"), F.col(text_col)).bitwiseAND(_STAND_IN - 1)
    return F.coalesce(F.col(id_col).cast("long"), hashed.bitwiseOR(_STAND_IN))


def texts_of(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Texts of an Arrow column, a missing one as the empty text."""
    return [t or "" for t in column.to_pylist()]


# Rows of an Arrow batch; texts are long, and both sides hold whole batches.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
_DEFAULT_ROWS = "10000"


def sized(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, smaller ones put together, without empty ones."""
    waiting: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            if count + part.num_rows > rows:
                yield pa.concat_batches(waiting)
                waiting, count = [], 0
            waiting.append(part)
            count += part.num_rows
    if waiting:
        yield pa.concat_batches(waiting)


def weighed(batches: Iterator[pa.RecordBatch], column: str, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows` rows and `size` bytes of `column`, or of one longer row."""
    for batch in sized(batches, rows):
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(at, end - at)
            at = end


def smaller_batches(spark: SparkSession) -> None:
    """Set the size of Arrow batches for texts, unless the session has chosen one."""
    if spark.conf.get(_BATCH_CONF, _DEFAULT_ROWS) == _DEFAULT_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, rows: int = BATCH_ROWS
) -> DataFrame:
    """`work` on Arrow batches of at most `rows` rows; a task holds no more than that."""
    smaller_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized(batches, rows):
            yield work(batch)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Return freed memory to the system at the end of a task; idle workers wait for the next one."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def release_shuffles(spark: SparkSession) -> None:
    """Let the driver notice which shuffle files nothing needs any more.

    Their cleaning follows the driver's garbage collection, which a job of few
    large steps may not reach for half an hour.
    """
    for _ in range(2):  # the first round lets go of what Python held, the second collects it
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)
