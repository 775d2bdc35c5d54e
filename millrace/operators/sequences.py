"""Ordered operators that hold up when one key owns a third of the rows.

A plain `Window.partitionBy(key).orderBy(...)` sends a key to one task, and a
window without keys sends everything to one task.  The operators here lay rows
out by range over a *total* order instead, so a hot key spans many slices:

1. range-partition and sort on (keys, order): the only shuffle of the rows;
2. the task that sorted a slice walks through it in order and adds the running
   values or neighbours inside the slice, batch by batch;
3. the slices are written once (range bounds come from sampling, so slice
   numbers are only stable once written) and corrected with what earlier slices
   carry over.  Keys are contiguous, so at most one key per slice has a carry:
   that table has one row per slice and is broadcast.

The order columns must make rows unique, otherwise equal rows share a slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.sources.storage import materialize

SLICE = "__slice"
POSITION = "__position"
_POSITION_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def slice_layout(df: DataFrame, order: Sequence[str], slices: int | None = None) -> DataFrame:
    """`df` written in range slices, with slice number and position in the slice.

    Without `slices` there are as many as the session's shuffle partitions, and
    adaptive execution joins small neighbouring ones, so little data makes few
    slices.
    """
    ranged = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    laid = ranged.sortWithinPartitions(*order).withColumn("__seq", F.monotonically_increasing_id())
    pinned = materialize(laid, "slices")
    return pinned.withColumns(
        {
            SLICE: F.shiftright("__seq", _POSITION_BITS),
            POSITION: F.col("__seq").bitwiseAND((1 << _POSITION_BITS) - 1),
        }
    ).drop("__seq")


def number_rows(
    df: DataFrame, order: Sequence[str], name: str = "ordinal", slices: int | None = None
) -> tuple[DataFrame, int]:
    """Rows with their global zero-based number over a total order, and how many there are."""
    laid = slice_layout(df, order, slices)
    sizes = {r[SLICE]: r["count"] for r in laid.groupBy(SLICE).count().collect()}
    before = dict(zip(sorted(sizes), accumulate((sizes[s] for s in sorted(sizes)), initial=0)))
    offsets = df.sparkSession.createDataFrame(list(before.items()), f"{SLICE} bigint, __offset bigint")
    numbered = (
        laid.join(F.broadcast(offsets), SLICE)
        .withColumn(name, F.col("__offset") + F.col(POSITION))
        .drop(SLICE, POSITION, "__offset")
    )
    return numbered, sum(sizes.values())


def with_ordinal(
    df: DataFrame, order: Sequence[str], name: str = "ordinal", slices: int | None = None
) -> DataFrame:
    """Global zero-based row number over a total order, without a global window."""
    return number_rows(df, order, name, slices)[0]


FIRST_KEY = "__first_key"  # whether the row has the key that its slice begins with


def _breaks(columns: Sequence[pa.Array], rows: int) -> np.ndarray:
    """Where a row's key differs from the row above it; missing equals missing, NaN equals NaN."""
    new = np.zeros(rows, bool)
    new[:1] = True
    for column in columns:
        if pa.types.is_floating(column.type):
            column = pc.if_else(pc.is_nan(column), pa.scalar(float("nan"), column.type), column)
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return new


def _walk(df: DataFrame, keys: Sequence[str], step: Callable, added: Sequence[T.StructField], order: Sequence[str], slices: int | None) -> DataFrame:
    """Sorted slices with the columns that `step` adds inside each, written once.

    `step(batch, new, state)` gets a batch, where its keys change (the first row
    against the batch before) and a dict that lives as long as the slice; it
    yields batches of the added columns, each with its rows.
    """
    places = [df.columns.index(k) for k in keys]
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        state: dict = {}
        above: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            key_columns = [batch.column(i) for i in places]
            if above is not None:
                key_columns = [pa.concat_arrays([above.column(i), c]) for i, c in zip(places, key_columns)]
                new = _breaks(key_columns, batch.num_rows + 1)[1:]
            else:
                new = _breaks(key_columns, batch.num_rows)
            above = batch.slice(batch.num_rows - 1)
            yield from (_with_slice(part, values, number) for part, values in step(batch, new, state))
        for part, values in step(None, None, state):
            yield _with_slice(part, values, number)

    def _with_slice(part: pa.RecordBatch, values: Sequence[pa.Array], number: int) -> pa.RecordBatch:
        arrays = [*part.columns, *values, pa.array(np.full(part.num_rows, number, np.int64))]
        return pa.RecordBatch.from_arrays(arrays, [*names, *[f.name for f in added], SLICE])

    sort = [*keys, *[c for c in order if c not in keys]]
    ranged = df.repartitionByRange(slices, *sort) if slices else df.repartitionByRange(*sort)
    schema = T.StructType([*df.schema.fields, *added, T.StructField(SLICE, T.LongType())])
    return materialize(ranged.sortWithinPartitions(*sort).mapInArrow(run, schema), "slices")


def _running(values: pa.Array, starts: np.ndarray, group: np.ndarray, carried):
    """Inclusive sums per group; `carried` is added to the first group."""
    if pa.types.is_floating(values.type):
        sums = pd.Series(values.to_numpy(zero_copy_only=False)).groupby(group).cumsum().to_numpy()
    elif pa.types.is_integer(values.type):
        total = np.cumsum(values.to_numpy(zero_copy_only=False))
        sums = total - np.concatenate([[0], total])[starts[group]]
    else:
        total = np.cumsum(np.array(values.to_pylist(), object))
        sums = total - np.concatenate([[total[0] * 0], total])[starts[group]]
    if carried is not None:
        first = group == 0
        sums[first] = sums[first] + carried
    return sums


def _sum_type(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(38, kind.scale)
    return T.DoubleType() if isinstance(kind, (T.DoubleType, T.FloatType)) else T.LongType()


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _same_key(a, b) -> bool:
    """Keys that the driver holds, one per slice, compared as Spark groups them."""
    return all(x == y or (x != x and y != y) for x, y in zip(a, b))


def running_sums(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    slices: int | None = None,
) -> DataFrame:
    """Inclusive running sums per key `by`, in `order`; NULL terms count as zero.

    Integers add up as bigint, decimals keep their scale.
    """
    terms = {f"__term{i}": c for i, c in enumerate(sums.values())}
    typed = df.withColumns(terms)
    kinds = [_sum_type(typed.schema[t].dataType) for t in terms]
    typed = typed.withColumns({t: F.coalesce(F.col(t).cast(k), F.lit(0).cast(k)) for t, k in zip(terms, kinds)})
    places = [typed.columns.index(t) for t in terms]
    local = [f"__local{i}" for i in range(len(terms))]
    added = [T.StructField(n, k) for n, k in zip(local, kinds)] + [T.StructField(FIRST_KEY, T.BooleanType()), T.StructField(POSITION, T.LongType())]

    def step(batch, new, state):
        if batch is None:
            return
        same = bool(state) and not new[0]
        starts = np.flatnonzero(new) if not same else np.concatenate([[0], np.flatnonzero(new)])
        group = np.cumsum(new) - (0 if same else 1)
        before = state.get("sums", [None] * len(places)) if same else [None] * len(places)
        found = [_running(batch.column(p), starts, group, c) for p, c in zip(places, before)]
        first = state.get("first", True) if same else not state
        in_first = (group == 0) & first
        at = state.get("rows", 0)
        state.update(sums=[f[-1] for f in found], first=bool(in_first[-1]), rows=at + batch.num_rows)
        arrays = [pa.array(f, batch.column(p).type) for f, p in zip(found, places)]
        yield batch, [*arrays, pa.array(in_first), pa.array(np.arange(at, at + batch.num_rows))]

    laid = _walk(typed, by, step, added, order, slices)
    # per slice its first and last key, and what the last key adds up to there: one row each
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(by)], F.lit(0).alias("none"))
    edges = laid.groupBy(SLICE).agg(
        F.min_by(key, POSITION).alias("first"),
        F.max_by(key, POSITION).alias("last"),
        F.max_by(F.struct(*local), POSITION).alias("sums"),
        F.max_by(FIRST_KEY, POSITION).alias("whole"),
    )
    carries, held, held_key = [], None, None
    for r in sorted(edges.collect(), key=lambda r: r[SLICE]):
        goes_on = held_key is not None and _same_key(r["first"], held_key)
        if goes_on:
            carries.append((r[SLICE], *held))
        held = [a + b for a, b in zip(held, r["sums"])] if goes_on and r["whole"] else list(r["sums"])
        held_key = r["last"]
    names = [f"__carry{i}" for i in range(len(terms))]
    schema = T.StructType([T.StructField(SLICE, T.LongType())] + [T.StructField(n, k) for n, k in zip(names, kinds)])
    carried = F.broadcast(df.sparkSession.createDataFrame(carries, schema))
    total = {
        n: F.when(F.col(FIRST_KEY) & F.col(c).isNotNull(), (F.col(x) + F.col(c)).cast(k)).otherwise(F.col(x))
        for n, x, c, k in zip(sums, local, names, kinds)
    }
    extra = [c for c in (SLICE, POSITION, FIRST_KEY, *terms, *local, *names) if c not in sums]
    return laid.join(carried, SLICE, "left").withColumns(total).drop(*extra)


def with_neighbour(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    columns: Mapping[str, str],
    step: int = -1,
    slices: int | None = None,
) -> DataFrame:
    """Value of the previous (step -1) or next (step 1) row of the same key.

    `columns` maps new column names to source columns.  The row beyond a slice's
    edge comes from a table with one row per slice.
    """
    if step not in (-1, 1):
        raise ValueError("step is -1 or 1")
    places = [df.columns.index(c) for c in columns.values()]
    found = [f"__near{i}" for i in range(len(columns))]
    flags = ["__edge", POSITION]
    added = [T.StructField(n, df.schema[c].dataType) for n, c in zip(found, columns.values())]
    added += [T.StructField("__edge", T.BooleanType()), T.StructField(POSITION, T.LongType())]

    def positions(state, rows):
        at = state.get("rows", 0)
        state["rows"] = at + rows
        return pa.array(np.arange(at, at + rows))

    def previous(batch, new, state):
        if batch is None:
            return
        rows = batch.num_rows
        edge = np.zeros(rows, bool)
        edge[0] = "last" not in state
        taken = pa.array(np.arange(rows) - 1, mask=np.concatenate([[True], new[1:]]))
        values = []
        for i, p in enumerate(places):
            shifted = batch.column(p).take(taken)
            if "last" in state and not new[0]:
                shifted = pa.concat_arrays([state["last"][i], shifted.slice(1)])
            values.append(shifted)
        state["last"] = [batch.column(p).slice(rows - 1) for p in places]
        yield batch, [*values, pa.array(edge), positions(state, rows)]

    def following(batch, new, state):
        # the last row of a batch waits for the next one
        held = state.pop("held", None)
        if batch is None:
            if held is not None:
                empty = [pa.nulls(1, held.column(p).type) for p in places]
                yield held, [*empty, pa.array([True]), positions(state, 1)]
            return
        if held is not None:
            values = [batch.column(p).slice(0, 1) if not new[0] else pa.nulls(1, held.column(p).type) for p in places]
            yield held, [*values, pa.array([False]), positions(state, 1)]
        rows = batch.num_rows - 1
        state["held"] = batch.slice(rows)
        if rows:
            taken = pa.array(np.arange(1, rows + 1), mask=new[1:])
            yield batch.slice(0, rows), [*[batch.column(p).take(taken) for p in places], pa.array(np.zeros(rows, bool)), positions(state, rows)]

    laid = _walk(df, by, previous if step == -1 else following, added, order, slices)
    packed = F.struct(
        *[F.col(k).alias(f"k{i}") for i, k in enumerate(by)],
        *[F.col(c).alias(f"v{i}") for i, c in enumerate(columns.values())],
    )
    outer = F.max_by if step == -1 else F.min_by
    edges = laid.groupBy(SLICE).agg(outer(packed, F.col(POSITION)).alias("__beyond"))
    numbers = sorted(r[0] for r in edges.select(SLICE).collect())
    pairs = list(zip(numbers[1:], numbers)) if step == -1 else list(zip(numbers, numbers[1:]))
    hops = df.sparkSession.createDataFrame(pairs, f"{SLICE} bigint, __from bigint")
    beyond = edges.withColumnRenamed(SLICE, "__from").join(F.broadcast(hops), "__from").drop("__from")
    joined = laid.join(F.broadcast(beyond), SLICE, "left")
    same = F.col("__edge") & F.col("__beyond").isNotNull()
    for i, k in enumerate(by):
        same = same & _same(F.col(k), F.col("__beyond")[f"k{i}"])
    total = {n: F.when(same, F.col("__beyond")[f"v{i}"]).otherwise(F.col(f)) for i, (n, f) in enumerate(zip(columns, found))}
    return joined.withColumns(total).drop(*[c for c in (SLICE, "__beyond", *flags, *found) if c not in columns])
