"""Mergeable moments of vectors, and the linear models that follow from them.

Sums of products are built per task with numpy over Arrow batches and then added
up block by block; rows never leave their partition.  What reaches the driver
is one number per pair of features, whatever the number of rows and labels.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.operators.sequences import running_sums
from millrace.sources.storage import materialize

# The ridge strengths fitted side by side.
RIDGES = (0.0, 1.0, 10.0, 100.0, 500.0)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    widths = np.unique(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    if len(widths) > 1:
        raise ValueError(f"vectors of {widths[0]} and of {widths[-1]} numbers")
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


BAND = 64  # rows of X'X in one array
_BLOCKS = "kind string, i int, width int, numbers array<double>"


def _block_batch(kind: str, i: Sequence[int], width: int, numbers: Sequence[np.ndarray]) -> pa.RecordBatch:
    flat = np.concatenate([np.ravel(part) for part in numbers])
    offsets = np.concatenate([[0], np.cumsum([np.size(part) for part in numbers])]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind] * len(numbers), pa.string()),
            pa.array(np.asarray(i, np.int32)),
            pa.array(np.full(len(numbers), width, np.int32)),
            pa.ListArray.from_arrays(offsets, pa.array(flat)),
        ],
        names=["kind", "i", "width", "numbers"],
    )


def _added(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Arrays of a key added number by number; arrays of different lengths raise an error."""
    sums = parts.groupBy(*by).agg(Summarizer.sum(array_to_vector("numbers")).alias("_sum"))
    return sums.select(*by, vector_to_array("_sum").alias("numbers"))


def _per_task(
    df: DataFrame, vector: str, fold: Callable, schema: str, others: Sequence[str] = (), tasks: int | None = None
) -> DataFrame:
    """What `fold` gives for each of at most `tasks` tasks, with the `part` of the first level it is added in."""
    # a vector with a missing element is missing
    whole = F.col(vector).isNotNull() & ~F.exists(vector, lambda v: v.isNull())
    width = tasks or df.sparkSession.sparkContext.defaultParallelism
    partials = df.where(whole).select(vector, *others).coalesce(width).mapInArrow(fold, schema)
    return partials.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(max(1, math.isqrt(width)))))


def moments(df: DataFrame, vector: str, labels: str | None = None, tasks: int | None = None) -> DataFrame:
    """Sums over rows as a block matrix: kind, i, width (of a vector), numbers.

    'n' holds the count, 'x' the sum of the vectors, 'xx' band i of X'X (BAND of its
    rows, one after the other), 'xy' for label i its count and then the sum of its
    vectors.  Labels are arrays of distinct label numbers, so only labels that
    occur take room.  Splits are folded into at most `tasks` (default: the
    cluster's cores), since each task emits a whole matrix; the arrays are added
    in two levels, so a band is not one task's while there are many tasks.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xx = x = None
        n = 0
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = _matrix(batch.column(0))
            if xx is not None and rows.shape[1] != len(x):
                raise ValueError(f"vectors of {len(x)} and of {rows.shape[1]} numbers")
            if xx is None:
                xx, x = np.zeros((rows.shape[1],) * 2), np.zeros(rows.shape[1])
            xx += rows.T @ rows
            x += rows.sum(axis=0)
            n += len(rows)
            if labels is not None:
                lists = batch.column(1)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                sizes = np.diff(lists.offsets.to_numpy())
                owner = np.repeat(np.arange(len(rows)), sizes)
                order = np.argsort(flat, kind="stable")
                found, first = np.unique(flat[order], return_index=True)
                if len(found):
                    parts = np.add.reduceat(rows[owner[order]], first, axis=0)
                    sizes = np.diff(np.append(first, len(flat)))
                    for label, part in zip(found.tolist(), np.column_stack([sizes, parts])):
                        sums[label] = sums[label] + part if label in sums else part
        if xx is None:
            return
        yield _block_batch("n", [0], len(x), [np.array([float(n)])])
        yield _block_batch("x", [0], len(x), [x])
        bands = range(0, len(x), BAND)
        yield _block_batch("xx", range(len(bands)), len(x), [xx[at : at + BAND] for at in bands])
        for at in range(0, len(sums), 1000):
            some = sorted(sums)[at : at + 1000]
            yield _block_batch("xy", some, len(x), [sums[label] for label in some])

    partials = _per_task(df, vector, fold, _BLOCKS, [labels] if labels else [], tasks)
    level = _added(partials, ["kind", "i", "width", "part"]).withColumn("numbers", F.concat("numbers", F.array(F.col("width").cast("double"), F.lit(1.0))))
    # the width goes along as a sum, so that vectors of different lengths in different tasks are noticed
    sums = _added(level, ["kind", "i"])
    size = F.size("numbers")
    width = F.element_at("numbers", -2) / F.element_at("numbers", -1)
    return sums.select("kind", "i", width.cast("int").alias("width"), F.slice("numbers", 1, size - 2).alias("numbers"))


def entries(sums: DataFrame) -> DataFrame:
    """Blocks number by number: 'n', 'x' (i), 'xx' (i <= j), 'yy' (label) and 'xy' (label, feature)."""
    each = sums.select("kind", "i", "width", F.posexplode("numbers").alias("at", "value"))
    kind, at, width = F.col("kind"), F.col("at"), F.col("width")
    label = kind == "xy"
    row = F.when(kind == "xx", F.col("i") * BAND + F.floor(at / width)).when(kind == "x", at).otherwise(F.col("i"))
    column = F.when(kind == "xx", at % width).when(label & (at > 0), at - 1).when(label, F.col("i")).otherwise(0)
    named = each.select(
        F.when(label & (at == 0), "yy").otherwise(kind).alias("kind"), row.cast("int").alias("i"), column.cast("int").alias("j"), "value"
    )
    return named.where((F.col("kind") != "xx") | (F.col("i") <= F.col("j")))


class Moments:
    """The part of the moments that every model needs, on the driver: n, x (d), xx (d x d), 8 d^2 bytes.

    What grows with the labels stays in the table.
    """

    def __init__(self, table: DataFrame):
        rows = table.where("kind <> 'xy'").collect()
        parts = {(row["kind"], row["i"]): np.array(row["numbers"]) for row in rows}
        widths = sorted({row["width"] for row in rows})
        if not rows:
            raise ValueError("no rows with a vector")
        if len(widths) > 1:
            raise ValueError(f"vectors of {widths[0]} and of {widths[-1]} numbers")
        self.n = float(parts["n", 0][0])
        self.x = parts["x", 0]
        bands = [parts[key] for key in sorted(key for key in parts if key[0] == "xx")]
        self.xx = np.concatenate(bands).reshape(len(self.x), -1)


def ridge_solver(sums: Moments, ridge: float) -> np.ndarray:
    """pinv(X'X + ridge n I), which gives any label's weights from its X'y."""
    return np.linalg.pinv(sums.xx + ridge * sums.n * np.identity(len(sums.xx)), hermitian=True)


def ridge_fit(df: DataFrame, vector: str, labels: str, ridges: Sequence[float] = RIDGES) -> DataFrame:
    """Coefficients (ridge, label, feature, weight, r2) of all ridges from one pass over the data.

    r2 is uncentred, (2 b'X'y - b'X'X b) / y'y.  One factorisation per ridge (8 d^2
    bytes, sent to the tasks) serves all labels, which are solved where their sums are.
    """
    table = materialize(moments(df, vector, labels), "moments")
    sums = Moments(table)
    shared = df.sparkSession.sparkContext.broadcast((sums.xx, {float(r): ridge_solver(sums, r) for r in ridges}))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xx, solvers = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = _matrix(batch.column("numbers"))
            yy, xy = numbers[:, 0], numbers[:, 1:]
            for ridge, solver in solvers.items():
                beta = xy @ solver
                r2 = (2 * np.sum(beta * xy, axis=1) - np.sum((beta @ xx) * beta, axis=1)) / yy
                weights = pa.ListArray.from_arrays(np.arange(len(beta) + 1, dtype=np.int32) * beta.shape[1], pa.array(beta.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(beta), ridge)), batch.column("i"), weights, pa.array(r2)], ["ridge", "label", "weights", "r2"]
                )

    solved = table.where("kind = 'xy'").select("i", "numbers").mapInArrow(solve, "ridge double, label int, weights array<double>, r2 double")
    return solved.select("ridge", "label", F.posexplode("weights").alias("feature", "weight"), "r2")


def group_means(df: DataFrame, by: Sequence[str], vector: str, name: str = "mean") -> DataFrame:
    """Mean vector per group; one partial vector per group and task is shuffled."""
    ml = array_to_vector(F.col(vector).cast("array<double>"))
    means = df.withColumn("_v", ml).groupBy(*by).agg(Summarizer.mean(F.col("_v")).alias("_mean"))
    return means.select(*by, vector_to_array("_mean").alias(name))


def model_rows(model: DataFrame) -> DataFrame:
    """Model table (label, feature, weight) as one row of weights per label: label, weights; absent ones are 0."""
    pairs = F.map_from_entries(F.collect_list(F.struct("feature", "weight")))
    last = model.agg(F.max("feature")).first()[0]
    weight = lambda at: F.coalesce(F.element_at("pairs", at), F.lit(0.0))
    places = F.sequence(F.lit(0), F.lit(last or 0))
    return model.groupBy("label").agg(pairs.alias("pairs")).select("label", F.transform(places, weight).alias("weights"))


def _present(batch: pd.Series) -> pd.Series:
    return batch[batch.notna()]


def _placed(items: list, batch: pd.Series) -> pd.Series:
    """Items of the present values at their places, None elsewhere."""
    out: list = [None] * len(batch)
    for at, item in zip(np.flatnonzero(batch.notna()), items):
        out[at] = item
    return pd.Series(out, dtype=object)


def _rows(vectors: pd.Series, width: int) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(float) if len(vectors) else np.zeros((0, width))


BLOCK = 512  # rows scored at once


def _best(scores: np.ndarray, top: int) -> np.ndarray:
    """Places of the `top` highest scores, ties to the smaller place."""
    if top < len(scores):
        limit = np.partition(scores, len(scores) - top)[len(scores) - top]
        near = np.flatnonzero(scores >= limit)
    else:
        near = np.arange(len(scores))
    return near[np.argsort(-scores[near], kind="stable")][:top]


SHARED_BYTES = 64 << 20  # of weights that are broadcast at once


def _label_blocks(model: DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Labels and their weights in blocks of at most SHARED_BYTES, by label; the driver holds one."""
    rows = materialize(running_sums(model_rows(model), [], ["label"], {"place": F.lit(1)}), "weights")
    sizes = rows.agg(F.count("*").alias("labels"), F.max(F.size("weights")).alias("width")).first()
    many = max(1, SHARED_BYTES // (8 * (sizes["width"] or 1)))
    for start in range(0, sizes["labels"], many):
        block = rows.where(F.col("place").between(start + 1, start + many)).orderBy("label").collect()
        yield np.array([row["label"] for row in block]), np.array([row["weights"] for row in block])


def linear_scores(df: DataFrame, vector: str, model: DataFrame, keep: int | None = None) -> DataFrame:
    """Columns of `df` with `scores`: array of (label, score), best first, all labels or the best `keep`.

    Weights of at most SHARED_BYTES are broadcast; more labels are scored block by block,
    each row keeping its best.  Equal scores go to the smaller label; a missing
    vector has no scores.
    """
    blocks = _label_blocks(model)
    block = next(blocks, None)
    if block is None:
        raise ValueError("a model without labels")
    scored = df.withColumn("scores", _block_scores(df, vector, *block, keep))
    for block in blocks:
        # a block's scores are written before the next block's weights are sent
        scored = materialize(scored, "scores").withColumn("_scores", _block_scores(df, vector, *block, keep))
        both = F.array_sort(F.concat("scores", "_scores"), _by_score)
        scored = scored.withColumn("scores", both if keep is None else F.slice(both, 1, keep)).drop("_scores")
    return scored


def _by_score(left: Column, right: Column) -> Column:
    ahead = (left["score"] > right["score"]) | ((left["score"] == right["score"]) & (left["label"] < right["label"]))
    return F.when(ahead, -1).otherwise(1)


def _block_scores(df: DataFrame, vector: str, labels: np.ndarray, beta: np.ndarray, keep: int | None) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(beta)
    top = len(labels) if keep is None else min(keep, len(labels))
    item = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(T.ArrayType(item))
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = shared.value
        for batch in parts:
            found = _present(batch)
            vectors, items = _rows(found, weights.shape[1]), []
            for at in range(0, len(vectors), BLOCK):
                table = vectors[at : at + BLOCK] @ weights.T
                items += [[{"label": int(labels[i]), "score": float(row[i])} for i in _best(row, top)] for row in table]
            yield _placed(items, batch)

    return score(F.col(vector))


@dataclass
class Components:
    """Principal components: mean (d), loadings (k x d), variance per component and its share."""

    mean: np.ndarray
    loadings: np.ndarray
    variance: np.ndarray
    share: np.ndarray


def total_of(df: DataFrame, vector: str, step: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of `step` over all rows, a matrix of vectors at a time; its size is what reaches the driver."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = step(_matrix(batch.column(0)))
                if total is not None and part.shape != total.shape:
                    raise ValueError("vectors of different lengths")
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["numbers"])

    sums = _added(_added(_per_task(df, vector, fold, "numbers array<double>"), ["part"]), []).first()["numbers"]
    if sums is None:
        raise ValueError("no rows with a vector")
    return np.array(sums)


def _triangle(rows: np.ndarray, above: np.ndarray | None = None) -> np.ndarray:
    """The square R of the QR factors of all rows, those of `above` first."""
    stacked = rows if above is None else np.concatenate([above, rows])
    wide = stacked.shape[1]
    if len(stacked) < wide:
        stacked = np.concatenate([stacked, np.zeros((wide - len(stacked), wide))])
    return np.linalg.qr(stacked, mode="r")


def _tall_triangle(df: DataFrame, vector: str, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """R of the rows on the basis, by QR per task, then per group of tasks, then of the groups' factors."""
    wide = basis.shape[1]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            if batch.num_rows:
                r = _triangle((_matrix(batch.column(0)) - mean) @ basis, r)
        if r is not None:
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel()], pa.list_(pa.float64()))], ["numbers"])

    def together(parts: pd.DataFrame) -> pd.DataFrame:
        r = None
        for numbers in parts["numbers"]:
            r = _triangle(np.reshape(numbers, (-1, wide)), r)
        return pd.DataFrame({"numbers": [r.ravel()]})

    factors = _per_task(df, vector, fold, "numbers array<double>")
    rows = factors.groupBy("part").applyInPandas(together, "numbers array<double>").collect()  # the root of the tasks
    return _triangle(np.concatenate([np.reshape(row["numbers"], (-1, wide)) for row in rows]))


def principal_components(
    df: DataFrame, vector: str, k: int | None = None, oversample: int = 10, rounds: int = 4
) -> Components:
    """The k first components of the centred rows (all by default); the largest loading of each is positive.

    A random basis of k + `oversample` directions is turned towards the rows by
    `rounds` passes and made orthonormal after each; the components are those of
    the rows on this basis.  Scores on them are uncorrelated whatever the rounds; the
    variances are lower bounds, exact where the basis spans everything.  The largest
    thing on the driver and in a task is d x (k + oversample) numbers, not d x d.
    """
    sums = total_of(df, vector, lambda rows: np.concatenate([[float(len(rows))], rows.sum(axis=0)]))
    n, mean = sums[0], sums[1:] / sums[0]
    d = len(mean)
    wide = d if k is None else min(d, k + oversample)
    if wide < d:
        basis = np.linalg.qr(np.random.default_rng(0).normal(size=(d, wide)))[0]
        for _ in range(rounds):
            turned = total_of(df, vector, lambda rows, q=basis: (rows - mean).T @ ((rows - mean) @ q))
            basis = np.linalg.qr(turned.reshape(d, wide))[0]
    else:
        basis = np.identity(d)
    _, singular, directions = np.linalg.svd(_tall_triangle(df, vector, mean, basis))
    whole = total_of(df, vector, lambda rows: np.array([((rows - mean) ** 2).sum()]))[0]
    loadings = (directions @ basis.T)[:k]
    largest = loadings[np.arange(len(loadings)), np.abs(loadings).argmax(axis=1)]
    return Components(
        mean=mean,
        loadings=loadings * np.where(largest < 0, -1.0, 1.0)[:, None],
        variance=singular[:k] ** 2 / (n - 1),
        share=singular[:k] ** 2 / whole,
    )


def project(vector: Column, components: Components) -> Column:
    """Scores of a vector on the components."""
    mean, loadings = components.mean, components.loadings

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in parts:
            found = _present(batch)
            projected = list((_rows(found, len(mean)) - mean) @ loadings.T)
            yield _placed(projected, batch)

    return scores(vector)
