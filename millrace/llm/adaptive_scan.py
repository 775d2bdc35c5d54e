"""Approximate nearest neighbours by inner product, with adaptive dimension scans.

Vectors get one more coordinate that turns the largest inner product into the
smallest distance, and a random rotation that spreads distance evenly over the
coordinates.  They lie in lists around centroids.  Within a probed list the
rotated vectors are scanned in blocks of columns: after each block a hypothesis
test on the partial distance abandons every candidate whose whole distance is
very unlikely to beat the query's threshold.  Candidates that survive all blocks
get their exact inner product.

Rotation, centroids and the number of probes come from a bounded sample, whose
own best vectors give each query its threshold; every vector is in the index.
The scan alone answers: the sample's best vectors only fill up a query whose scan
found fewer than k.  Large lists are cut into chunks on both sides, so no task
holds more than a chunk of candidates and one of queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from millrace.llm.common import map_batches
from millrace.sources.storage import materialize

SAMPLE = 8192  # vectors that the index is fitted on
TRIALS = 256  # of them, as queries that set the number of probes
MAX_LISTS = 1024
RECALL = 0.97  # of the trials' neighbours, to be found in the probed lists
BLOCK = 16  # columns between two tests
CONFIDENCE = 2.1  # a larger value abandons less
MAX_CHUNK = 20_000
SEED = 11

FOUND = "query_id long, vec_id long, score double"


def usable(vector: str, dimension: Column | None = None) -> Column:
    """Vectors that take part: whole, finite, not zero."""
    good = F.expr(
        f"size({vector}) > 0 and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) "
        f"and exists({vector}, x -> x != 0)"
    )
    return F.coalesce(good, F.lit(False)) if dimension is None else F.coalesce(good & (F.size(vector) == dimension), F.lit(False))


def _rows(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


class Index:
    """What the sample says: rotation, norm bound, centroids, probes."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, count: int, bound: float, k: int):
        rng = np.random.default_rng(SEED)
        self.bound, self.k = bound, k
        self.rotation = np.linalg.qr(rng.standard_normal((sample.shape[1] + 1,) * 2))[0]
        self.ids, self.sample = ids, sample
        lists = max(1, min(MAX_LISTS, len(sample) // 8, round(count**0.5 / 4)))
        lifted = self.lift(sample)
        centres = lifted[rng.choice(len(lifted), lists, replace=False)]
        for _ in range(10):
            nearest = self._order(lifted, centres, 1)[:, 0]
            for j in np.unique(nearest):
                centres[j] = lifted[nearest == j].mean(axis=0)
        self.centres = centres
        self.probes = self._probes(lifted)

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors of the index, extended to norm `bound` and rotated."""
        rest = np.sqrt(np.maximum(self.bound**2 - (vectors**2).sum(axis=1), 0))
        return np.column_stack([vectors, rest]) @ self.rotation

    def lift_queries(self, vectors: np.ndarray) -> np.ndarray:
        return np.column_stack([vectors, np.zeros(len(vectors))]) @ self.rotation

    @staticmethod
    def _order(points: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
        far = (centres**2).sum(axis=1) - 2 * points @ centres.T
        return np.argsort(far, axis=1, kind="stable")[:, :n]

    def lists(self, vectors: np.ndarray) -> np.ndarray:
        return self._order(self.lift(vectors), self.centres, 1)[:, 0]

    def probed(self, queries: np.ndarray) -> np.ndarray:
        return self._order(self.lift_queries(queries), self.centres, self.probes)

    def _probes(self, lifted: np.ndarray) -> int:
        """Lists to probe so that the trials' neighbours in the sample are found."""
        trial = self.sample[:TRIALS]
        scores = trial @ self.sample.T
        scores[np.arange(len(trial)), np.arange(len(trial))] = -np.inf
        k = min(self.k, len(self.sample) - 1)
        if k < 1:
            return len(self.centres)
        near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
        home = self._order(lifted, self.centres, 1)[:, 0]
        ranks = np.argsort(self._order(self.lift_queries(trial), self.centres, len(self.centres)), axis=1)
        needed = np.sort(np.take_along_axis(ranks, home[near], axis=1).ravel())
        return int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))]) + 1

    def sample_best(self, ids: np.ndarray, queries: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids and inner products of each query's k best vectors of the sample, or of all it has."""
        names, scores = [], []
        for own, query in zip(ids, queries):
            found = (self.sample * query).sum(axis=1)
            found[self.ids == own] = -np.inf
            best = np.argsort(-found, kind="stable")[: self.k]
            best = best[np.isfinite(found[best])]
            names.append(self.ids[best])
            scores.append(found[best])
        return names, scores


def scan(index: Index, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, least: np.ndarray):
    """Per query, the ids and inner products of the k best candidates that the tests leave."""
    rotated, turned = index.lift(vectors), index.lift_queries(queries)
    dims = rotated.shape[1]
    cuts = [(a, min(a + BLOCK, dims)) for a in range(0, dims, BLOCK)]
    columns = [np.ascontiguousarray(rotated[:, a:b]) for a, b in cuts]
    limits = np.maximum((queries**2).sum(axis=1) + index.bound**2 - 2 * least, 0) * (1 + 1e-9) + 1e-9
    first = (columns[0] ** 2).sum(axis=1)[:, None] - 2 * columns[0] @ turned[:, : cuts[0][1]].T + (turned[:, : cuts[0][1]] ** 2).sum(axis=1)
    for j, (own, query, limit) in enumerate(zip(query_ids, queries, limits)):
        part, alive = first[:, j], np.flatnonzero(ids != own)
        part = part[alive]
        for block, (a, b) in enumerate(cuts):
            if block:
                part = part + ((columns[block][alive] - turned[j, a:b]) ** 2).sum(axis=1)
            if b < dims:
                # the partial distance, scaled up, against the threshold and the doubt at b of dims columns
                passed = part * (dims / b) <= limit * (1 + CONFIDENCE / np.sqrt(b)) ** 2
            else:
                passed = part <= limit * (1 + 1e-9)
            alive, part = alive[passed], part[passed]
        scores = (vectors[alive] * query).sum(axis=1)
        order = np.lexsort((ids[alive], -scores))
        chosen, seen = [], set()
        for i in order:
            if len(chosen) == index.k:
                break
            if ids[alive[i]] not in seen:
                seen.add(ids[alive[i]])
                chosen.append(i)
        yield own, ids[alive[chosen]] if chosen else ids[:0], scores[chosen] if chosen else scores[:0]


def scanned(
    candidates: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding"
) -> tuple[DataFrame, DataFrame] | None:
    """What the scan finds, as `FOUND`, and the queries with their best of the sample; none without usable vectors.

    A pair occurs once, with its best score; a query has the best of every list
    it probes, more than `k` in all.
    """
    spark = candidates.sparkSession
    vector = F.col(vector_col).cast("array<double>")
    rows = candidates.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), queries.alias("asked")).where(
        F.col("id").isNotNull() & usable("vector")
    )
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.expr("aggregate(vector, 0D, (s, x) -> s + x * x)")).alias("norm")
    )
    common = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return None
    rows = rows.where(F.size("vector") == common.d)
    picked = rows.orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(SAMPLE).toArrow()
    ids, first = np.unique(picked.column("id").to_numpy(), return_index=True)
    index = Index(_rows(picked.column("vector"))[first], ids, common.n, float(np.sqrt(common.norm)) * (1 + 1e-12), k)

    def home(batch: pa.RecordBatch) -> pa.RecordBatch:
        homes = pa.array(index.lists(_rows(batch.column("vector"))), pa.int32())
        return pa.RecordBatch.from_arrays([*batch.columns, homes], ["id", "vector", "asked", "list"])

    indexed = materialize(map_batches(rows, home, "id long, vector array<double>, asked boolean, list int"), "lists")

    def probe(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, vectors = batch.column("id").to_numpy(), _rows(batch.column("vector"))
        names, scores = index.sample_best(own, vectors)
        least = [s[-1] if len(s) == k else -np.inf for s in scores]
        arrays = [pa.array(own), batch.column("vector"), pa.array(least, pa.float64())]
        arrays.append(pa.array(list(index.probed(vectors)), pa.list_(pa.int64())).cast(pa.list_(pa.int32())))
        arrays += [pa.array(names, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.float64()))]
        return pa.RecordBatch.from_arrays(arrays, ["id", "vector", "least", "probes", "names", "scores"])

    asked = map_batches(
        indexed.where(F.coalesce("asked", F.lit(False))).select("id", "vector"),
        probe,
        "id long, vector array<double>, least double, probes array<int>, names array<long>, scores array<double>",
    )
    asked = materialize(asked, "queries")
    visits = asked.select("id", "vector", "least", F.explode("probes").alias("list"))

    # chunks per list: as many rows as the lists have on average, within bounds
    def chunks(sizes: DataFrame, floor: int) -> DataFrame:
        found = {r["list"]: r["n"] for r in sizes.collect()}  # at most MAX_LISTS rows
        size = min(MAX_CHUNK, max(floor, sum(found.values()) * 2 // max(1, len(index.centres))))
        table = [(name, max(1, -(-n // size))) for name, n in found.items()]
        return F.broadcast(spark.createDataFrame(table, "list int, chunks int"))

    held = chunks(indexed.groupBy("list").agg(F.count(F.lit(1)).alias("n")), 256).withColumnRenamed("chunks", "held")
    wanted = chunks(
        asked.select(F.explode("probes").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("n")), 64
    ).withColumnRenamed("chunks", "wanted")
    piece = lambda name, chunks: F.pmod(F.xxhash64("id"), F.col(chunks)).cast("int").alias(name)
    every = lambda name, chunks: F.explode(F.sequence(F.lit(0), F.col(chunks) - 1)).alias(name)
    left = indexed.join(held, "list").join(wanted, "list").select("list", piece("c", "held"), every("q", "wanted"), "id", "vector")
    right = visits.join(held, "list").join(wanted, "list").select("list", every("c", "held"), piece("q", "wanted"), "id", "vector", "least")

    def search(here: pa.Table, there: pa.Table) -> pa.Table:
        out = ([], [], [])
        if here.num_rows and there.num_rows:
            found = scan(
                index,
                here.column("id").to_numpy(),
                _rows(here.column("vector")),
                there.column("id").to_numpy(),
                _rows(there.column("vector")),
                there.column("least").to_numpy(),
            )
            for own, names, scores in found:
                out[0].append(np.full(len(names), own))
                out[1].append(names)
                out[2].append(scores)
        arrays = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.float64()))]
        return pa.table(arrays, ["query_id", "vec_id", "score"])

    keys = ["list", "c", "q"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, FOUND)
    best = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best, asked


def nearest(
    candidates: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score` of the `k` nearest found for every row where `queries` holds.

    Nearness is the inner product of the original vectors in double precision,
    ties to the smaller id; the query's own id is no candidate.  Vectors that
    are null, zero, of another length than most, or hold a null or non-finite
    component take no part, nor do rows without an id.  Repeated ids count once,
    with the best score.  A query whose scan finds fewer than `k` is filled up from the
    sample, so with `k` candidates or fewer all are returned.
    """
    done = scanned(candidates, queries, k, id_col, vector_col)
    if done is None:
        return candidates.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    best, asked = done
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    top = materialize(ranked.select("query_id", "rank", "vec_id", "score"), "scanned")
    full = top.where(F.col("rank") == k).select("query_id")
    # the others take the sample's best as candidates too
    met = asked.select(F.col("id").alias("query_id"), F.explode(F.arrays_zip("names", "scores")).alias("m"))
    met = met.select("query_id", F.col("m.names").alias("vec_id"), F.col("m.scores").alias("score"))
    short = top.select("query_id", "vec_id", "score").union(met).join(full, "query_id", "left_anti")
    short = short.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    filled = short.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(full, "query_id", "left_semi").union(filled.select("query_id", "rank", "vec_id", "score"))
