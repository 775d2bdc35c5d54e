"""Nearest neighbours of all rows by a metric tree that is written level by level.

A node with many rows chooses some of them as pivots, every row falls to the nearest
pivot, and the pivots' cells are the nodes of the next level.  Nodes, pairs of nodes and
lists of partners are tables: the driver only learns whether another level is needed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, WindowSpec, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.operators.aggregates import top_per_group
from millrace.operators.sequences import running_sums
from millrace.sources.storage import materialize

FANOUT = 64  # pivots of a node
DEEPEST = 9  # levels; numbers of nodes stay below FANOUT ** (DEEPEST + 1)
PIECE_ROWS = 16_384  # rows of a node that one group handles
PIECE_PARTNERS = 4_096  # leaves whose gaps to TILE queries are held at a time, or as many gaps of fewer queries
PAIR_SLICE = 50_000  # candidate pairs whose distance is recomputed at a time
QUERY_ROWS = 16  # queries of a block, times the square root of the number of rows
COARSE = 512  # nodes of a level from which pairs of nodes are taken
TILE = 1_024  # queries and targets of one product
QUERY, LEAF, TARGET = range(3)  # kinds of rows, in the order in which a block needs them


@dataclass
class Tree:
    rows: DataFrame  # id, v, leaf
    levels: list[DataFrame]  # from the top: parent, node, centre, radius, n; finished nodes are their own parents


def _stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_list()).astype(float)


def _nothing(*names: str) -> pd.DataFrame:
    return pd.DataFrame({name: pd.Series([], dtype=object) for name in names})


def distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All Euclidean distances, with the rounding of a matrix product."""
    squared = (left**2).sum(axis=1)[:, None] + (right**2).sum(axis=1)[None, :] - 2 * left @ right.T
    return np.sqrt(np.maximum(squared, 0.0))


def _slack(*parts: np.ndarray) -> np.ndarray:
    """Room for the rounding of distances of this size."""
    return 1e-7 * (1.0 + sum(np.abs(p) for p in parts))


def closest(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """k nearest of `vectors` per query, ties to the smaller id.

    Matrix products find candidates with room for rounding; the candidates'
    distances are then summed directly, so copies are at distance 0.
    """
    norms, others = (queries**2).sum(axis=1), (vectors**2).sum(axis=1)
    squared = norms[:, None] + others[None, :] - 2 * queries @ vectors.T
    if len(ids) > k:
        limit = np.partition(squared, k - 1, axis=1)[:, k - 1]
    else:
        limit = np.full(len(queries), np.inf)
    margin = 1e-11 * (norms + others.max(initial=0.0)) * max(1, queries.shape[1] // 64)
    rows, columns = np.nonzero(squared <= (limit + margin)[:, None])
    exact = np.empty(len(rows))
    for start in range(0, len(rows), PAIR_SLICE):
        part = slice(start, start + PAIR_SLICE)
        exact[part] = np.sqrt(((queries[rows[part]] - vectors[columns[part]]) ** 2).sum(axis=1))
    order = np.lexsort((ids[columns], exact, rows))
    rows, columns, exact = rows[order], columns[order], exact[order]
    first = np.searchsorted(rows, np.arange(len(queries)))
    keep = np.arange(len(rows)) - first[rows] < k
    return query_ids[rows[keep]], ids[columns[keep]], exact[keep]


def _pieces(count, size: int):
    return F.ceil(F.col(count) / size).cast("int")


def _renewed(df: DataFrame) -> DataFrame:
    """The same columns under identities of their own, for a side that shares its origin with the other."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _each_piece(df: DataFrame) -> DataFrame:
    """Every row once for each of its `pieces`."""
    return df.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces")


def build(points: DataFrame, block_rows: int, fanout: int = FANOUT) -> Tree:
    """The tree over (id, v) with distinct vectors; leaves hold at most `block_rows` rows each.

    Distinct vectors always part, since each pivot is nearest to itself.
    """
    types = {f.name: f.dataType.simpleString() for f in points.schema.fields}
    moved = f"id {types['id']}, v {types['v']}, parent bigint, node bigint, gap double"

    def assign(rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return _nothing("id", "v", "parent", "node", "gap")
        pivots = pivots.sort_values("rank")
        own, centres = _stacked(rows["v"]), _stacked(pivots["v"])
        cell = distances(own, centres).argmin(axis=1)
        gap = np.sqrt(((own - centres[cell]) ** 2).sum(axis=1))
        node = rows["node"].to_numpy()
        child = node * fanout + pivots["rank"].to_numpy(np.int64)[cell]
        return pd.DataFrame({"id": rows["id"], "v": rows["v"], "parent": node, "node": child, "gap": gap})

    waiting = points.select("id", "v", F.lit(0).cast("bigint").alias("node"))
    finished: list[DataFrame] = []
    levels: list[DataFrame] = []
    for _ in range(DEEPEST):
        counts = waiting.groupBy("node").agg(F.count("*").alias("n"))
        full = materialize(counts.where(F.col("n") > block_rows).select("node", _pieces("n", PIECE_ROWS).alias("pieces")), "full")
        if full.isEmpty():
            break
        splitting = waiting.join(full, "node")
        hashed = F.xxhash64("id", F.lit(len(levels)))
        pivots = materialize(
            top_per_group(splitting, ["node"], [hashed.asc(), F.col("id").asc()], fanout).select("node", "id", "v", "rank", "pieces"), "pivots"
        )
        dealt = splitting.withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int")).drop("pieces")
        placed = materialize(
            dealt.groupBy("node", "piece").cogroup(_renewed(_each_piece(pivots)).groupBy("node", "piece")).applyInPandas(assign, moved), "cells"
        )
        cells = placed.groupBy("parent", "node").agg(F.max("gap").alias("radius"), F.count("*").alias("n"))
        centres = pivots.select((F.col("node") * fanout + F.col("rank")).alias("node"), F.col("v").alias("centre"))
        level = cells.join(centres, "node").select("parent", "node", "centre", "radius", "n")
        if levels:
            over = levels[-1].join(full, "node", "left_anti")
            level = level.unionByName(over.withColumn("parent", F.col("node")))
        levels.append(materialize(level, "level"))
        finished.append(waiting.join(full, "node", "left_anti"))
        waiting = placed.select("id", "v", "node")
    rows = waiting
    for part in finished:
        rows = rows.unionByName(part)
    return Tree(rows.withColumnRenamed("node", "leaf"), levels)


def leaf_pairs(tree: Tree, k: int) -> DataFrame:
    """Pairs of leaves (q, t) of which q's rows may have some of their k nearest in t.

    The pairs go down from the root.  Within `high` of any row of q lie all n rows
    of t, so the least `high` that k rows keep bounds how far q's rows have to look;
    `low` is how near t's rows can be at most.  Also returned: q's bound (`reach`).
    """
    spark = tree.rows.sparkSession
    pairs = spark.createDataFrame([(0, 0)], "q bigint, t bigint")
    schema = "q bigint, t bigint, low double, high double, n bigint"

    def expand(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return _nothing("q", "t", "low", "high", "n")
        between = distances(_stacked(left["centre"]), _stacked(right["centre"]))
        both = left["radius"].to_numpy()[:, None] + right["radius"].to_numpy()[None, :]
        room = _slack(between, both)
        many = len(right)
        return pd.DataFrame(
            {
                "q": np.repeat(left["node"].to_numpy(), many),
                "t": np.tile(right["node"].to_numpy(), len(left)),
                "low": (between - both - room).ravel(),
                "high": (between + both + room).ravel(),
                "n": np.tile(right["n"].to_numpy(), len(left)),
            }
        )

    for nodes in tree.levels:
        own = pairs.join(nodes.withColumnRenamed("parent", "q"), "q").select("q", "t", "node", "centre", "radius")
        other = pairs.join(nodes.withColumnRenamed("parent", "t"), "t").select("q", "t", "node", "centre", "radius", "n")
        met = own.groupBy("q", "t").cogroup(_renewed(other).groupBy("q", "t")).applyInPandas(expand, schema)
        by_high = F.sum("n").over(_window("q", "high", "t"))
        reach = F.min(F.when(F.col("kept") >= k, F.col("high"))).over(_window("q"))
        bounded = met.withColumn("kept", by_high).withColumn("reach", F.coalesce(reach, F.lit(float("inf"))))
        pairs = materialize(bounded.where("low <= reach").select("q", "t", "reach", F.col("n").alias("n_t")), "pairs")
    return pairs


def _window(key: str, *order: str) -> WindowSpec:
    window = Window.partitionBy(key)
    return window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0) if order else window


def _laid_out(tree: Tree, k: int, share: float = 1.0) -> DataFrame:
    """What each block of queries has to see, in order: its queries, the leaves that may matter to it, their rows.

    Leaves in the order of the tree are cut into blocks of even size; with a share, whose
    answers depend on a query's own leaf, only leaves of more than PIECE_ROWS are cut.
    Pairs of nodes are taken from the last level of at most COARSE nodes, so their number
    is bounded, and a block's rows are held against single leaves by the task that has them.
    """
    leaves = tree.levels[0].select(F.array("node").alias("path"), F.col("node").alias("leaf"), "centre", "radius", "n")
    for level in tree.levels[1:]:
        above = leaves.select("path", F.col("leaf").alias("parent"))
        leaves = above.join(level, "parent").select(F.concat("path", F.array("node")).alias("path"), F.col("node").alias("leaf"), "centre", "radius", "n")
    leaves = materialize(leaves, "leaves")
    depth = 1
    while depth < len(tree.levels) and tree.levels[depth].count() <= COARSE:
        depth += 1
    total = leaves.agg(F.sum("n")).first()[0]
    size = max(1, math.ceil(QUERY_ROWS * math.sqrt(total)))
    summed = running_sums(leaves.select("path", "leaf", "n"), [], ["path"], {"end": F.col("n")})
    block = lambda row: F.floor(row / size).cast("int")
    first, last = block(F.col("end") - F.col("n")), block(F.col("end") - 1)
    last = last if share == 1 else F.when(F.col("n") > PIECE_ROWS, last).otherwise(first)
    cut = materialize(summed.select("path", "leaf", F.element_at("path", depth).alias("cell"), first.alias("first"), last.alias("last")), "cut")
    pairs = leaf_pairs(Tree(tree.rows, tree.levels[:depth]), k)
    bounds = pairs.groupBy(F.col("q").alias("cell")).agg(F.max("reach").alias("bound"))
    spread = F.pmod(F.xxhash64("id"), F.col("last") - F.col("first") + 1).cast("int")
    queries = tree.rows.join(cut.join(bounds, "cell"), "leaf").select(
        (F.col("first") + spread).alias("block"), F.lit(QUERY).alias("kind"), "path", "leaf", "id", "v", F.col("bound").alias("far")
    )
    wanted = (
        cut.select(F.col("cell").alias("q"), F.explode(F.sequence("first", "last")).alias("block"))
        .distinct()
        .join(pairs, "q")
        .select("block", F.col("t").alias("cell"))
        .distinct()
        .groupBy("cell")
        .agg(F.collect_list("block").alias("blocks"))
    )
    met = cut.join(wanted, "cell").select("path", "leaf", "blocks")
    types = {f.name: f.dataType for f in tree.rows.schema.fields}
    shapes = leaves.drop("path").join(met, "leaf").select(
        F.explode("blocks").alias("block"), F.lit(LEAF).alias("kind"), "path", "leaf", F.lit(None).cast(types["id"]).alias("id"), F.col("centre").alias("v"), F.col("radius").alias("far")
    )
    targets = tree.rows.join(met, "leaf").select(
        F.explode("blocks").alias("block"), F.lit(TARGET).alias("kind"), "path", "leaf", "id", "v", F.lit(0.0).alias("far")
    )
    blocks = -(-total // size)
    laid = queries.unionByName(shapes).unionByName(targets).repartitionById(blocks, F.col("block"))
    return laid.sortWithinPartitions("block", "kind", "path", "id").drop("path")


class _Queries:
    """A block's queries with the k nearest of them that were met so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaves: np.ndarray, bounds: np.ndarray, k: int, share: float):
        self.ids, self.vectors, self.leaves, self.k, self.share = ids, vectors, leaves, k, share
        self.norms = (vectors**2).sum(axis=1)
        self.wide = np.concatenate([vectors, np.ones((len(ids), 1))], axis=1)
        with np.errstate(over="ignore"):
            self.single = self.wide.astype(np.float32)
        self.best = np.full((len(ids), k), np.inf)
        self.near = np.empty((len(ids), k), ids.dtype)
        self.waiting: list = []
        self.cut = None
        # squares of how far a query has to look
        self.limit = np.full(len(ids), np.inf)
        # with a share only a query's own leaf is sure to be looked into
        edges = range(0, len(ids), TILE) if share == 1 else [0, *np.flatnonzero(leaves[1:] != leaves[:-1]) + 1]
        for low, high in zip(edges, [*edges[1:], len(ids)]):
            scored, rows = _scored(vectors[low:high]), max(1, TILE * PIECE_PARTNERS // (high - low))
            for start in range(low, high, rows):
                part = slice(start, min(start + rows, high))
                self.limit[part] = self._kth(part, scored)
        self.reach = np.minimum(np.sqrt(self.limit), bounds)
        if share == 1:
            self.limit = np.minimum(self.limit, bounds**2 * (1 + 1e-9))

    def _margin(self, rows, scored: np.ndarray) -> np.ndarray:
        return 1e-11 * self._squares(rows, scored) * max(1, self.vectors.shape[1] // 64)

    def _squares(self, rows, scored: np.ndarray) -> np.ndarray:
        return np.nan_to_num(self.norms[rows]) - 2 * np.nanmin(scored[:, -1], initial=0.0)

    def _kth(self, rows, scored: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
        """A square that the k-th nearest of the allowed vectors does not exceed."""
        if len(scored) < self.k:
            return np.full(len(self.norms[rows]), np.inf)
        squared = self.norms[rows][:, None] - 2 * (self.wide[rows] @ scored.T)
        if allowed is not None:
            squared[~allowed] = np.inf
        kth = np.partition(squared, self.k - 1, axis=1)[:, self.k - 1] + self._margin(rows, scored)
        return np.where(np.isnan(kth), np.inf, np.maximum(kth, 0.0))

    def gaps(self, rows, centres: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """How near the rows of leaves can be at least."""
        between = distances(self.vectors[rows], centres)
        return between - radius[None, :] - _slack(between, radius[None, :])

    def choose(self, leaves: np.ndarray, centres: np.ndarray, radius: np.ndarray) -> None:
        """With a share: the largest gap of the leaves that each query looks into, apart from its own."""
        if self.share == 1:
            return
        self.cut = np.full(len(self.ids), -np.inf)
        rows = max(1, TILE * PIECE_PARTNERS // max(1, len(leaves)))
        for start in range(0, len(self.ids), rows):
            part = slice(start, start + rows)
            gap = self.gaps(part, centres, radius)
            gap[(gap > self.reach[part][:, None]) | (self.leaves[part][:, None] == leaves[None, :])] = np.inf
            places = np.ceil(np.isfinite(gap).sum(axis=1) * self.share).astype(int)
            for place in np.unique(places[places > 0]):
                some = np.flatnonzero(places == place)
                self.cut[start + some] = np.partition(gap[some], place - 1, axis=1)[:, place - 1]

    def meet(self, ids: np.ndarray, vectors: np.ndarray, leaves: np.ndarray, shapes: dict) -> None:
        """Hold targets, of a few leaves that follow one another, against the queries that may have them near."""
        names, of = np.unique(leaves, return_inverse=True)
        centres, radius = np.stack([shapes[n][0] for n in names]), np.array([shapes[n][1] for n in names])
        scored = _scored(vectors)
        for start in range(0, len(self.ids), TILE):
            rows = np.arange(start, min(start + TILE, len(self.ids)))
            gap = self.gaps(rows, centres, radius)
            if self.share < 1:
                # the same gap may be rounded otherwise in another product
                cut = self.cut[rows][:, None]
                open_ = (gap <= cut + 1e-12 * (1 + np.abs(cut))) | (self.leaves[rows][:, None] == names[None, :])
            else:
                open_ = gap <= np.sqrt(self.limit[rows])[:, None]
            some = open_.any(axis=1)
            if not some.all():
                rows, open_ = rows[some], open_[some]
            if len(rows):
                self._match(rows, open_, ids, vectors, scored, of)

    def _match(self, rows: np.ndarray, open_: np.ndarray, ids: np.ndarray, vectors: np.ndarray, scored: np.ndarray, of: np.ndarray) -> None:
        new = np.flatnonzero(np.isinf(self.limit[rows]))
        if len(new):
            self.limit[rows[new]] = self._kth(rows[new], scored, open_[new][:, of] if self.share < 1 else None)
        # single precision is twice as fast, and enough where its rounding is small beside the limits
        squares = self._squares(rows, scored)
        rough = squares * (self.vectors.shape[1] + 8) * 2.0**-23
        if (rough * 16 <= self.limit[rows]).all() and squares.min() > 1e-25 and squares.max() < 1e30:
            least = (self.norms[rows] - self.limit[rows] - rough) / 2
            found = np.flatnonzero((self.single[rows] @ scored.astype(np.float32).T) >= least.astype(np.float32)[:, None])
        else:
            least = (self.norms[rows] - self.limit[rows] - self._margin(rows, scored)) / 2
            found = np.flatnonzero((self.wide[rows] @ scored.T) >= least[:, None])
        row, column = np.divmod(found, len(ids))
        if self.share < 1:
            seen = open_[row, of[column]]
            row, column = row[seen], column[seen]
        row = rows[row]
        for start in range(0, len(row), PAIR_SLICE):
            r, c = row[start : start + PAIR_SLICE], column[start : start + PAIR_SLICE]
            exact = np.sqrt(((self.vectors[r] - vectors[c]) ** 2).sum(axis=1))
            self.waiting.append((r, exact, ids[c]))
            if sum(len(w[0]) for w in self.waiting) > 2 * len(self.ids):
                self.merge()

    def merge(self) -> None:
        """Take the pairs that wait among the nearest, ties to the smaller id."""
        if not self.waiting:
            return
        row, exact, ids = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting = []
        touched = np.unique(row)
        held = np.isfinite(self.best[touched])
        row = np.concatenate([row, np.repeat(touched, held.sum(axis=1))])
        exact = np.concatenate([exact, self.best[touched][held]])
        ids = np.concatenate([ids, self.near[touched][held]])
        order = np.lexsort((ids, exact, row))
        row, exact, ids = row[order], exact[order], ids[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        row, place = row[keep], place[keep]
        self.best[touched] = np.inf
        self.best[row, place], self.near[row, place] = exact[keep], ids[keep]
        self.limit[touched] = np.minimum(self.limit[touched], self.best[touched, -1] ** 2)

    def found(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        self.merge()
        for start in range(0, len(self.ids), TILE):
            held = np.isfinite(self.best[start : start + TILE])
            row, place = np.nonzero(held)
            yield self.ids[start + row], self.near[start + row, place], self.best[start + row, place]


def _scored(vectors: np.ndarray) -> np.ndarray:
    """Vectors beside half their negative squares: the product with a query and 1 falls with the distance."""
    return np.concatenate([vectors, -(vectors**2).sum(axis=1)[:, None] / 2], axis=1)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """Runs of rows of one block and kind."""
    for batch in batches:
        block, kind = (batch.column(name).to_numpy() for name in ("block", "kind"))
        edges = np.flatnonzero((block[1:] != block[:-1]) | (kind[1:] != kind[:-1])) + 1
        for low, high in zip([0, *edges], [*edges, batch.num_rows]):
            if high > low:
                yield block[low], kind[low], batch.slice(low, high - low)


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    if len(pc.unique(pc.list_value_length(column))) != 1:
        raise ValueError("vectors must have the same length")
    return flat.reshape(len(column), -1)


def _search(k: int, share: float, id_type: pa.DataType) -> Callable:
    """The task of a block: its queries are held, leaves and targets pass by."""
    # a missing id comes first, as in Spark's order
    missing = np.iinfo(np.int64).min
    numbers = pa.types.is_integer(id_type)

    def named(column: pa.Array) -> np.ndarray:
        return pc.fill_null(column.cast(pa.int64()), missing).to_numpy() if numbers else column.to_numpy(zero_copy_only=False)

    def names(ids: np.ndarray) -> pa.Array:
        return pa.array(ids, mask=ids == missing).cast(id_type) if numbers else pa.array(ids, id_type)

    def answers(queries: _Queries | None) -> Iterator[pa.RecordBatch]:
        for ids, near, best in queries.found() if queries else ():
            yield pa.RecordBatch.from_arrays([names(ids), names(near), pa.array(best)], ["id", "neighbour", "distance"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, queries, held, shapes = None, None, [], {}
        for block, kind, part in _parts(batches):
            if block != current:
                yield from answers(queries)
                current, queries, held, shapes = block, None, [], {}
            leaves, far = part.column("leaf").to_numpy(), part.column("far").to_numpy()
            vectors = _vectors(part.column("v"))
            if kind == LEAF:
                shapes.update(zip(leaves.tolist(), zip(vectors, far)))
                continue
            ids = named(part.column("id"))
            if kind == QUERY:
                held.append((ids, vectors, leaves, far))
                continue
            if queries is None and held:
                queries, held = _Queries(*(np.concatenate(c) for c in zip(*held)), k, share), []
                centres, radius = (np.array(c) for c in zip(*shapes.values()))
                queries.choose(np.array(list(shapes)), centres, radius)
            if queries is None:
                continue  # a block without queries
            for start in range(0, len(ids), TILE):
                some = slice(start, start + TILE)
                queries.meet(ids[some], vectors[some], leaves[some], shapes)
        yield from answers(queries)

    return run


def neighbours(points: DataFrame, k: int, block_rows: int, fanout: int = FANOUT, share: float = 1.0) -> DataFrame:
    """The k nearest of all points (id, v) of each point, itself included: id, neighbour, distance.

    Vectors must be distinct.  A task holds a block of queries and the k nearest met so
    far, while the rows of all leaves that may matter pass by; blocks grow with the square
    root of the rows, so what is shuffled grows with their power of 1.5.  With a `share`
    below 1 a point looks only into that share of the other leaves that may hold some of
    its nearest, those that may hold the nearest ones first, and its answer is no longer exact.
    """
    tree = build(points, block_rows, fanout)
    types = {f.name: f.dataType for f in points.schema.fields}
    id_name = types["id"].simpleString()
    schema = f"id {id_name}, neighbour {id_name}, distance double"

    def within(rows: pd.DataFrame) -> pd.DataFrame:
        ids, own = rows["id"].to_numpy(), _stacked(rows["v"])
        parts = [closest(ids[start : start + 1024], own[start : start + 1024], ids, own, k) for start in range(0, len(rows), 1024)]
        return pd.DataFrame({name: np.concatenate(column) for name, column in zip(("id", "neighbour", "distance"), zip(*parts))})

    if not tree.levels:
        return tree.rows.groupBy("leaf").applyInPandas(within, schema)
    laid = _laid_out(tree, k, share)
    return laid.mapInArrow(_search(k, share, to_arrow_type(types["id"])), schema)
