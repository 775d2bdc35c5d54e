"""Communities of a graph by modularity: local moves, refinement, aggregation.

Each level moves nodes to the neighbouring cluster with the largest gain, refines the
clusters into well-connected parts, and makes the parts the nodes of the next level.
Parts only ever grow by joining a neighbour that stays, so every part is connected, and
the last level has one part per cluster.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.operators.joins import hot_keys, inner_join
from millrace.operators.neighbours import HUB_SHARE, modularity
from millrace.sources.storage import materialize

BLOCK_EDGES = 4_000_000  # mean edges of the nodes that one group moves in turn
HUB_EDGES = 100_000  # a node with more edges stays, others come to it
REFINE_ROUNDS = 4  # of joins, in which each half of the nodes moves twice
NOISE = 1e-10  # relative to the weight of a node or the whole graph: gains below this are rounding


class _Block:
    """The nodes of a block with their edges, and what they see of all others.

    Nodes and clusters are numbered in the order of their names, edges lie in arrays by
    node: about 100 bytes an edge while the block is read, 12 after that.
    """

    def __init__(self, rows: pa.Table | pd.DataFrame):
        column = lambda name: np.asarray(rows[name])
        self.total = float(rows["total"][0].as_py() if isinstance(rows, pa.Table) else rows["total"].iloc[0])
        self.ids = _names(column("src"), column("dst"))
        src = np.searchsorted(self.ids, column("src")).astype(np.int32)
        dst = np.searchsorted(self.ids, column("dst")).astype(np.int32)
        self.names = _names(column("src_cluster"), column("dst_cluster"))
        cluster, size = np.zeros(len(self.ids), np.int64), np.zeros(len(self.names))
        degree, own = np.zeros(len(self.ids)), np.zeros(len(self.ids), bool)
        for end, name in ((dst, "dst"), (src, "src")):
            held = np.searchsorted(self.names, column(f"{name}_cluster"))
            cluster[end], size[held] = held, column(f"{name}_size")
        degree[src], own[src] = column("degree"), True
        order = np.argsort(src, kind="stable")
        self.near, self.weight = dst[order], column("weight")[order].astype(float)
        self.start = np.searchsorted(src[order], np.arange(len(self.ids) + 1)).tolist()
        self.cluster, self.size, self.degree, self.own = cluster.tolist(), size.tolist(), degree.tolist(), own.tolist()

    def settle(self) -> None:
        """Move the nodes one after the other to their best cluster until none gains."""
        cluster, size, degree, total, start, near = self.cluster, self.size, self.degree, self.total, self.start, self.near
        waiting = list(self.own)
        queue = deque(node for node, own in enumerate(self.own) if own)
        while queue:
            node = queue.popleft()
            waiting[node] = False
            own, weight = cluster[node], degree[node]
            pulls = {own: 0.0}
            others = near[start[node] : start[node + 1]].tolist()
            for other, w in zip(others, self.weight[start[node] : start[node + 1]].tolist()):
                c = cluster[other]
                pulls[c] = pulls.get(c, 0.0) + w
            size[own] -= weight
            stay = pulls[own] - weight * size[own] / total
            gain, best = max((pull - weight * size[c] / total, -c) for c, pull in pulls.items())
            if gain > stay + NOISE * weight:
                cluster[node] = own = -best
                for other in others:
                    if self.own[other] and not waiting[other] and cluster[other] != own:
                        waiting[other] = True
                        queue.append(other)
            size[own] += weight

    def parts(self) -> np.ndarray:
        """Well-connected parts of the clusters, where the block holds all nodes: of each node one node of its part.

        Nodes that are still alone join, in turn, the part of their cluster with the
        largest gain; a part that was joined stays, so parts are connected.
        """
        degree, total, start, cluster = self.degree, self.total, self.start, self.cluster
        own = np.array(cluster)
        inside = np.repeat(own, np.diff(start)) == own[self.near]
        nodes = len(degree)
        outward = np.bincount(np.repeat(np.arange(nodes), np.diff(start)), np.where(inside, self.weight, 0.0), nodes).tolist()
        whole = np.bincount(own, degree, len(self.names)).tolist()
        part, size, members = list(range(nodes)), list(degree), [1] * nodes
        for node in range(nodes):
            rest = whole[cluster[node]]
            held = lambda p: outward[p] >= size[p] * (rest - size[p]) / total
            if members[node] != 1 or part[node] != node or not held(node):
                continue
            pulls: dict = {}
            edges = slice(start[node], start[node + 1])
            for other, w, within in zip(self.near[edges].tolist(), self.weight[edges].tolist(), inside[edges].tolist()):
                if within:
                    pulls[part[other]] = pulls.get(part[other], 0.0) + w
            options = [(pull - degree[node] * size[p] / total, -p) for p, pull in pulls.items() if p != node and held(p)]
            gain, best = max(options, default=(0.0, 0))
            if gain > NOISE * degree[node]:
                to = -best
                outward[to] += outward[node] - 2 * pulls[to]
                size[to] += size[node]
                members[to] += 1
                members[node] = 0
                part[node] = to
        return self.ids[part]


def _names(*columns: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate([np.unique(c) for c in columns]))


def _settle_block(rows: pa.Table | pd.DataFrame) -> pd.DataFrame:
    """Moves within one of several blocks: id, cluster of the nodes that moved."""
    block = _Block(rows)
    before = np.array(block.cluster)
    block.settle()
    moved = np.flatnonzero(before != np.array(block.cluster))
    return pd.DataFrame({"id": block.ids[moved], "cluster": block.names[np.array(block.cluster)[moved]]})


def _settle_whole(rows: pa.Table | pd.DataFrame) -> pd.DataFrame:
    """Clusters and their parts where one block holds the graph: id, cluster, part."""
    block = _Block(rows)
    block.settle()
    return pd.DataFrame({"id": block.ids, "cluster": block.names[block.cluster], "part": block.parts()})


def _by_block(seen: DataFrame, settle: Callable, schema: str) -> DataFrame:
    run = lambda rows: pa.Table.from_pandas(settle(rows), preserve_index=False)
    return seen.groupBy("block").applyInArrow(run, schema)


def _seen(edges: DataFrame, nodes: DataFrame, movers: DataFrame, hubs: list) -> DataFrame:
    """The edges of the moving nodes with all a block has to know of both ends; `nodes` has id, cluster, degree."""
    sizes = nodes.groupBy("cluster").agg(F.sum("degree").alias("size"))
    own = movers.join(sizes, "cluster").select(
        F.col("id").alias("src"), F.col("cluster").alias("src_cluster"), F.col("size").alias("src_size"), "degree", "block"
    )
    ends = nodes.join(sizes, "cluster").select(
        F.col("id").alias("dst"), F.col("cluster").alias("dst_cluster"), F.col("size").alias("dst_size")
    )
    return inner_join(ends, edges.join(own, "src"), "dst", hot=hubs)


def settled_whole(edges: DataFrame, nodes: DataFrame, total: float) -> DataFrame:
    """Clusters and parts of a graph of at most BLOCK_EDGES edges, from those of `nodes` on: id, part, cluster, degree."""
    movers = nodes.withColumn("block", F.lit(0))
    seen = _seen(edges, nodes, movers, []).withColumn("total", F.lit(total))
    found = _by_block(seen, _settle_whole, "id bigint, cluster bigint, part bigint")
    found = found.select("id", F.col("cluster").alias("to"), "part")
    # nodes without an edge to another are not in the block
    placed = nodes.join(found, "id", "left")
    return materialize(placed.select("id", F.coalesce("part", "id").alias("part"), F.coalesce("to", "cluster").alias("cluster"), "degree"), "parts")


def settled(edges: DataFrame, whole: DataFrame, nodes: DataFrame, total: float, blocks: int) -> DataFrame:
    """Clusters of a larger graph after rounds of moves, as long as modularity rises: id, cluster, degree.

    Nodes fall to blocks of bounded size, of which half move at a time, each in turn
    within.  After its first turn only a node moves whose neighbourhood has
    changed (the frontier).  `whole` are the edges with loops, `edges` those without.
    """
    hubs = hot_keys(edges, "dst", HUB_SHARE)
    heavy = edges.groupBy("src").agg(F.count("*").alias("n")).where(F.col("n") > HUB_EDGES).select(F.col("src").alias("id"), F.lit(True).alias("heavy"))
    state = nodes.join(heavy, "id", "left").select("*", F.col("heavy").isNull().alias("active"))
    state = materialize(state.select("id", "cluster", "degree", F.coalesce("heavy", F.lit(False)).alias("heavy"), "active"), "labels")
    best, number = nodes, 0
    score = modularity(whole, best, hubs).first()["modularity"]
    block = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(blocks))
    while True:
        turn = F.pmod(F.xxhash64(block, F.lit(number // 2)) + F.lit(number), F.lit(2)) == 0
        movers = state.where(F.col("active") & turn).select("id", "cluster", "degree", block.alias("block"))
        seen = _seen(edges, state.select("id", "cluster", "degree"), movers, hubs).withColumn("total", F.lit(total))
        moved = materialize(_by_block(seen, _settle_block, "id bigint, cluster bigint"), "moved")
        touched = edges.join(moved.select(F.col("id").alias("src")), "src", "left_semi").select(F.col("dst").alias("id")).distinct()
        after = state.join(moved.select("id", F.col("cluster").alias("to")), "id", "left").join(
            touched.withColumn("touched", F.lit(True)), "id", "left"
        )
        waits = (F.col("active") & ~turn) | F.coalesce("touched", F.lit(False))
        state = materialize(
            after.select("id", F.coalesce("to", "cluster").alias("cluster"), "degree", "heavy", (waits & ~F.col("heavy")).alias("active")), "labels"
        )
        reached = modularity(whole, state, hubs).first()["modularity"]
        number += 1
        if reached > score + NOISE:
            best, score = state, reached
        elif number % 2 == 0:  # both halves had their turn
            break
        if not state.where("active").limit(1).count():
            break
    return best.select("id", "cluster", "degree")


def _grown(inside: DataFrame, parts: DataFrame, total: float, number: int) -> DataFrame:
    """Parts after single nodes of one half joined a neighbouring part that stays: id, part, cluster, degree.

    The other half and parts of several nodes stay.  Both sides have to be well
    connected to the rest of their cluster, and the join has to gain.
    """
    ends = inside.join(parts.select(F.col("id").alias("src"), F.col("part").alias("a")), "src").join(
        parts.select(F.col("id").alias("dst"), F.col("part").alias("b")), "dst"
    )
    across = ends.where("a <> b")
    outward = across.groupBy(F.col("a").alias("part")).agg(F.sum("weight").alias("outward"))
    clusters = parts.groupBy("cluster").agg(F.sum("degree").alias("whole"))
    sums = parts.groupBy("part", "cluster").agg(F.sum("degree").alias("size"), F.count("*").alias("members"))
    sized = sums.join(clusters, "cluster").join(outward, "part")
    held = sized.where(F.col("outward") >= F.col("size") * (F.col("whole") - F.col("size")) / total)
    moves = (F.col("members") == 1) & (F.pmod(F.xxhash64("part", F.lit(number // 2)) + F.lit(number), F.lit(2)) == 0)
    pulls = across.groupBy(F.col("src").alias("id"), F.col("a").alias("part"), F.col("b").alias("near")).agg(F.sum("weight").alias("pull"))
    leaving = held.where(moves).select("part", F.col("size").alias("own"))
    joining = held.where(~moves).select(F.col("part").alias("near"), F.col("size").alias("other"))
    options = pulls.join(leaving, "part").join(joining, "near")
    gain = F.col("pull") - F.col("own") * F.col("other") / total
    chosen = options.withColumn("gain", gain).where(F.col("gain") > F.col("own") * NOISE).groupBy("id").agg(
        F.max_by("near", F.struct(F.round("gain", 9), -F.col("near"))).alias("to")
    )
    return parts.join(chosen, "id", "left").select("id", F.coalesce("to", "part").alias("part"), "cluster", "degree")


def refined(edges: DataFrame, nodes: DataFrame, total: float) -> DataFrame:
    """Connected, well-connected parts of the clusters of a larger graph: id, part (one of its nodes), cluster, degree.

    Whoever is joined stays, so no part falls apart.
    """
    own = nodes.select(F.col("id").alias("src"), F.col("cluster").alias("a"))
    other = nodes.select(F.col("id").alias("dst"), F.col("cluster").alias("b"))
    inside = materialize(edges.join(own, "src").join(other, "dst").where("a = b").select("src", "dst", "weight"), "inside")
    parts = nodes.withColumn("part", F.col("id")).select("id", "part", "cluster", "degree")
    for number in range(REFINE_ROUNDS):
        parts = materialize(_grown(inside, parts, total, number), "parts")
    return parts


def _connected(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Clusters split into their connected pieces, by the least label along their own edges."""
    own = labels.select(F.col("id").alias("src"), F.col("cluster").alias("a"))
    other = labels.select(F.col("id").alias("dst"), F.col("cluster").alias("b"))
    inside = materialize(edges.join(own, "src").join(other, "dst").where("a = b").select("src", "dst"), "inside")
    pieces = materialize(labels.select("id", F.col("id").alias("piece")), "pieces")
    while True:
        near = inside.join(pieces.withColumnRenamed("id", "dst"), "dst").groupBy(F.col("src").alias("id")).agg(F.min("piece").alias("least"))
        joined = pieces.join(near, "id", "left").withColumn("to", F.least("piece", F.coalesce("least", "piece")))
        # then along the label's own label, which halves the way left to go
        jump = joined.select(F.col("id").alias("to"), F.col("to").alias("further"))
        after = materialize(joined.join(jump, "to").select("id", F.col("further").alias("piece"), (F.col("further") < F.col("piece")).alias("changed")), "pieces")
        if not after.where("changed").limit(1).count():
            return after.select("id", F.col("piece").alias("cluster"))
        pieces = after.select("id", "piece")


def cluster_graph(edges: DataFrame) -> DataFrame:
    """Communities of a symmetric edge table (src, dst, weight) of whole-number ids by modularity: (id, cluster).

    Clusters are connected and named by their smallest node.  Levels follow until every
    cluster is one part; where refinement finds nothing more to join, clusters
    are split into their connected pieces, which never lowers modularity.  Every step
    is written, so lineage stays short.
    """
    degrees = edges.groupBy(F.col("src").alias("id")).agg(F.sum("weight").alias("degree"))
    nodes = materialize(degrees.select("id", F.col("id").alias("cluster"), "degree"), "nodes")
    found = nodes.select("id", F.col("id").alias("node"))
    while True:
        sums = edges.agg(F.sum("weight").alias("total"), F.count_if(F.col("src") != F.col("dst")).alias("apart")).first()
        apart, total = edges.where("src <> dst"), float(sums["total"] or 1.0)
        blocks = -(-sums["apart"] // BLOCK_EDGES)
        if blocks > 1:
            parts = refined(apart, settled(apart, edges, nodes, total, blocks), total)
        else:
            parts = settled_whole(apart, nodes, total)
        counts = parts.agg(F.count("*").alias("nodes"), F.count_distinct("part").alias("parts"), F.count_distinct("cluster").alias("clusters")).first()
        if counts["clusters"] == counts["nodes"]:
            labels = parts.select("id", "cluster")
            break
        if counts["parts"] == counts["nodes"]:
            labels = _connected(edges, parts.select("id", "cluster"))
            break
        own = parts.select(F.col("id").alias("src"), F.col("part").alias("a"))
        other = parts.select(F.col("id").alias("dst"), F.col("part").alias("b"))
        merged = edges.join(own, "src").join(other, "dst").groupBy(F.col("a").alias("src"), F.col("b").alias("dst"))
        edges = materialize(merged.agg(F.sum("weight").alias("weight")), "edges")
        # one written table of nodes a level, from which their names are put together at the end
        found = found.join(parts.select(F.col("id").alias("node"), "part"), "node").select("id", F.col("part").alias("node"))
        nodes = parts.groupBy(F.col("part").alias("id")).agg(F.min("cluster").alias("cluster"), F.sum("degree").alias("degree"))
        nodes = materialize(nodes, "nodes")
    placed = found.join(labels.select(F.col("id").alias("node"), "cluster"), "node").select("id", "cluster")
    names = placed.groupBy("cluster").agg(F.min("id").alias("name"))
    return materialize(placed.join(names, "cluster").select("id", F.col("name").alias("cluster")), "clusters")
