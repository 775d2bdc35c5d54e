"""Ranked lexical search with range-maximum tables over posting lists.

Documents are indexed in shards of bounded size, in order of their ids: for every
term of the queries the places of the documents that hold it and how often.  A query
runs in each shard on its own.  Over each posting list stands a sparse table of range
maxima, so the largest impact of a term in any interval of documents is found with
two look-ups; the sum over the terms bounds every score in the interval.  Intervals
wait with their bounds; the best ones are taken first, each gives up the document
where its most promising term has its maximum, which is scored, and both remaining
sides get bounds of their own.  The search ends when no bound reaches the k-th best
score.  Intervals are taken in rounds, so that numpy treats many at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window as W, functions as F

from millrace.llm.common import give_back, smaller_batches, weighed
from millrace.operators.sequences import running_sums
from millrace.sources.storage import materialize

TOP = 20
SHARD_ROWS = 2048  # documents of a shard
SHARD_BYTES = 16 << 20  # of its texts, or one longer text
BLOCK_ITEMS = 4096  # queries that are searched together
BLOCK_BYTES = 8 << 20  # of their texts, or one longer text
ROUND = 1 << 20  # intervals times terms that a round bounds at once
DENSE = 1 << 24  # documents times terms up to which places are counted out in a table

# scoring, in thousandths
TEXT_WEIGHT, LENGTH_SHARE, SATURATION, SCALE = 100, 25, 12, 1_000_000_000

_TERM = np.zeros(256, bool)
for _first, _last in (b"09", b"AZ", b"az", (0x80, 0xFF)):
    _TERM[_first : _last + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def terms_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct terms, the number of each occurrence's term, and of its text."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    inside = _TERM[data]
    before = np.concatenate([[False], inside[:-1]])
    begins, ends = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
    bounds = np.concatenate([[0], np.cumsum(ends - begins)]).astype(np.int64)
    letters = pa.py_buffer(_LOWER[data[inside]])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(bounds), letters])
    coded = words.dictionary_encode()
    text_ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.searchsorted(text_ends, begins, "right")


# index

SHARD = "docs array<long>, lengths array<long>, terms array<binary>, starts array<int>, places array<int>, counts array<int>"


def _shard(ids: list[int | None], texts: list[bytes], wanted: dict[bytes, int]) -> list[list]:
    """One row of SHARD: documents by id (missing ids last) and the postings of the wanted terms."""
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
    names, term, text = terms_of([texts[k] for k in order])
    lengths = np.bincount(text, minlength=len(ids))
    known = np.array([name in wanted for name in names], bool)
    new_name = np.cumsum(known) - 1
    use = known[term] if len(term) else np.zeros(0, bool)
    # postings by term, then by document
    keys, counts = np.unique(new_name[term[use]].astype(np.int64) * len(ids) + text[use], return_counts=True)
    terms = [name for name, keep in zip(names, known) if keep]
    starts = np.searchsorted(keys, np.arange(len(terms) + 1, dtype=np.int64) * len(ids))
    return [[ids[k] for k in order], lengths, terms, starts, keys % max(len(ids), 1), counts]


def index(docs: DataFrame, id_col: str, text_col: str, wanted: dict[bytes, int]) -> DataFrame:
    """Shards of all documents with the postings of the wanted terms."""
    smaller_batches(docs.sparkSession)
    names = [part.split()[0] for part in SHARD.split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
    shared = docs.sparkSession.sparkContext.broadcast(wanted)  # terms of one block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in weighed(batches, "text", SHARD_ROWS, SHARD_BYTES):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            row = _shard(batch.column("id").to_pylist(), texts, shared.value)
            columns = [pa.array([pa.array(values, kind).tolist()], pa.list_(kind)) for values, kind in zip(row, types)]
            yield pa.RecordBatch.from_arrays(columns, names)
        give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SHARD)


# search


@dataclass
class Shard:
    """One shard with its impacts and the range maxima of its posting lists."""

    docs: np.ndarray  # ids, those of documents without one above all others
    missing: np.ndarray  # which documents have no id
    terms: dict[bytes, int]
    starts: np.ndarray  # of each list
    places: np.ndarray  # documents of the postings
    impacts: np.ndarray
    maxima: list[np.ndarray]  # level k: where the largest of the 2^k impacts from here stands

    def largest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Places of the largest impacts in ranges of postings; the first of equal ones; -1 in empty ranges."""
        size = high - low
        found = np.full(size.shape, -1, np.int64)
        some = size > 0
        level = np.frexp(np.maximum(size, 1).astype(float))[1] - 1
        for k in np.unique(level[some]).tolist():
            at = some & (level == k)
            one, two = self.maxima[k][low[at]], self.maxima[k][high[at] - (1 << k)]
            found[at] = np.where(self.impacts[two] > self.impacts[one], two, one)
        return found


def _maxima(impacts: np.ndarray, longest: int) -> list[np.ndarray]:
    levels = [np.arange(len(impacts), dtype=np.int32)]
    step = 1
    while 2 * step <= longest:
        one, two = levels[-1][:-step], levels[-1][step:]
        # windows that leave a list are never asked for
        levels.append(np.where(impacts[two] > impacts[one], two, one))
        step *= 2
    return levels


def length_terms(lengths: np.ndarray, documents: int, occurrences: int) -> np.ndarray:
    """The length term of each document; products beyond 64 bits are taken in whole numbers."""
    if not occurrences:
        return np.full(len(lengths), TEXT_WEIGHT - LENGTH_SHARE, np.int64)
    if int(lengths.max(initial=0)) * LENGTH_SHARE * documents < 1 << 63:
        share = (LENGTH_SHARE * documents) * lengths // occurrences
    else:
        share = np.array([LENGTH_SHARE * documents * n // occurrences for n in lengths.tolist()], np.int64)
    return TEXT_WEIGHT - LENGTH_SHARE + share


def open_shard(row: dict, documents: int, occurrences: int) -> Shard:
    """The shard of a row, with impacts under the counts of the whole table."""
    places = np.array(row["places"], np.int64)
    tf = np.array(row["counts"], np.int64)
    m = length_terms(np.array(row["lengths"], np.int64), documents, occurrences)
    impacts = SCALE * tf // (1000 * tf + SATURATION * m[places]) if len(tf) else tf
    starts = np.array(row["starts"], np.int64)
    missing = np.array([i is None for i in row["docs"]], bool)
    return Shard(
        docs=np.array([np.iinfo(np.int64).max if i is None else i for i in row["docs"]], np.int64),
        missing=missing,
        terms={name: k for k, name in enumerate(row["terms"])},
        starts=starts,
        places=places,
        impacts=impacts,
        maxima=_maxima(impacts, int(np.diff(starts).max(initial=0))),
    )


class Best:
    """The k best (score, id) so far; equal scores by id."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.docs, self.missing = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, docs: np.ndarray, missing: np.ndarray) -> None:
        scores, docs = np.concatenate([self.scores, scores]), np.concatenate([self.docs, docs])
        missing = np.concatenate([self.missing, missing])
        order = np.lexsort((docs, -scores))
        order = order[scores[order] > 0][: self.k]
        self.scores, self.docs, self.missing = scores[order], docs[order], missing[order]

    def may_enter(self, bounds: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Which bounds, held by documents from these ids on, can still change the best."""
        if len(self.scores) < self.k:
            return bounds > 0
        worst = self.scores[-1]
        return (bounds > worst) | ((bounds == worst) & (docs < self.docs[-1]))


def _ranks(shard: Shard, lists: np.ndarray):
    """A function from documents to the postings of each list before them."""
    low, high, n = shard.starts[lists], shard.starts[lists + 1], len(shard.docs)
    if len(lists) * (n + 1) <= DENSE:
        held = np.zeros((n + 1, len(lists)), np.int32)
        for k in range(len(lists)):
            held[shard.places[low[k] : high[k]] + 1, k] = 1
        held = np.cumsum(held, axis=0, dtype=np.int32)
        held += low.astype(np.int32)
        return lambda docs: held[docs]
    keys = np.repeat(np.arange(len(lists)), high - low) * n + np.concatenate([shard.places[a:b] for a, b in zip(low, high)])
    first = np.concatenate([[0], np.cumsum(high - low)])[:-1]
    at = np.arange(len(lists)) * n
    return lambda docs: np.searchsorted(keys, at + docs[:, None]) - first + low


def search(shard: Shard, query: list[tuple[bytes, int]], best: Best) -> int:
    """Bring the shard's documents among the best for weighted terms; returns how many were scored."""
    found = [(shard.terms[name], weight) for name, weight in query if name in shard.terms]
    if not found:
        return 0
    lists, weights = np.array([k for k, _ in found]), np.array([w for _, w in found], np.int64)
    ranks = _ranks(shard, lists)
    at_once = max(1, ROUND // len(lists))
    scored = 0

    def bounded(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of intervals, and the document of each where its largest part stands."""
        top = shard.largest(ranks(begin), ranks(end))
        parts = np.where(top >= 0, shard.impacts[top], 0) * weights
        lead = top[np.arange(len(begin)), parts.argmax(axis=1)]
        return parts.sum(axis=1), np.where(lead >= 0, shard.places[lead], 0)

    begin, end = np.array([0]), np.array([len(shard.docs)])
    bounds, leads = bounded(begin, end)
    while True:
        alive = best.may_enter(bounds, shard.docs[begin])
        begin, end, bounds, leads = begin[alive], end[alive], bounds[alive], leads[alive]
        if not len(begin):
            return scored
        take = np.argsort(-bounds, kind="stable")[:at_once]
        # no more than can be told apart from the rest: half of those waiting, and the best in any case
        take = take[: max(16, len(begin) // 2)]
        doc, left, right = leads[take], begin[take], end[take]
        here, after = ranks(doc), ranks(doc + 1)
        scores = (np.where(after > here, shard.impacts[np.minimum(here, len(shard.impacts) - 1)], 0) * weights).sum(axis=1)
        scored += len(doc)
        best.add(scores, shard.docs[doc], shard.missing[doc])
        rest = np.ones(len(begin), bool)
        rest[take] = False
        sides = np.concatenate([left, doc + 1]), np.concatenate([doc, right])
        some = sides[0] < sides[1]
        new_begin, new_end = sides[0][some], sides[1][some]
        new_bounds, new_leads = bounded(new_begin, new_end) if len(new_begin) else (np.zeros(0, np.int64),) * 2
        begin, end = np.concatenate([begin[rest], new_begin]), np.concatenate([end[rest], new_end])
        bounds, leads = np.concatenate([bounds[rest], new_bounds]), np.concatenate([leads[rest], new_leads])


def term_weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


def _blocks(items: DataFrame) -> Iterator[list[Row]]:
    """The queries (item, text) in blocks of bounded size; the driver holds one block at a time."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    placed = running_sums(items, [], ["item", "text"], {"count": F.lit(1), "size": size})
    # queries that begin in the same stretch of both sums are one block
    begun = F.floor((F.col("count") - 1) / BLOCK_ITEMS) + F.floor((F.col("size") - size) / BLOCK_BYTES)
    blocks = materialize(placed.select("item", "text", begun.alias("block")), "queries")
    last = blocks.agg(F.max("block")).first()[0]
    for number in range(0 if last is None else last + 1):
        block = blocks.where(F.col("block") == number).collect()
        if block:
            yield block


def _search_block(docs: DataFrame, block: list[Row], id_col: str, text_col: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    texts = [(row["text"] or "").encode() for row in block]
    names, term, text = terms_of(texts)
    shards = materialize(index(docs, id_col, text_col, dict.fromkeys(names, 0)), "postings")
    totals = shards.select(F.explode("lengths").alias("n")).agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("occurrences"))
    total = totals.collect()[0]
    documents, occurrences = total["documents"], total["occurrences"] or 0
    lists = shards.select(F.explode(F.arrays_zip("terms", F.expr("slice(starts, 1, size(terms))").alias("low"), F.expr("slice(starts, 2, size(terms))").alias("high"))).alias("t"))
    held = lists.groupBy(F.col("t.terms").alias("term")).agg(F.sum(F.expr("t.high - t.low")).alias("holders"))
    # one row per term of the block
    weights = {bytes(row["term"]): term_weight(documents, row["holders"]) for row in held.collect()}
    pairs, counts = np.unique(text.astype(np.int64) * max(len(names), 1) + term, return_counts=True)
    queries: list[list[tuple[bytes, int]]] = [[] for _ in block]
    for pair, count in zip(pairs.tolist(), counts.tolist()):
        name = names[pair % len(names)]
        if weights.get(name, 0) > 0:
            queries[pair // len(names)].append((name, count * weights[name]))
    shared = spark.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in shared.value]
        for batch in batches:
            for at in range(batch.num_rows):
                shard = open_shard(batch.slice(at, 1).to_pylist()[0], documents, occurrences)
                for query, found in zip(shared.value, best):
                    search(shard, query, found)
        for number, found in enumerate(best):
            if len(found.scores):
                n = len(found.scores)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * n), pa.array(found.docs, mask=found.missing), pa.array(found.scores)],
                    ["number", "doc_id", "score"],
                )
        give_back()

    found = shards.mapInArrow(run, "number long, doc_id long, score long")
    order = W.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # the block is as small as the driver's list of it
    items = spark.createDataFrame([(n, row["item"]) for n, row in enumerate(block)], "number long, item_id long")
    return ranked.join(F.broadcast(items), "number").select("item_id", "rank", "doc_id", "score")


def top_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The k documents that score highest for each item: item_id, rank (from 1), doc_id, score.

    Equal scores go by ascending id, documents without an id last.  Documents
    and items without text, empty or null, have no terms and appear nowhere; repeated
    documents each take a rank, repeated items each give their rows; an empty table gives no
    rows.  Very long texts make shards of their own.  Other columns are not read.
    Items are searched in blocks of bounded size, each against all documents.
    """
    item_rows = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    done = None
    for block in _blocks(item_rows):
        found = _search_block(docs, block, id_col, text_col, k)
        done = found if done is None else done.unionByName(found)
    if done is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return done
