"""Corpus-wide line dedup with keep bitmaps.

Lines become 128-bit hashes of their keys.  The hashes are range-partitioned
with the document and the position as secondary sort, so a line that a third of
the rows hold spans many tasks; each task streams its sorted rows and knows the
first holder of every hash but the one its range begins with.  What neighbouring
ranges share is two rows per task.  The result is a compressed bitmap per
document, never text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import map_batches, stand_in_id, texts_of
from millrace.sources.storage import materialize

MIN_CODE_POINTS = 10
LAYOUT = "hi long, lo long, id long, sig long, pos int"
DROPPED, OPEN, EDGE = 0, 1, 2


def _explode_lines(least: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hi, lo, at, row = [], [], [], []
        for i, text in enumerate(texts_of(batch.column("text"))):
            for pos, line in enumerate(text.encode().split(b"\n")):
                key = line.strip().lower()
                if len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least):
                    digest = xxhash.xxh3_128_intdigest(key)
                    hi.append(digest >> 64)
                    lo.append(digest & 0xFFFFFFFFFFFFFFFF)
                    at.append(pos)
                    row.append(i)
        taken = np.array(row, np.int64)
        columns = [np.array(hi, np.uint64).view(np.int64), np.array(lo, np.uint64).view(np.int64)]
        columns += [batch.column(c).to_numpy(zero_copy_only=False)[taken] for c in ("id", "sig")]
        arrays = [pa.array(c) for c in [*columns, np.array(at, np.int32)]]
        return pa.RecordBatch.from_arrays(arrays, ["hi", "lo", "id", "sig", "pos"])

    return work


def _stream_holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First holder of each hash of a sorted range: dropped rows, rows of the range's first hash that stay open, edges."""
    names = ["hi", "lo", "id", "sig", "pos", "holder", "kind"]

    def rows(columns, holder, kind):
        arrays = [*columns, holder, np.full(len(holder), kind, np.int8)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)

    opening = last = None  # (hi, lo, first holder)
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        hi, lo, ids = columns[:3]
        new = np.ones(len(hi), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        holder = ids[np.maximum.accumulate(np.where(new, np.arange(len(hi)), 0))]
        if last and (hi[0], lo[0]) == last[:2]:
            joined = np.cumsum(new) == 1
            holder = np.where(joined, last[2], holder)
        if opening is None:
            opening = (hi[0], lo[0], holder[0])
        last = (hi[-1], lo[-1], holder[-1])
        dropped = ids != holder
        unsure = ~dropped & (hi == opening[0]) & (lo == opening[1])
        for chosen, kind in ((dropped, DROPPED), (unsure, OPEN)):
            if chosen.any():
                yield rows([c[chosen] for c in columns], holder[chosen], kind)
    if opening:
        edges = [opening] if opening[:2] == last[:2] else [opening, last]
        key = [np.array([e[k] for e in edges], np.int64) for k in (0, 1)]
        blank = np.zeros(len(edges), np.int64)
        yield rows([*key, blank, blank, blank.astype(np.int32)], np.array([e[2] for e in edges], np.int64), EDGE)


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_CODE_POINTS) -> DataFrame:
    """`id`, `sig`, `pos` of every line that a document with a smaller id holds too.

    `id` is the row's id (or its stand-in) and `sig` a hash of its text.
    """
    chosen = docs.select(
        stand_in_id(id_col, text_col).alias("id"),
        F.xxhash64(text_col).alias("sig"),
        F.col(text_col).cast("string").alias("text"),
    )
    lines = map_batches(chosen, _explode_lines(least), LAYOUT)
    order = ["hi", "lo", "id", "pos", "sig"]
    laid = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    found = materialize(laid.mapInArrow(_stream_holders, f"{LAYOUT}, holder long, kind byte"), "holders")
    # at most two rows per range
    edges = found.where(F.col("kind") == EDGE).groupBy("hi", "lo").agg(F.min("holder").alias("first"))
    unsure = found.where(F.col("kind") == OPEN).join(F.broadcast(edges), ["hi", "lo"]).where("id != first")
    return found.where(F.col("kind") == DROPPED).select("id", "sig", "pos").union(unsure.select("id", "sig", "pos"))


def _bitmap_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    keeps, counts = [], []
    for positions in batch.column("gone").to_pylist():
        gone = np.unique(np.array(positions, np.int64))
        keep = np.ones((int(gone[-1]) // 8 + 1) * 8, np.uint8)
        keep[gone] = 0
        counts.append(len(gone))
        keeps.append(zlib.compress(np.packbits(keep, bitorder="little").tobytes()))
    arrays = [batch.column("id"), batch.column("sig"), pa.array(counts, pa.int64()), pa.array(keeps, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["id", "sig", "n_dropped", "keep"])


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_CODE_POINTS) -> DataFrame:
    """`id`, `sig`, `n_dropped`, `keep` of every document that loses lines.

    `keep` is a zlib-compressed bitmap, first line in the lowest bit of the first
    byte; lines beyond it stay.  A line's key is the line without ASCII white
    space at its ends and in ASCII lower case; keys of fewer than `least` code
    points are never dropped.  A list of positions is never longer than the
    document it belongs to.  Null and empty texts have one empty line and lose
    nothing.  Rows that share an id are one document; a null id sorts last.
    """
    gone = dropped_lines(docs, id_col, text_col, least).groupBy("id", "sig").agg(F.collect_list("pos").alias("gone"))
    return map_batches(gone, _bitmap_batch, "id long, sig long, n_dropped long, keep binary")


def kept_text(text: str, keep: bytes | None) -> tuple[str, int]:
    """The text without its dropped lines, and how many lines it had."""
    lines = text.split("\n")
    if keep is None:
        return text, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), bitorder="little")
    return "\n".join(line for i, line in enumerate(lines) if i >= len(bits) or bits[i]), len(lines)


def _apply_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts, keeps = batch.column("__text").to_pylist(), batch.column("__keep").to_pylist()
    done = [kept_text(t or "", k) for t, k in zip(texts, keeps)]
    arrays = [*batch.columns[:-2], pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())]
    return pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-2], "__text", "__lines"])


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_CODE_POINTS) -> DataFrame:
    """All rows and columns of `docs`, with `__text` (the lines that stay), `__lines` and `__dropped` beside them.

    Repeated rows are treated alike.  A line found in two documents stays only
    in the one with the smallest id, with all its repeats there.
    """
    bitmaps = keep_bitmaps(docs, id_col, text_col, least)
    marked = docs.withColumns(
        {"__id": stand_in_id(id_col, text_col), "__sig": F.xxhash64(text_col), "__text": F.col(text_col).cast("string")}
    ).join(
        bitmaps.select(F.col("id").alias("__id"), F.col("sig").alias("__sig"), F.col("n_dropped").alias("__dropped"), F.col("keep").alias("__keep")),
        ["__id", "__sig"],
        "left",
    )
    columns = [*docs.columns, "__dropped"]
    wide = marked.select(*columns, "__text", "__keep")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wide.schema.fields[:-1])
    done = map_batches(wide, _apply_batch, f"{schema}, __lines long")
    return done.withColumn("__dropped", F.coalesce("__dropped", F.lit(0)).cast("long"))
