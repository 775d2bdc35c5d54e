"""Exact substring dedup: bytes inside a 50-byte string that a smaller document id also holds.

Difference-cover suffix sorting, cut off at the depth that matters.  A suffix
array sorts sampled tuples, names them, recurses where names tie and merges the
remaining suffixes.  Here

1. the cover is chosen by content: of the tuples in a 50-byte string the one with
   the least hash is sampled, so equal strings are sampled at equal offsets (a
   cover by residues would put two thirds of all bytes into rows);
2. sampled tuples are sorted together with the name of their phrase, which is
   the whole run of 50-byte strings that share the sample; a phrase known from a
   smaller id is settled as a whole;
3. only samples with several different phrases go on: longer tuples around the
   sample are named, and samples whose longer names are unique are dropped;
4. what is still tied is merged string by string, and equal neighbours are
   compared by document.

Names are hashes of at least 64 bits.  The sort is a range partition with the id
as secondary key, so a passage that a third of all documents hold is spread over
many tasks; ranges exchange four rows each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import map_batches, release_shuffles, stand_in_id, texts_of
from millrace.sources.storage import materialize

LENGTH = 50
TUPLE = 20  # bytes of a sampled tuple
REACH = (LENGTH - TUPLE) // 2  # a shared string reaches so far from its sample on one side
BUFFER = 1 << 15  # bytes hashed at once, so that all hashes of a buffer stay in a core's cache
PARTS = 2  # the samples are sorted one part of their names after the other
SIG_BITS = 20  # of the text's hash, which tell apart rows that share an id
REMOVED, TIED, OPEN, EDGE = range(4)

_WINDOWS = LENGTH - TUPLE + 1
_PLACE = np.uint64((1 << 24) - 1)
_BYTES = np.random.default_rng(50).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
LAYOUT = "k1 long, k2 long, id long, place long"
NAMED = "name long not null, id long not null, place long not null"


def _power(k: int) -> np.uint64:
    return np.uint64(pow(int(_A), k, 1 << 64))


def _mixed(z: np.ndarray) -> np.ndarray:
    """Spread a polynomial hash over all bits; changes its argument."""
    z ^= z >> np.uint64(32)
    z *= _B
    z ^= z >> np.uint64(29)
    return z


def power_hashes(buffer: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """Polynomial hashes of every string whose length is a power of two, by doubling."""
    powers, k = {1: _BYTES[buffer]}, 1
    while 2 * k <= longest and len(powers[k]) > k:
        doubled = powers[k][:-k] * _power(k)
        doubled += powers[k][k:]
        powers[2 * k] = doubled
        k *= 2
    return powers


def gram_hashes(powers: dict[int, np.ndarray], size: int, at: np.ndarray | None = None) -> np.ndarray:
    """Polynomial hash of the strings of one size, all or those that begin at `at`; to be mixed before use."""
    n = len(powers[1]) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    value, done = None, 0
    for power in sorted(powers, reverse=True):
        if size & power:
            part = powers[power][done : done + n] if at is None else powers[power][at + done]
            value = part.copy() if value is None else value
            if done:
                value *= _power(power)
                value += part
            done += power
    return value


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        values = np.minimum(values[:-k], values[k:])
        k *= 2
    return np.minimum(values[: len(values) - (width - k)], values[width - k :]) if k < width else values


def phrases(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Phrases of the pieces [start, end) of the buffer.

    Per phrase: its piece, the first start, how many starts, the sample's offset
    from the first start, the sample's name and the phrase's name.
    """
    powers, n = power_hashes(buffer, LENGTH), len(buffer) - LENGTH + 1
    if n <= 0:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2
    tuples = gram_hashes(powers, TUPLE)
    # the upper bits of a product depend on all bits of the hash
    keyed = tuples * _B
    keyed &= ~_PLACE
    keyed |= np.arange(len(keyed), dtype=np.uint64)
    sample = (_sliding_least(keyed, _WINDOWS) & _PLACE).astype(np.int32)
    fresh = np.ones(n, bool)
    fresh[1:] = sample[1:] != sample[:-1]
    # no string reaches from one piece into the next
    valid = ends - LENGTH + 1
    fresh[starts[starts < n]] = True
    fresh[valid[(valid > 0) & (valid < n)]] = True
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], n) - 1
    piece = np.searchsorted(ends, first, side="right")
    kept = first < valid[piece]
    first, last, piece = first[kept], last[kept], piece[kept]
    at = sample[first].astype(np.int64)
    # a phrase is covered by its first and its last string
    phrase = gram_hashes(powers, LENGTH, first) * _B
    phrase += gram_hashes(powers, LENGTH, last) + (last - first).astype(np.uint64)
    return piece, first, last - first + 1, at - first, _mixed(tuples[at]), _mixed(phrase)


def _pieces(texts: list[bytes]):
    """Buffers of whole texts, long ones in overlapping pieces: (buffer, starts, ends, rows, offsets)."""
    parts, size = [], 0
    step = BUFFER - LENGTH + 1
    for row, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - LENGTH + 1), step):
            part = text[offset : offset + BUFFER]
            if len(part) < LENGTH:
                continue
            if size + len(part) > BUFFER and parts:
                yield _buffer(parts)
                parts, size = [], 0
            parts.append((row, offset, part))
            size += len(part)
    if parts:
        yield _buffer(parts)


def _buffer(parts):
    ends = np.cumsum([len(p) for _, _, p in parts])
    starts = np.concatenate([[0], ends[:-1]])
    rows, offsets = np.array([r for r, _, _ in parts]), np.array([o for _, o, _ in parts], np.int64)
    return np.frombuffer(b"".join(p for _, _, p in parts), np.uint8), starts, ends, rows, offsets


def packed(sig: np.ndarray, start: np.ndarray, count: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Signature, first start, number of starts and sample offset in one number."""
    return (sig << 44) | (start << 10) | ((count - 1) << 5) | offset


def unpacked(place: np.ndarray):
    return (place >> 10) & ((1 << 34) - 1), ((place >> 5) & 31) + 1, place & 31


def _sample_part(part: int):
    return lambda batch: _sample_batch(batch, part)


def _sample_batch(batch: pa.RecordBatch, part: int) -> pa.RecordBatch:
    """Samples whose name belongs to one part of all names."""
    texts = [t.encode() for t in texts_of(batch.column("text"))]
    ids, sigs = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "sig"))
    out = [[np.zeros(0, np.int64)] for _ in range(4)]
    for buffer, starts, ends, rows, offsets in _pieces(texts):
        piece, first, count, offset, name, phrase = phrases(buffer, starts, ends)
        mine = (name >> np.uint64(20)) % np.uint64(PARTS) == part
        piece, first, count, offset, name, phrase = (c[mine] for c in (piece, first, count, offset, name, phrase))
        row = rows[piece]
        k1 = (name & ~np.uint64(0xFFFF)) | (phrase >> np.uint64(48))
        out[0].append(k1.view(np.int64))
        out[1].append(((phrase >> np.uint64(16)) & np.uint64(0xFFFFFFFF)).view(np.int64))
        out[2].append(ids[row])
        out[3].append(packed(sigs[row], first - starts[piece] + offsets[piece], count, offset))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["k1", "k2", "id", "place"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted range that are removed, tied, or open until the neighbouring ranges are known."""

    def rows(columns, kind):
        arrays = [pa.array(np.asarray(c, np.int64)) for c in columns]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(np.full(len(arrays[0]), kind, np.int8))], ["k1", "k2", "id", "place", "kind"])

    opening = last = None  # (k1, k2, holder)
    group_first = None  # first phrase of the sample that the stream is in
    opening_last = None  # last phrase of the range's first sample
    waiting: list = []  # rows of a sample with one phrase so far
    several = False
    for batch in batches:
        if not batch.num_rows:
            continue
        k1, k2, ids, place = columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        name = k1 >> 16
        n = len(k1)
        new = np.ones(n, bool)
        new[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        other = np.ones(n, bool)
        other[1:] = name[1:] != name[:-1]
        holder = ids[np.maximum.accumulate(np.where(new, np.arange(n), 0))]
        same_sample = last is not None and (last[0] >> 16) == name[0]
        if last is not None and (k1[0], k2[0]) == last[:2]:
            holder = np.where(np.cumsum(new) == 1, last[2], holder)
            new[0] = False
        if opening is None:
            opening = (k1[0], k2[0], holder[0])
        group = np.cumsum(other) - 1
        variants = np.bincount(group, new, minlength=group[-1] + 1)
        if same_sample:
            # the phrase before the batch counts too
            variants[0] += 1
            several = several or variants[0] >= 2
            variants[0] = 2 if several else variants[0]
        elif waiting:
            if (last[0] >> 16) == (opening[0] >> 16):
                yield from (rows(w, OPEN) for w in waiting)
            waiting = []
        first_sample = name == (opening[0] >> 16)
        if first_sample.any():
            at = np.flatnonzero(first_sample)[-1]
            opening_last = (k1[at], k2[at], holder[at])
        heads = np.flatnonzero(other)
        if not same_sample or len(heads) > 1:
            at = heads[-1]
            group_first = (k1[at], k2[at], holder[at])
        gone = ids != holder
        if gone.any():
            yield rows([c[gone] for c in columns], REMOVED)
        tied = ~gone & (variants[group] >= 2)
        unsure = tied & (k1 == opening[0]) & (k2 == opening[1])
        for chosen, kind in ((tied & ~unsure, TIED), (unsure, OPEN)):
            if chosen.any():
                yield rows([c[chosen] for c in columns], kind)
        if same_sample and waiting and variants[0] >= 2:
            for w in waiting:
                first_phrase = (w[0][0], w[1][0]) == opening[:2]
                yield rows(w, OPEN if first_phrase else TIED)
            waiting = []
        ending = group == group[-1]
        if len(variants) > 1:
            lone_first = ~gone & (group == 0) & first_sample & (variants[0] < 2)
            if lone_first.any():
                yield rows([c[lone_first] for c in columns], OPEN)
            if same_sample and waiting:
                if (last[0] >> 16) == (opening[0] >> 16):
                    yield from (rows(w, OPEN) for w in waiting)
                waiting = []
            several = False
        several = bool(variants[-1] >= 2)
        if not several:
            held = ~gone & ending
            if held.any():
                waiting.append([c[held] for c in columns])
        last = (k1[-1], k2[-1], holder[-1])
    if last is not None:
        yield from (rows(w, OPEN) for w in waiting)
        edges = sorted({opening, opening_last, group_first, last})
        yield rows([[e[0] for e in edges], [e[1] for e in edges], [e[2] for e in edges], [0] * len(edges)], EDGE)


def _settled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, place) of phrases that go as a whole, and of those tied with other phrases; docs has id, sig, text."""
    order = ["k1", "k2", "id", "place"]
    parts = []
    for part in range(PARTS):
        samples = map_batches(docs.select("id", "sig", "text"), _sample_part(part), LAYOUT, 512)
        laid = samples.repartitionByRange(*order).sortWithinPartitions(*order)
        found = materialize(laid.mapInArrow(_settle, f"{LAYOUT}, kind byte"), "phrases")
        del samples, laid
        release_shuffles(docs.sparkSession)
        parts.append(_resolved(found))
    removed, tied = zip(*parts)
    return reduce(DataFrame.union, removed), reduce(DataFrame.union, tied)


def _resolved(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The removed and the tied phrases of one part, what neighbouring ranges know included."""
    # at most four rows per range
    edges = found.where(F.col("kind") == EDGE)
    holders = edges.groupBy("k1", "k2").agg(F.min("id").alias("holder"))
    phrase = F.struct("k1", "k2")
    several = edges.groupBy(F.shiftright("k1", 16).alias("name")).agg((F.min(phrase) != F.max(phrase)).alias("several"))
    unsure = (
        found.where(F.col("kind") == OPEN)
        .join(F.broadcast(holders), ["k1", "k2"], "left")
        .withColumn("name", F.shiftright("k1", 16))
        .join(F.broadcast(several), "name", "left")
    )
    lost = F.coalesce(F.col("holder") < F.col("id"), F.lit(False))
    removed = found.where(F.col("kind") == REMOVED).select("id", "place").union(unsure.where(lost).select("id", "place"))
    more = unsure.where(~lost & F.coalesce("several", F.lit(False))).select("id", "place")
    return removed, found.where(F.col("kind") == TIED).select("id", "place").union(more)


def _per_document(places: DataFrame, name: str) -> DataFrame:
    """All places of a document in one row; never more than the document has bytes."""
    sig = F.shiftrightunsigned("place", 44)
    return places.groupBy("id", sig.alias("sig")).agg(F.collect_list("place").alias(name))


def _compress_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts as compressed bytes, a third of what shuffles of plain texts move."""
    pack = zstandard.ZstdCompressor(level=1).compress
    small = pa.array([pack(t.encode()) for t in texts_of(batch.column("text"))], pa.binary())
    return pa.RecordBatch.from_arrays([*batch.columns[:-1], small], [*batch.schema.names[:-1], "packed"])


def _unpacked_texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return (unpack(t) for t in batch.column("packed").to_pylist())


def _each_place(batch: pa.RecordBatch):
    """(row, text, starts, counts, offsets, places) of every document of the batch."""
    ids = batch.column("id").to_numpy(zero_copy_only=False)
    for row, (text, places) in enumerate(zip(_unpacked_texts(batch), batch.column("places").to_pylist())):
        places = np.unique(np.array(places, np.int64))
        yield ids[row], text, places, *unpacked(places)


def _string_hashes(text: bytes, starts: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `counts` strings of one size from each start on, in that order."""
    buffer, lengths = np.frombuffer(text, np.uint8), counts + size - 1
    result, done = [], 0
    edges = np.searchsorted(np.cumsum(lengths), np.arange(BUFFER, int(lengths.sum()) + BUFFER, BUFFER)) + 1
    for edge in edges.tolist():
        some = slice(done, min(edge, len(starts)))
        if some.start >= some.stop:
            continue
        begun = np.cumsum(lengths[some]) - lengths[some]
        inside = np.arange(int(lengths[some].sum())) - np.repeat(begun, lengths[some])
        powers = power_hashes(buffer[np.repeat(starts[some], lengths[some]) + inside], size)
        wanted = np.flatnonzero(inside < np.repeat(counts[some], lengths[some]))
        result.append(_mixed(gram_hashes(powers, size, wanted)))
        done = some.stop
    return np.concatenate(result) if result else np.zeros(0, np.uint64)


def _longer_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Names of the longer tuples on either side of each tied sample, with the starts that such a tuple allows."""
    size = TUPLE + REACH
    out = [[np.zeros(0, np.int64)] for _ in range(3)]
    for own, text, places, starts, counts, offsets in _each_place(batch):
        sig, sample, last = places >> 44, starts + offsets, starts + counts - 1
        turn = sample - REACH  # starts up to here share what lies left of the sample
        left, right = turn >= starts, turn <= last
        sides = ((left, turn, starts, np.minimum(last, turn)), (right, sample, np.maximum(starts, turn), last))
        for side, (chosen, begin, first, final) in enumerate(sides):
            if chosen.any():
                names = _string_hashes(text, begin[chosen], np.ones(int(chosen.sum()), np.int64), size) ^ np.uint64(side)
                out[0].append(names.view(np.int64))
                out[1].append(np.full(len(names), own))
                out[2].append(packed(sig[chosen], first[chosen], (final - first + 1)[chosen], np.zeros(len(names), np.int64)))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["name", "id", "place"])


def _string_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Every 50-byte string of the phrases that are still tied."""
    out = [[np.zeros(0, np.int64)] for _ in range(3)]
    for own, text, places, starts, counts, _ in _each_place(batch):
        names = _string_hashes(text, starts, counts, LENGTH)
        every = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        # both sides of a sample may name the same start
        every, first = np.unique(every, return_index=True)
        single, none = np.ones(len(every), np.int64), np.zeros(len(every), np.int64)
        out[0].append(names[first].view(np.int64))
        out[1].append(np.full(len(every), own))
        out[2].append(packed(single * (places[0] >> 44), every, single, none))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], ["name", "id", "place"])


def covered(text: bytes, places: list[int] | None) -> tuple[np.ndarray, int]:
    """Mask of the bytes inside removed strings, and the number of maximal runs."""
    steps = np.zeros(len(text) + 1, np.int32)
    if places:
        starts, counts, _ = unpacked(np.array(places, np.int64))
        np.add.at(steps, starts, 1)
        np.add.at(steps, starts + counts - 1 + LENGTH, -1)
    mask = np.cumsum(steps[:-1]) > 0
    return mask, int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())


def _result_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    out = [[], [], [], []]
    texts = []
    for raw, places in zip(_unpacked_texts(batch), batch.column("places").to_pylist()):
        mask, runs = covered(raw, places)
        kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
        texts.append(kept)
        for column, value in zip(out, (len(raw), int(mask.sum()), runs, sha256(kept).hexdigest())):
            column.append(value)
    arrays = [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.string())]
    arrays.append(pa.array(texts, pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`, `kept` (bytes) per row of `docs`.

    A byte goes when a 50-byte string around it starts in a document with a
    smaller id; all strings are judged on the input.  Null, empty and shorter
    texts lose nothing.  Rows that share an id do not affect each other; rows
    without an id come after all others.  Other columns are not read.
    """
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        stand_in_id(id_col, text_col).alias("id"),
        F.xxhash64(text_col).bitwiseAND((1 << SIG_BITS) - 1).alias("sig"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    removed, tied = _settled(texts)
    by = ["id", "sig"]
    columns = ["doc_id", "id", "packed", "places"]
    # the three joins below read the same exchange of the texts
    texts = map_batches(texts, _compress_batch, "doc_id long, id long not null, sig long not null, packed binary").repartition(*by)
    longer = map_batches(texts.join(_per_document(tied, "places"), by).select(*columns), _longer_batch, NAMED, 512)
    # Named rows are dealt once; what a name has in common is looked up where its
    # rows are.  The aggregates take whole rows, so that they read the same exchange.
    row = F.struct("id", "place")
    longer = longer.repartition("name")
    shared = longer.groupBy("name").agg(F.min(row).alias("low"), F.max(row).alias("high")).where("low.id < high.id")
    # (an inner join on single names; a semi join would move below the exchange)
    still = longer.join(shared.select("name").hint("shuffle_hash"), "name").select("id", "place").distinct()
    strings = map_batches(texts.join(_per_document(still, "places"), by).select(*columns), _string_batch, NAMED, 512)
    strings = strings.repartition("name")
    firsts = strings.groupBy("name").agg(F.min(row).alias("low"), F.max(row).alias("high")).where("low.id < high.id")
    firsts = firsts.select("name", F.col("low.id").alias("holder")).hint("shuffle_hash")
    lost = strings.join(firsts, "name").where("id > holder").select("id", "place")
    places = _per_document(removed.union(lost), "places")
    return map_batches(
        texts.join(places, by, "left").select(*columns),
        _result_batch,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
        512,
    )
