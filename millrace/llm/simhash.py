"""Near-duplicates by SimHash, found through deletion-variant signatures.

Two prints that differ in at most two bits agree, up to one bit, on one of two
32-bit halves.  So each print is indexed under every half with one bit wiped
out (64 rows), and prints that meet under an equal signature are verified.
Most signatures have one print and end in the aggregate that finds them; one
with two prints is a candidate pair.  Signatures with more prints are not
expanded into pairs: their prints meet again under all prints one bit away, of
which at most 65 can share one, and any two of those are linked by definition.
The work is linear in the number of different prints whatever their groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from millrace.llm.common import map_batches, texts_of
from millrace.llm.components import components
from millrace.sources.storage import materialize

SHINGLE = 3
SEED = 42
_BLOCK = 1 << 16  # shingles whose bits are held at once


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of an already lower-cased text; 0 without words."""
    words = text.encode().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts + lengths
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _BLOCK):
        spans = zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.int64)[0])


def _print_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    lowered = texts_of(pc.ascii_lower(batch.column("text")))
    prints = pa.array([fingerprint(t) for t in lowered], pa.int64())
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), prints], ["doc_id", "print"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `print` (signed 64 bits) per row; a missing text has print 0."""
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(chosen, _print_batch, "doc_id long, print long")


def links(prints: DataFrame) -> DataFrame:
    """Pairs (a < b) of different prints, at most two bits apart, that connect all such pairs.

    `prints` has one row per different print.  Every pair of prints within two
    bits is either a row or joined through a third print within two bits of both.
    """
    bit = F.explode(F.sequence(F.lit(0), F.lit(63)))
    variants = prints.select("print", bit.alias("wild")).select(
        "print",
        # the half that holds the wiped bit, behind the number of that bit
        F.expr(
            "shiftleft(cast(wild as bigint), 32) | (shiftrightunsigned("
            "print & ~shiftleft(1L, wild), if(wild < 32, 0, 32)) & 4294967295L)"
        ).alias("signature"),
    )
    # dealt once: the counts and the look-up of crowded signatures read the same exchange
    dealt = variants.repartition("signature")
    shared = dealt.groupBy("signature").agg(
        F.count(F.lit(1)).alias("n"), F.min("print").alias("a"), F.max("print").alias("b")
    )
    crowded = shared.where("n > 2").select("signature").hint("shuffle_hash")
    # an inner join on single signatures; a semi join would move below the exchange
    meeting = dealt.join(crowded, "signature").select("print", F.lit(None).cast("long").alias("other"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2
    met = shared.where((F.col("n") == 2) & near).select(F.col("a").alias("print"), F.col("b").alias("other"))
    met = materialize(met.union(meeting).distinct(), "meetings")
    pairs = met.where("other is not null").select(F.col("print").alias("a"), F.col("other").alias("b"))
    meeting = met.where("other is null").select("print")
    centres = meeting.select(
        "print", F.explode(F.expr("concat(array(print), transform(sequence(0, 63), i -> print ^ shiftleft(1L, i)))")).alias("centre")
    )
    # at most 65 prints share a centre
    low = F.min("print").over(Window.partitionBy("centre"))
    stars = centres.select(low.alias("a"), F.col("print").alias("b")).where("a < b")
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `print`, `component_id` per row: the smallest id linked to the row, itself included.

    Rows link when their prints differ in at most two bits, and so do all rows
    without words, whose print is 0 (null, empty and blank texts).  Rows without
    an id belong to components but never name one; a component of such rows only
    has a null name.  Repeated rows each get their row.  An empty table gives
    none.  Other columns are not read.
    """
    table = materialize(fingerprints(docs, id_col, text_col), "prints")
    first = materialize(table.groupBy("print").agg(F.min("doc_id").alias("first_id")), "first-ids")
    roots = components(links(first.select("print")))
    rooted = first.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(names, "root").select("print", "component_id")
    return table.join(named, "print").select("doc_id", "print", "component_id")


def hex_print(column: str = "print"):
    """A print as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")
