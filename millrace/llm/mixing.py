"""Mixing sources to target weights by Pareto order sampling.

A level per source turns weights into words: sources first share all words, then
the documents of a source share its target, both with a ceiling and the excess
dealt again.  A document's share over its size is its expected number of copies:
the whole part is certain, the rest an inclusion probability.  Documents are
ranked by random odds over inclusion odds, and the ranking is taken until the
source's remaining words are filled, so the sample has a fixed size in words.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.common import map_batches, stand_in_id, texts_of
from millrace.operators.sequences import running_sums, with_ordinal
from millrace.sources.storage import materialize

CYCLE = 3  # sources weigh 1, 2, 3, 1, ...
CEILING = 3  # times a source's, and a document's, own size
LEAN = 0.5  # expected copies grow with this power of the size
SEED = 20


def _size_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes = pa.array([len(t.encode().split()) for t in texts_of(batch.column("text"))], pa.int64())
    return pa.RecordBatch.from_arrays([*batch.columns[:-1], sizes], [*batch.schema.names[:-1], "size"])


def water_levels(shares: DataFrame, group: str) -> DataFrame:
    """Per `group` the `level` at which sum(n * min(cap, level * weight)) meets the group's goal.

    `shares` has `n` members of equal `weight` and `cap` per row, and the group's
    `goal`, at most the sum of caps.  Members above their cap are set to it and
    the excess is dealt again, until no member is above; a round is one
    aggregate, and the number above only grows.
    """
    level = shares.groupBy(group).agg((F.max("goal") / F.sum(F.col("n") * F.col("weight"))).alias("level"))
    seen = None
    while True:
        level = materialize(level, "levels")
        above = F.col("level").isNull() | (F.col("level") * F.col("weight") > F.col("cap"))
        joined = shares.join(level.withColumnRenamed(group, "__g"), F.col(group).eqNullSafe(F.col("__g"))).drop("__g")
        count = joined.where(above).count()
        if count == seen or (seen is None and count == 0):
            return level
        seen = count
        spare = F.max("goal") - F.sum(F.when(above, F.col("n") * F.col("cap")).otherwise(0.0))
        weight = F.sum(F.when(above, 0.0).otherwise(F.col("n") * F.col("weight")))
        # a group whose members are all at their caps needs no level
        level = joined.groupBy(group).agg(F.when(weight > 0, spare / weight).alias("level"))


def source_targets(sized: DataFrame, ceiling: float = CEILING, cycle: int = CYCLE) -> DataFrame:
    """`source`, `source_size`, `target` for every source of `sized` (source, size)."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = with_ordinal(sources.withColumn("__last", F.col("source").isNull()), ["__last", "source"], "place")
    total = sources.agg(F.sum("source_size").cast("double")).scalar()
    shares = materialize(
        ordered.withColumns({"weight": (F.col("place") % cycle + 1).cast("double"), "one": F.lit(1)})
        .withColumn("cap", F.col("source_size") * F.lit(float(ceiling)))
        .withColumns({"n": F.lit(1.0), "goal": total})
        .drop("__last", "place"),
        "sources",
    )
    level = water_levels(shares, "one").select("level").scalar()
    share = F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))
    return shares.select("source", "source_size", share.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    ceiling: float = CEILING,
    lean: float = LEAN,
    seed: int = SEED,
) -> DataFrame:
    """`doc_id`, `sig`, `size`, `source_size`, `target`, `copies`, `taken`, one row per row of `docs`.

    Sizes are words; a null text has none and is never taken.  A null source is a
    source of its own, the last one.  Draws hash the id and the text, so reruns
    agree; ties go by id, then text.  Repeated rows are documents of their own.
    A source's words miss its target by at most half a document.
    """
    chosen = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        stand_in_id(id_col, text_col).alias("id"),
        F.xxhash64(text_col).alias("sig"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("text"),
    )
    sized = materialize(map_batches(chosen, _size_batch, "doc_id long, id long, sig long, source string, size long"), "sizes")
    targets = materialize(source_targets(sized, ceiling), "targets")
    by_source = targets.withColumnRenamed("source", "__s")
    same = F.col("source").eqNullSafe(F.col("__s"))
    size = F.col("size").cast("double")
    sizes = sized.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).cast("double").alias("n"))
    shares = materialize(
        sizes.join(by_source, same)
        .withColumns({"weight": F.pow(size, F.lit(1 + lean)), "cap": size * float(ceiling)})
        .select("source", "n", "weight", "cap", F.col("target").alias("goal")),
        "shares",
    )
    levels = targets.join(water_levels(shares, "source").withColumnRenamed("source", "__s"), same, "left").drop("__s")
    levels = levels.withColumnRenamed("source", "__s")
    expected = F.when(F.col("size") == 0, 0.0).otherwise(
        F.least(F.lit(float(ceiling)), F.coalesce(F.col("level") * F.pow(size, F.lit(lean)), F.lit(float(ceiling))))
    )
    drawn = (
        sized.join(levels, same)
        .withColumn("expected", expected)
        .drop("__s", "level")
        .withColumn("whole", F.floor(F.col("expected") + 1e-9))
        .withColumn("part", F.greatest(F.col("expected") - F.col("whole"), F.lit(0.0)))
    )
    # the upper 53 bits of a hash, moved off both ends of the unit interval
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "id", "sig"), 11) + 0.5) / float(1 << 53)
    odds = F.when(F.col("part") > 1e-9, uniform / (1 - uniform) * (1 - F.col("part")) / F.col("part"))
    entered = drawn.withColumn("odds", odds)
    lottery = running_sums(
        entered.where("odds is not null").select("id", "sig", "doc_id", "source", "size", "source_size", "target", "whole", "part", "odds"),
        ["source"],
        ["odds", "id", "sig"],
        {"filled": F.col("size")},
    )
    spare = entered.where("odds is not null").groupBy("source").agg(F.sum(F.col("part") * F.col("size")).alias("spare"))
    ranked = lottery.join(spare.withColumnRenamed("source", "__s"), same)
    won = F.when(F.col("filled") - F.col("size") / 2 <= F.col("spare"), 1).otherwise(0)
    columns = ["doc_id", "id", "sig", "size", "source_size", "target"]
    drawn_rows = ranked.select(*columns, (F.col("whole") + won).alias("copies"))
    certain = entered.where("odds is null").select(*columns, F.col("whole").alias("copies"))
    return drawn_rows.union(certain).withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
