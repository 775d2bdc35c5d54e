"""The training-data pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns the next table of documents,
the last one the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import lines, mixing, packing, quality, simhash
from millrace.llm.common import stand_in_id
from millrace.sources.storage import materialize
from millrace.sources.tables import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _named(docs: DataFrame) -> DataFrame:
    """Documents with a key that names each different row: its id and its text."""
    return docs.select(*COLUMNS, stand_in_id().alias("__id"), F.xxhash64("text").alias("__sig"))


def _with_text_changed(docs: DataFrame, text) -> DataFrame:
    changed = docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return changed.select(*COLUMNS)


def reject_bad_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, unchanged."""
    return quality.keep_good(docs.select(*COLUMNS))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document with a smaller id holds too."""
    return _with_text_changed(lines.dedup_lines(docs.select(*COLUMNS)), F.col("__text"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    named = _named(docs)
    ids = named.select("__id", "text")
    groups = simhash.near_duplicates(ids, "__id", "text")
    first = groups.where("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    # rows that repeat an id are one document
    return named.join(first, "__id", "left_semi").dropDuplicates(["__id"]).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; rows with the same id and text are treated alike."""
    mixed = mixing.mix(docs).where("copies > 0")
    copies = mixed.groupBy(F.col("id").alias("__id"), F.col("sig").alias("__sig")).agg(F.max("copies").alias("__copies"))
    taken = _named(docs).join(copies, ["__id", "__sig"])
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*COLUMNS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their windows, with their token ids."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", reject_bad_quality),
    ("line dedup", drop_repeated_lines),
    ("near-dedup", keep_one_of_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

# Fingerprints, random odds and tokens are beyond SQL; tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
