"""File scans and sinks, always with a declared schema."""

from __future__ import annotations

import gzip
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.functions.strings import basename, parent_name


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header row; an empty field is NULL, 'NaN' a number that is not one."""
    return spark.read.schema(schema).option("header", True).option("nanValue", "NaN").csv(path)


def read_csv_columns(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """Named columns of a CSV with a header, in any order among others, cast to the given types."""
    text = spark.read.option("header", True).csv(path)
    return text.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row and no row index."""
    df.write.option("header", True).csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON record per line; absent keys are NULL, broken lines land in `_corrupt_record`."""
    return (
        spark.read.schema(f"{schema}, _corrupt_record string")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def series_pairs(records: DataFrame, pairs: str = "data") -> DataFrame:
    """Nested [[yyyymm, value], ...] records to one row per pair; values are text in the scan."""
    exploded = records.withColumn("_pair", F.explode(pairs))
    return exploded.select(
        *[c for c in records.columns if c not in (pairs, "_corrupt_record")],
        F.get("_pair", F.lit(0)).alias("yyyymm"),
        F.get("_pair", F.lit(1)).cast("double").alias("value"),
    )


def write_by_month(df: DataFrame, path: str, month: str, file_format: str = "parquet") -> None:
    """One folder per month.

    The rebalance hint gives every month few files and splits a month that is
    far larger than the others over several tasks.
    """
    df.hint("rebalance", month).write.partitionBy(month).format(file_format).save(path)


def read_months(spark: SparkSession, path: str, schema: str, month: str, start: str = "") -> DataFrame:
    """Months from `start` on; the filter prunes folders before any file is opened."""
    found = spark.read.schema(schema).parquet(path)
    return found.where(F.col(month) >= start) if start else found


def list_months(spark: SparkSession, path: str, schema: str, month: str) -> DataFrame:
    """Months present, in order, from folder names alone."""
    return spark.read.schema(schema).parquet(path).select(month).distinct().orderBy(month)


def with_file_name(df: DataFrame) -> DataFrame:
    """Rows of a file scan with the path, name and folder of the file they came from."""
    path = F.col("_metadata.file_path")
    return df.select("*", path.alias("file_path"), basename(path).alias("file_name"), parent_name(path).alias("folder"))


def read_labelled_binaries(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Binary files of folder/label/file with the label taken from the parent folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", parent_name(F.col("path")).alias("label"), "length", "content")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest files {"files": {name: md5, ...}} to rows (file, md5)."""
    text = spark.read.text(path, wholetext=True)
    manifest = F.from_json("value", "files map<string,string>")
    return text.select(F.explode(manifest["files"]).alias("file", "md5"))


def write_manifests(plan: DataFrame, path: str, bucket: Column) -> None:
    """Manifests of (file, md5) rows, one JSON text per bucket; buckets must be small."""
    entries = F.map_from_entries(F.collect_list(F.struct("file", "md5")))
    body = F.to_json(F.struct(entries.alias("files")))
    manifests = plan.groupBy(bucket.alias("_bucket")).agg(body.alias("value"))
    # One file per manifest: the reader takes a file as one document.
    manifests.write.partitionBy("_bucket").option("maxRecordsPerFile", 1).text(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"))


def compressed_sizes(df: DataFrame, key: str, payload: str, workers: int | None = None) -> DataFrame:
    """Bytes in and out of gzip level 1 per payload; `workers` tasks compress side by side."""

    def squeeze(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [len(gzip.compress(raw, 1, mtime=0)) for raw in batch["payload"]]
            yield pd.DataFrame(
                {"key": batch["key"], "in_bytes": [len(raw) for raw in batch["payload"]], "out_bytes": out}
            )

    raw = df.where(F.col(payload).isNotNull()).select(F.col(key).alias("key"), F.col(payload).alias("payload"))
    spread = raw.repartition(workers) if workers else raw
    key_type = raw.schema["key"].dataType.simpleString()
    sizes = spread.mapInPandas(squeeze, f"key {key_type}, in_bytes bigint, out_bytes bigint")
    return sizes.withColumnRenamed("key", key)


def write_gzip(df: DataFrame, path: str, workers: int) -> DataFrame:
    """Gzip text files from `workers` tasks, and the stored size of each file."""
    df.repartition(workers).write.option("compression", "gzip").text(path)
    stored = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return stored.select(basename(F.col("path")).alias("file"), F.col("length").alias("bytes"))
