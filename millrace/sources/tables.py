"""Parquet tables of a test-data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
