"""Session construction for tests, benches and notebooks.

Operators never build a session themselves: they take the one their input
DataFrame belongs to, so a cluster's own settings stay in force.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, name: str = "millrace", **conf: str) -> SparkSession:
    """A single-JVM session sized for `cores` threads."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    partitions = 8 if cores == "*" else int(cores)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": "12g",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
