"""Shared scratch space and written intermediates.

Anything that outlives a stage is written where every executor can read it:
the folder named by `spark.checkpoint.dir`.  A machine-local folder is only
ever used with a local master, where driver and executors are one process.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder for intermediates, without a trailing slash."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError(
            "set spark.checkpoint.dir to a folder all executors share; "
            "intermediates are written there"
        )
    context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, grouped by application."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/millrace/{app}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back.

    Cuts lineage, survives executor loss, and pins anything that would change
    on recomputation (partition ids, range bounds).
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediates; call when its results have been stored elsewhere."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(f"{shared_root(spark)}/millrace/{spark.sparkContext.applicationId}")
    folder.getFileSystem(conf).delete(folder, True)
