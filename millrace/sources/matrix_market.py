"""Sparse count matrices as coordinate text with gene and barcode lists.

A matrix folder holds `matrix.mtx`, `genes.tsv` and `barcodes.tsv`; each may be a
file or a folder of part files.  Coordinates are one-based line numbers of the
two lists, so lines are numbered by (file, offset of the block, row in the
block) without a single-task pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators.sequences import with_ordinal
from millrace.operators.splits import unique_names
from millrace.sources.storage import materialize


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return with_ordinal(lines, ["_file", "_block", "_row"], "_zero").select(
        (F.col("_zero") + 1).alias("number"), "value"
    )


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Long table (cell, gene, value); genes go by their symbol, the last column of the gene list.

    Symbols that occur for several genes are made unique in list order.
    """
    symbols = _numbered_lines(spark, f"{path}/genes.tsv").select(
        F.col("number").alias("_g"), F.element_at(F.split("value", "\t"), -1).alias("gene")
    )
    genes = unique_names(symbols, "gene", ["_g"])
    cells = _numbered_lines(spark, f"{path}/barcodes.tsv").select(
        F.col("number").alias("_c"), F.col("value").alias("cell")
    )
    lines = spark.read.text(f"{path}/matrix.mtx").select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    banner = lines.where(F.col("value").startswith("%%MatrixMarket")).select("_file").first()
    if banner is None:
        raise ValueError("no MatrixMarket banner")
    headed = F.col("_file") == banner["_file"]
    parts = F.split(F.trim("value"), r"\s+")
    # Row tags depend on how the scan was cut, so the parsed lines are written once.
    data = materialize(
        lines.where(~F.col("value").startswith("%") & (F.col("value") != "")).select(
            F.get(parts, F.lit(0)).cast("bigint").alias("_g"),
            F.get(parts, F.lit(1)).cast("bigint").alias("_c"),
            F.get(parts, F.lit(2)).cast("double").alias("value"),
            headed.alias("_headed"),
            "_block",
            "_row",
        ),
        "coordinates",
    )
    # The sizes line is the first one after the comments of the file with the banner.
    sizes = data.where("_headed").orderBy("_block", "_row").select("_block", "_row").first()
    is_sizes = F.col("_headed") & (F.col("_block") == sizes["_block"]) & (F.col("_row") == sizes["_row"])
    entries = data.where(~is_sizes).select("_g", "_c", "value")
    return entries.join(genes, "_g").join(cells, "_c").select("cell", "gene", "value")


def write_matrix(long: DataFrame, path: str) -> None:
    """The folder `read_matrix` takes, written in parallel from a long table."""
    genes = with_ordinal(long.select("gene").distinct(), ["gene"], "_g")
    cells = with_ordinal(long.select("cell").distinct(), ["cell"], "_c")
    for table, at, line, name in (
        (genes, "_g", F.concat_ws("\t", F.concat(F.lit("id"), F.col("_g") + 1), "gene"), "genes.tsv"),
        (cells, "_c", F.col("cell").cast("string"), "barcodes.tsv"),
    ):
        table.orderBy(at).select(line.alias("value")).write.text(f"{path}/{name}")
    entries = long.join(genes, "gene").join(cells, "cell")
    text = F.concat_ws(" ", F.col("_g") + 1, F.col("_c") + 1, F.col("value").cast("string"))
    entries.select(text.alias("value")).write.text(f"{path}/matrix.mtx")
    sizes = (genes.count(), cells.count(), long.count())
    header = f"%%MatrixMarket matrix coordinate real general\n%\n{sizes[0]} {sizes[1]} {sizes[2]}"
    spark = long.sparkSession
    spark.createDataFrame([(header,)], "value string").write.mode("append").text(f"{path}/matrix.mtx")
