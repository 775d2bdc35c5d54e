"""File round trips: what is written to the shared folder is read back as the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.dates import month_text
from millrace.plans import flows
from millrace.plans.counting import MATRIX_SQL, stored_matrix
from millrace.plans.registry import bound, fixed, fixed_sql
from millrace.sources import files, generators, matrix_market
from millrace.sources.storage import materialize, scratch_path
from millrace.sources.tables import table


@bound("scan_csv_roundtrip", "SELECT * FROM customer")
def scan_csv_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    files.write_csv(table(spark, root, "customer"), path)
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return files.read_csv(spark, path, schema)


def write_series(spark: SparkSession, root: str, path: str) -> None:
    """Orders as JSON lines of nested pairs; those of one status have no series_id."""
    pair = F.array(month_text(F.col("o_orderdate")), F.col("o_totalprice").cast("string"))
    status = F.col("o_orderstatus")
    table(spark, root, "orders").select(
        F.when(status != "F", F.concat(F.lit("S."), status)).alias("series_id"),
        F.col("o_orderpriority").alias("name"),
        F.array(pair).alias("data"),
    ).write.json(path)


@bound(
    "scan_jsonl",
    """
    SELECT CASE WHEN o_orderstatus <> 'F' THEN 'S.' || o_orderstatus END AS series_id,
           o_orderpriority AS name, strftime(o_orderdate, '%Y%m') AS yyyymm, o_totalprice AS value
    FROM orders
    """,
)
def scan_jsonl(spark: SparkSession, root: str) -> DataFrame:
    """Records with nested pairs; some lack the series_id key altogether."""
    path = scratch_path(spark, "jsonl")
    write_series(spark, root, path)
    records = files.read_json_lines(
        spark, path, "series_id string, name string, data array<array<string>>"
    )
    return files.series_pairs(records)


@bound(
    "scan_dir_filename",
    """
    SELECT 'segment=' || c_mktsegment AS folder, count(*) AS n, round(sum(c_acctbal), 2) AS total, true AS named
    FROM customer GROUP BY 1
    """,
)
def scan_dir_filename(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "folders")
    customers = table(spark, root, "customer").select("c_custkey", "c_acctbal", F.col("c_mktsegment").alias("segment"))
    files.write_by_month(customers, path, "segment", "parquet")
    read = spark.read.schema("c_custkey bigint, c_acctbal double, segment string").parquet(path)
    return files.with_file_name(read).groupBy("folder").agg(
        F.count("*").alias("n"),
        F.round(F.sum("c_acctbal"), 2).alias("total"),
        F.bool_and(F.col("file_name").rlike(r"^part-[^/]+\.parquet$") & F.endswith("file_path", "file_name")).alias("named"),
    )


@bound(
    "binary_labels",
    "SELECT 'lang=' || lang AS label, sum(strlen(text) + 1)::BIGINT AS bytes FROM documents GROUP BY 1",
)
def binary_labels(spark: SparkSession, root: str) -> DataFrame:
    """Files of folder/label/file as bytes, labelled by their folder."""
    path = scratch_path(spark, "clips")
    table(spark, root, "documents").select("text", "lang").write.partitionBy("lang").text(path)
    read = files.read_labelled_binaries(spark, path, "part-*")
    # as many bytes as the listing says
    return read.groupBy("label").agg(F.sum(F.octet_length("content")).cast("bigint").alias("bytes"))


@bound(
    "series_months",
    f"""
    WITH s AS (
      SELECT CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'part' END AS dataset, 'S.' || o_orderstatus AS series_id,
             o_orderpriority AS name, month(o_orderdate) AS m, o_totalprice AS v
      FROM orders WHERE o_orderstatus <> 'F')
    SELECT dataset, series_id, name, {', '.join(f"{fixed_sql(f'avg(v) FILTER (WHERE m = {m})', 3)} AS m{m}" for m in range(1, 13))}
    FROM s GROUP BY 1, 2, 3
    """,
)
def series_months(spark: SparkSession, root: str) -> DataFrame:
    """The series path whole: JSON lines, a pattern on an id that may be missing, pairs, monthly means, pivot."""
    path = scratch_path(spark, "series")
    write_series(spark, root, path)
    wide = flows.weather(spark, path, {"open": r"^S\.O$", "part": r"^S\.P"}, digits=8)
    return wide.withColumns({f"m{m}": fixed(f"m{m}", 3) for m in range(1, 13)})


@bound(
    "partitioned_roundtrip",
    """
    SELECT strftime(o_orderdate, '%Y%m') AS yyyymm, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders WHERE strftime(o_orderdate, '%Y%m') >= '199801' GROUP BY 1
    """,
)
def partitioned_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "months")
    orders = table(spark, root, "orders").select(
        "o_orderkey", "o_totalprice", month_text(F.col("o_orderdate")).alias("yyyymm")
    )
    files.write_by_month(orders, path, "yyyymm")
    kept = files.read_months(
        spark, path, "o_orderkey bigint, o_totalprice double, yyyymm string", "yyyymm", "199801"
    )
    return kept.groupBy("yyyymm").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@bound(
    "mtx_long",
    f"WITH {MATRIX_SQL} SELECT cell::VARCHAR AS cell, gene, value FROM m",
)
def mtx_long(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "matrix")
    matrix_market.write_matrix(stored_matrix(spark, root), path)
    return matrix_market.read_matrix(spark, path)


@bound("manifest_explode", "SELECT concat(doc_id::VARCHAR, '.txt') AS file, md5(text) AS md5 FROM documents")
def manifest_explode(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "manifests")
    plan = table(spark, root, "documents").select(
        "doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file"), F.md5("text").alias("md5")
    )
    files.write_manifests(plan, path, F.expr("doc_id div 1000"))
    return files.read_manifest(spark, path)


@bound(
    "doc_lines",
    """
    SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
    GROUP BY line
    """,
)
def doc_lines(spark: SparkSession, root: str) -> DataFrame:
    """Documents stored as text files and scanned line by line."""
    path = scratch_path(spark, "lines")
    lines = table(spark, root, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    lines.write.option("lineSep", "\n").text(path)
    read = spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"))
    return read.groupBy("line").agg(F.count("*").alias("n"))


@bound("gzip_sizes")
def gzip_sizes(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents").select("doc_id", F.encode("text", "UTF-8").alias("payload"))
    return files.compressed_sizes(documents, "doc_id", "payload")


@bound("gzip_roundtrip", "SELECT doc_id, strlen(text) AS bytes, md5(text) AS md5 FROM documents")
def gzip_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """Whole texts through a gzip sink and back."""
    path = scratch_path(spark, "gzip")
    documents = table(spark, root, "documents").select("doc_id", "text")
    documents.write.option("compression", "gzip").json(path)
    read = spark.read.schema("doc_id bigint, text string").json(path)
    return read.select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"), F.md5("text").alias("md5"))


@bound("month_listing", "SELECT DISTINCT strftime(o_orderdate, '%Y%m') AS yyyymm FROM orders ORDER BY 1")
def month_listing(spark: SparkSession, root: str) -> DataFrame:
    """Months of a partitioned folder, listed from folder names."""
    path = scratch_path(spark, "listing")
    orders = table(spark, root, "orders").select("o_orderkey", month_text(F.col("o_orderdate")).alias("yyyymm"))
    files.write_by_month(orders, path, "yyyymm", "csv")
    read = spark.read.schema("o_orderkey bigint, yyyymm string").csv(path)
    return read.select("yyyymm").distinct().orderBy("yyyymm")


@bound(
    "gen_transactions",
    f"""
    WITH u AS (
      SELECT c_custkey, ((('0x' || substr(md5('n:7:' || c_custkey::VARCHAR), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS un
      FROM customer),
    m AS (SELECT c_custkey, (1 + floor(-3.0 * ln(un)))::BIGINT AS many FROM u),
    r AS (SELECT c_custkey, many, sum(many) OVER (ORDER BY c_custkey) - many AS before FROM m),
    t AS (SELECT c_custkey, before, unnest(range(0, many)) AS i FROM r),
    d AS (
      SELECT *, ((('0x' || substr(md5(concat('r:7:', c_custkey, ':', i)), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS ur,
             ((('0x' || substr(md5(concat('a:7:', c_custkey, ':', i)), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS ua
      FROM t)
    SELECT (100000 + before + i)::BIGINT AS "TransactionId", c_custkey AS "CustomerId",
           {fixed_sql('200 * sqrt(-2 * ln(ur)) * cos(2 * pi() * ua)')} AS "Amount"
    FROM d
    """,
)
def gen_transactions(spark: SparkSession, root: str) -> DataFrame:
    made = generators.transactions(table(spark, root, "customer"), "c_custkey")
    return made.withColumn("Amount", fixed("Amount"))


@bound(
    "intermediate_roundtrip",
    """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n, max(o_orderdate) AS last FROM orders GROUP BY 1, 2
    """,
)
def intermediate_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """A stored intermediate read back with its types."""
    summary = table(spark, root, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n"), F.max("o_orderdate").alias("last")
    )
    return materialize(summary, "summary")
