"""Joins, anti joins, manifests and gap tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.strings import basename, parent_name, strip_suffix
from millrace.operators import joins, primes
from millrace.plans.registry import bound
from millrace.sources.tables import table


@bound(
    "join_inner",
    """
    SELECT c_custkey AS custkey, c_name, c_mktsegment, o_orderkey, o_totalprice,
           c_acctbal AS amount_x, o_totalprice AS amount_y
    FROM customer JOIN orders ON c_custkey IS NOT DISTINCT FROM o_custkey
    """,
)
def join_inner(spark: SparkSession, root: str) -> DataFrame:
    customers = table(spark, root, "customer").select(
        F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment", F.col("c_acctbal").alias("amount")
    )
    orders = table(spark, root, "orders").select(
        F.col("o_custkey").alias("custkey"), "o_orderkey", "o_totalprice", F.col("o_totalprice").alias("amount")
    )
    return joins.inner_join(customers, orders, "custkey")


@bound(
    "batch_ranges",
    """
    WITH counted AS (SELECT count(*) AS n FROM orders),
    sized AS (SELECT n, ceil(n / ceil(n / 500.0))::BIGINT AS size FROM counted)
    SELECT start, least(start + size, n) AS "end"
    FROM sized, LATERAL (SELECT unnest(range(0, n, size)) AS start)
    """,
)
def batch_ranges(spark: SparkSession, root: str) -> DataFrame:
    return joins.batch_ranges(table(spark, root, "orders"), 500)


@bound(
    "manifest_pending",
    """
    SELECT concat(doc_id::VARCHAR, '.txt') AS file, md5(text) AS md5 FROM documents
    WHERE doc_id % 2 <> 0 OR doc_id % 10 = 0
    """,
)
def manifest_pending(spark: SparkSession, root: str) -> DataFrame:
    file = F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file")
    documents = table(spark, root, "documents")
    plan = documents.select(file, F.md5("text").alias("md5"))
    # Even files are there; every tenth one arrived damaged and has another checksum.
    stored = F.when(F.col("doc_id") % 10 == 0, F.md5(F.concat("text", F.lit("?")))).otherwise(F.md5("text"))
    done = documents.where(F.col("doc_id") % 2 == 0).select(file, stored.alias("md5"))
    return joins.pending(plan, done, ["file", "md5"])


@bound(
    "id_product",
    """
    WITH letters AS (
      SELECT i, substr('abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789', (i + 1)::BIGINT, 1) AS c
      FROM (SELECT unnest(range(0, 62)) AS i)),
    ids AS (SELECT 62 * a.i + b.i AS idx, a.c || b.c AS id FROM letters a, letters b)
    SELECT p_partkey, id, idx AS id_index,
           concat('train', lpad(idx::VARCHAR, 4, '0'), '.txt') AS file
    FROM part JOIN ids ON p_partkey % 3844 = idx
    """,
)
def id_product(spark: SparkSession, root: str) -> DataFrame:
    ids = table(spark, root, "part").select(
        "p_partkey", joins.id_text(F.col("p_partkey") % 3844).alias("id")
    )
    numbered = ids.withColumn("id_index", joins.id_index(F.col("id")).cast("bigint"))
    return numbered.withColumn("file", F.format_string("train%04d.txt", "id_index"))


@bound(
    "primes_anti",
    """
    SELECT p_partkey, p_name FROM part
    WHERE p_partkey >= 2 AND NOT EXISTS (
      SELECT 1 FROM (SELECT unnest(range(2, 1000)) AS d) WHERE d < p_partkey AND p_partkey % d = 0)
    """,
)
def primes_anti(spark: SparkSession, root: str) -> DataFrame:
    return primes.prime_rows(table(spark, root, "part").select("p_partkey", "p_name"), "p_partkey")


@bound(
    "density_check",
    """
    WITH keys AS (SELECT DISTINCT floor(s_acctbal)::BIGINT AS k FROM supplier),
    ns AS (SELECT unnest(range(25, (SELECT max(k) FROM keys))) AS n),
    bad AS (SELECT n FROM ns WHERE NOT EXISTS (SELECT 1 FROM keys WHERE n < k AND 5 * k < 6 * n))
    SELECT (SELECT max(k) FROM keys WHERE k <= n) AS below, (SELECT min(k) FROM keys WHERE k > n) AS above,
           min(n) AS first_n, max(n) AS last_n
    FROM bad GROUP BY 1, 2
    """,
)
def density_check(spark: SparkSession, root: str) -> DataFrame:
    whole = F.floor("s_acctbal").alias("k")
    return primes.sparse_ranges(table(spark, root, "supplier").select(whole), "k", 25, "nagura")


@bound(
    "prime_density",
    """
    WITH primes AS (
      SELECT p_partkey AS p FROM part
      WHERE p_partkey >= 2 AND NOT EXISTS (
        SELECT 1 FROM (SELECT unnest(range(2, 1000)) AS d) WHERE d < p_partkey AND p_partkey % d = 0)),
    ns AS (SELECT unnest(range(4, (SELECT max(p) FROM primes))) AS n)
    SELECT (SELECT count(*) FROM primes) AS primes, (SELECT count(*) FILTER (WHERE p = 2) FROM primes) AS twos,
           count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM primes WHERE n < p AND p < 2 * n - 2)) AS violators
    FROM ns
    """,
)
def prime_density(spark: SparkSession, root: str) -> DataFrame:
    found = primes.prime_rows(table(spark, root, "part").select("p_partkey"), "p_partkey")
    gaps = primes.sparse_ranges(found, "p_partkey", 4, "bertrand")
    violators = gaps.agg(F.coalesce(F.sum(F.col("last_n") - F.col("first_n") + 1), F.lit(0)).cast("bigint")).scalar()
    return found.agg(
        F.count("*").alias("primes"), F.count_if(F.col("p_partkey") == 2).alias("twos")
    ).withColumn("violators", violators)


@bound(
    "file_names",
    """
    SELECT doc_id, concat(source, '/', lang, '/', doc_id::VARCHAR, '.txt') AS path,
           doc_id::VARCHAR AS stem, lang AS label
    FROM documents
    """,
)
def file_names(spark: SparkSession, root: str) -> DataFrame:
    path = F.concat_ws("/", "source", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    parts = table(spark, root, "documents").select("doc_id", path.alias("path"))
    return parts.withColumns(
        {"stem": strip_suffix(basename(F.col("path"))), "label": parent_name(F.col("path"))}
    )
