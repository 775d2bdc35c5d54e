"""Windows, ordered splits, top-n and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import aggregates, splits
from millrace.operators.sequences import running_sums, with_neighbour
from millrace.plans.registry import bound
from millrace.sources.tables import table

LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@bound(
    "increment_check",
    """
    WITH pairs AS (
      SELECT l_linenumber AS second,
             lag(l_linenumber) OVER (PARTITION BY l_orderkey
               ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS first
      FROM lineitem)
    SELECT second, count(first) AS pairs, count(*) FILTER (WHERE second = first + 1) AS increments
    FROM pairs GROUP BY second
    """,
)
def increment_check(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem").select("l_orderkey", *LINE_ORDER)
    paired = with_neighbour(lines, ["l_orderkey"], LINE_ORDER, {"first": "l_linenumber"})
    second = F.col("l_linenumber").alias("second")
    return paired.groupBy(second).agg(
        F.count("first").alias("pairs"), F.count_if(F.col("l_linenumber") == F.col("first") + 1).alias("increments")
    )


@bound(
    "running_count",
    """
    SELECT event_id, user_id,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS served
    FROM events
    """,
)
def running_count(spark: SparkSession, root: str) -> DataFrame:
    events = table(spark, root, "events").select("event_id", "user_id", "ts")
    counted = running_sums(events, ["user_id"], ["ts", "event_id"], {"served": F.lit(1)})
    return counted.select("event_id", "user_id", "served")


@bound(
    "unique_names",
    """
    SELECT p_partkey, CASE WHEN r = 0 THEN p_name ELSE p_name || '-' || r::VARCHAR END AS name
    FROM (SELECT p_partkey, p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) - 1 AS r FROM part)
    """,
)
def unique_names(spark: SparkSession, root: str) -> DataFrame:
    parts = table(spark, root, "part").select("p_partkey", F.col("p_name").alias("name"))
    return splits.unique_names(parts, "name", ["p_partkey"]).select("p_partkey", "name")


@bound(
    "topn_per_group",
    """
    SELECT c_mktsegment, c_custkey, c_acctbal, rank::INTEGER AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rank FROM customer)
    WHERE rank <= 25
    """,
)
def topn_per_group(spark: SparkSession, root: str) -> DataFrame:
    customers = table(spark, root, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return aggregates.top_per_group(
        customers, ["c_mktsegment"], [F.col("c_acctbal").desc(), F.col("c_custkey").asc()], 25
    )


@bound(
    "head_tail_sample",
    """
    SELECT o_orderkey, o_totalprice FROM (
      SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS a,
             row_number() OVER (ORDER BY o_orderkey DESC) AS b FROM orders)
    WHERE a <= 3 OR b <= 3
    """,
)
def head_tail_sample(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return aggregates.head_and_tail(orders, "o_orderkey", 3)


@bound("head_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def head_n(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(5)


@bound(
    "latest_order",
    """
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
    WHERE r = 1
    """,
)
def latest_order(spark: SparkSession, root: str) -> DataFrame:
    return aggregates.last_by_key(
        table(spark, root, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"]
    )


@bound(
    "ordered_split",
    """
    SELECT o_orderkey, CASE WHEN r > n - ceil(0.2 * n) THEN 'test' ELSE 'train' END AS part FROM (
      SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r, count(*) OVER () AS n FROM orders)
    """,
)
def ordered_split(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select("o_orderkey", "o_orderdate")
    split = splits.ordered_split(orders, ["o_orderdate", "o_orderkey"], 0.2)
    return split.select("o_orderkey", "part")


@bound(
    "hash_shuffle_split",
    """
    SELECT doc_id, CASE WHEN r <= floor(0.8 * n) THEN 'train'
                        WHEN r <= floor(0.8 * n) + floor(0.1 * n) THEN 'validate'
                        WHEN r > n - floor(0.1 * n) THEN 'test' ELSE 'unused' END AS part
    FROM (SELECT doc_id, row_number() OVER (ORDER BY md5(concat('42:', doc_id::VARCHAR)), doc_id) AS r,
                 count(*) OVER () AS n FROM documents)
    """,
)
def hash_shuffle_split(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents").select("doc_id")
    return splits.shuffled_split(documents, "doc_id", 42, 0.8, 0.1, 0.1)


@bound(
    "union_all",
    """
    SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM (SELECT * FROM orders WHERE o_orderstatus = 'F'
          UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'O'
          UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'P'
          UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'F')
    GROUP BY o_orderstatus
    """,
)
def union_all(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select("o_orderstatus", "o_totalprice")
    slices = [orders.where(F.col("o_orderstatus") == s) for s in ("F", "O", "P", "F")]
    united = slices[0].unionByName(slices[1]).unionByName(slices[2])
    united = united.unionByName(slices[3].select("o_totalprice", "o_orderstatus"))
    return united.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
