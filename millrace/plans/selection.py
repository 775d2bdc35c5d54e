"""Filters, predicates and column edits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.strings import year_month
from millrace.operators import filters, grid
from millrace.operators.aggregates import rename_by_position
from millrace.plans.registry import bound, fixed, fixed_sql
from millrace.sources.storage import scratch_path
from millrace.sources.tables import table


@bound(
    "regex_filter",
    r"""
    SELECT p_partkey, p_name FROM part
    WHERE p_name IS NOT NULL AND regexp_matches(p_name, '^(red|blue)[^_]*t$')
    """,
)
def regex_filter(spark: SparkSession, root: str) -> DataFrame:
    parts = table(spark, root, "part").select("p_partkey", "p_name")
    return filters.keep_matching(parts, "p_name", r"^(red|blue)[^_]*t$")


@bound(
    "contains_filter",
    r"""
    SELECT doc_id, lang, coalesce(regexp_matches(text, 'th.r'), false) AS found
    FROM documents
    """,
)
def contains_filter(spark: SparkSession, root: str) -> DataFrame:
    found = filters.contains_pattern(F.col("text"), "th.r").alias("found")
    return table(spark, root, "documents").select("doc_id", "lang", found)


@bound(
    "first_match",
    """
    SELECT doc_id, lang, source, n_chars FROM documents
    WHERE source = 'src2' ORDER BY doc_id LIMIT 1
    """,
)
def first_match(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents").select("doc_id", "lang", "source", "n_chars")
    return filters.first_where(documents, F.col("source") == "src2", ["doc_id"])


@bound("project_drop", "SELECT c_acctbal, c_mktsegment, c_custkey FROM customer")
def project_drop(spark: SparkSession, root: str) -> DataFrame:
    customers = table(spark, root, "customer").drop("c_name", "c_nationkey")
    return customers.select("c_acctbal", "c_mktsegment", "c_custkey")


@bound(
    "ratio_features",
    f"""
    SELECT c_custkey, n_orders, {fixed_sql('c_acctbal / nullif(spent, 0)')} AS balance_by_spend,
           {fixed_sql('spent / nullif(n_orders, 0)')} AS spend_by_order
    FROM (
      SELECT c_custkey, any_value(c_acctbal) AS c_acctbal, count(o_orderkey) AS n_orders,
             coalesce(sum(o_totalprice), 0.0) AS spent
      FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
    """,
)
def ratio_features(spark: SparkSession, root: str) -> DataFrame:
    spent = table(spark, root, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("spent")
    )
    customers = (
        table(spark, root, "customer")
        .join(spent, "c_custkey", "left")
        .na.fill({"n_orders": 0, "spent": 0.0})
    )
    ratios = filters.add_ratios(
        customers,
        {"balance_by_spend": ("c_acctbal", "spent"), "spend_by_order": ("spent", "n_orders")},
    )
    return ratios.select(
        "c_custkey",
        "n_orders",
        fixed("balance_by_spend").alias("balance_by_spend"),
        fixed("spend_by_order").alias("spend_by_order"),
    )


@bound(
    "signed_flag",
    """
    SELECT doc_id, CASE WHEN quality = 0 THEN -1 ELSE quality END AS quality,
           CASE WHEN toxic = 0 THEN -1 ELSE toxic END AS toxic
    FROM labels
    """,
)
def signed_flag(spark: SparkSession, root: str) -> DataFrame:
    labels = table(spark, root, "labels")
    return labels.select(
        "doc_id",
        filters.signed(F.col("quality")).alias("quality"),
        filters.signed(F.col("toxic")).alias("toxic"),
    )


@bound(
    "drop_incomplete",
    """
    SELECT d.doc_id, d.lang, l.quality FROM documents d
    LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL
    """,
)
def drop_incomplete(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents").select("doc_id", "lang")
    labels = table(spark, root, "labels").select("doc_id", "quality")
    return filters.drop_incomplete(documents.join(labels, "doc_id", "left"))


@bound(
    "rename_category",
    """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'filled' WHEN 'O' THEN 'open'
             WHEN 'P' THEN 'partial' ELSE o_orderstatus END AS status,
           count(*) AS n
    FROM orders GROUP BY 1
    """,
)
def rename_category(spark: SparkSession, root: str) -> DataFrame:
    names = rename_by_position(["filled", "open", "partial"], ["F", "O", "P"])
    status = filters.rename_values(F.col("o_orderstatus"), names).alias("status")
    return table(spark, root, "orders").groupBy(status).agg(F.count("*").alias("n"))


@bound(
    "hash_shard",
    """
    SELECT file FROM (
      SELECT concat(doc_id::VARCHAR, '.txt') AS file, md5(concat(doc_id::VARCHAR, '.txt')) AS h
      FROM documents)
    WHERE list_reduce(
            list_transform(range(0, 8), lambda i: ('0x' || substr(h, (4*i + 1)::BIGINT, 4))::BIGINT),
            lambda a, x: (a * 65536 + x) % 7) % 7 = 2
    """,
)
def hash_shard(spark: SparkSession, root: str) -> DataFrame:
    file = F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("file")
    return filters.hash_shard(table(spark, root, "documents").select(file), "file", 3, 7)


CELLS_SQL = """
    raw AS (SELECT p_size AS x, substr(p_brand, 7)::INTEGER AS y, count(*) AS n FROM part GROUP BY 1, 2),
    box AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM raw),
    cells AS (SELECT x, y, n % 2 = 1 AS alive FROM raw),
    counted AS (
      SELECT c.x, c.y, c.alive, count(o.x)::INTEGER AS neighbors
      FROM cells c LEFT JOIN cells o
        ON o.alive AND abs(o.x - c.x) <= 1 AND abs(o.y - c.y) <= 1 AND (o.x <> c.x OR o.y <> c.y)
      GROUP BY c.x, c.y, c.alive)
"""


def part_cells(spark: SparkSession, root: str) -> DataFrame:
    """(p_size, brand number) cells, alive where the part count is odd."""
    brand = F.substring("p_brand", 7, 9).cast("int")
    counts = table(spark, root, "part").groupBy(F.col("p_size").alias("x"), brand.alias("y")).agg(
        F.count("*").alias("n")
    )
    return counts.select("x", "y", (F.col("n") % 2 == 1).alias("alive"))


@bound("stencil_neighbors", f"WITH {CELLS_SQL} SELECT x, y, alive, neighbors FROM counted")
def stencil_neighbors(spark: SparkSession, root: str) -> DataFrame:
    return grid.neighbour_counts(part_cells(spark, root)).select("x", "y", "alive", "neighbors")


RULES_SQL = """
      SELECT x, y, 'isolate' AS rule, false AS alive_next FROM counted WHERE alive AND neighbors < 2
      UNION ALL SELECT x, y, 'survive', true FROM counted WHERE alive AND neighbors IN (2, 3)
      UNION ALL SELECT x, y, 'crowd', false FROM counted WHERE alive AND neighbors > 3
      UNION ALL SELECT x, y, 'reproduce', true FROM counted WHERE NOT alive AND neighbors = 3
      UNION ALL SELECT x, y, 'ignore', false FROM counted WHERE NOT alive AND neighbors <> 3
"""


@bound("rule_classify", f"WITH {CELLS_SQL} {RULES_SQL}")
def rule_classify(spark: SparkSession, root: str) -> DataFrame:
    counted = grid.neighbour_counts(part_cells(spark, root))
    return grid.classify_cells(counted).select("x", "y", "rule", "alive_next")


@bound(
    "rule_union",
    f"WITH {CELLS_SQL}, ruled AS ({RULES_SQL}) SELECT rule, alive_next, count(*) AS n FROM ruled GROUP BY 1, 2",
)
def rule_union(spark: SparkSession, root: str) -> DataFrame:
    ruled = grid.classify_cells(grid.neighbour_counts(part_cells(spark, root)))
    return ruled.groupBy("rule", "alive_next").agg(F.count("*").alias("n"))


@bound(
    "grid_rows",
    f"""
    WITH {CELLS_SQL}, ruled AS ({RULES_SQL})
    SELECT y, string_agg(CASE WHEN alive_next THEN '1' ELSE '0' END, '' ORDER BY x) AS cells
    FROM ruled GROUP BY y
    """,
)
def grid_rows(spark: SparkSession, root: str) -> DataFrame:
    ruled = grid.classify_cells(grid.neighbour_counts(part_cells(spark, root)))
    return grid.rows_from_cells(ruled, "alive_next")


@bound(
    "grid_history",
    f"""
    WITH {CELLS_SQL}, ruled AS ({RULES_SQL})
    SELECT 0 AS tick, y, string_agg(CASE WHEN alive THEN '1' ELSE '0' END, '' ORDER BY x) AS cells FROM cells GROUP BY y
    UNION ALL
    SELECT 1, y, string_agg(CASE WHEN alive_next THEN '1' ELSE '0' END, '' ORDER BY x) FROM ruled GROUP BY y
    """,
)
def grid_history(spark: SparkSession, root: str) -> DataFrame:
    """A generation and the next one appended to a stored history."""
    path = scratch_path(spark, "history")
    cells = part_cells(spark, root)
    grid.append_generation(grid.rows_from_cells(cells), path, 0)
    ruled = grid.classify_cells(grid.neighbour_counts(cells))
    grid.append_generation(grid.rows_from_cells(ruled, "alive_next"), path, 1)
    return grid.read_history(spark, path)


@bound(
    "line_grep",
    r"""
    WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    SELECT doc_id,
           count(*) FILTER (WHERE regexp_matches(line, 'the')) AS matched,
           count(*) FILTER (WHERE NOT regexp_matches(line, 'the')) AS inverted,
           count(*) FILTER (WHERE regexp_matches(line, '(?i)license')) AS folded
    FROM lines GROUP BY doc_id
    """,
)
def line_grep(spark: SparkSession, root: str) -> DataFrame:
    lines = F.split("text", "\n")
    count = lambda keep: F.size(F.filter(lines, keep)).cast("bigint")
    return table(spark, root, "documents").select(
        "doc_id",
        count(lambda line: filters.line_matches(line, "the")).alias("matched"),
        count(lambda line: filters.line_matches(line, "the", invert=True)).alias("inverted"),
        count(lambda line: filters.line_matches(line, "license", ignore_case=True)).alias("folded"),
    )


@bound(
    "value_exclusion",
    """
    SELECT user_id, count(*) AS n FROM events
    WHERE event_type <> 'signup' GROUP BY user_id
    """,
)
def value_exclusion(spark: SparkSession, root: str) -> DataFrame:
    events = table(spark, root, "events").where(F.col("event_type") != "signup")
    return events.groupBy("user_id").agg(F.count("*").alias("n"))


@bound(
    "month_skip",
    """
    SELECT yyyymm, n FROM (
      SELECT strftime(o_orderdate, '%Y%m') AS yyyymm, count(*) AS n FROM orders GROUP BY 1)
    WHERE yyyymm > (SELECT min(strftime(o_orderdate, '%Y%m')) FROM orders) AND yyyymm >= '199606'
    """,
)
def month_skip(spark: SparkSession, root: str) -> DataFrame:
    days = F.col("o_orderdate").cast("date").cast("string")
    months = table(spark, root, "orders").select(year_month(days).alias("yyyymm"))
    first = months.agg(F.min("yyyymm")).scalar()
    kept = months.where((F.col("yyyymm") >= "199606") & (F.col("yyyymm") > first))
    return kept.groupBy("yyyymm").agg(F.count("*").alias("n"))


@bound(
    "row_slice",
    """
    SELECT o_orderkey, o_totalprice FROM (
      SELECT o_orderkey, o_totalprice,
             row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i,
             count(*) OVER () AS n
      FROM orders)
    WHERE i >= n // 4 AND i < n // 2
    """,
)
def row_slice(spark: SparkSession, root: str) -> DataFrame:
    orders = table(spark, root, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    n = orders.count()
    sliced = filters.slice_rows(orders, ["o_orderdate", "o_orderkey"], n // 4, n // 2)
    return sliced.select("o_orderkey", "o_totalprice")
