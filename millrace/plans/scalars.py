"""Scalar, date, array and JSON functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions import arrays, codecs, dates, strings
from millrace.operators.onehot import signed_one_hot
from millrace.plans.registry import bound, fixed, fixed_sql
from millrace.sources.tables import table


@bound(
    "str_slice",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS yyyymm, strftime(o_orderdate, '%m') AS mm,
           strftime(o_orderdate, '%Y') AS yyyy,
           CASE WHEN length(o_orderkey::VARCHAR) >= 4 THEN o_orderkey::VARCHAR
                ELSE lpad(o_orderkey::VARCHAR, 4, '0') END AS padded
    FROM orders
    """,
)
def str_slice(spark: SparkSession, root: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date").cast("string")
    months = table(spark, root, "orders").select("o_orderkey", strings.year_month(day).alias("yyyymm"))
    return months.select(
        "o_orderkey",
        "yyyymm",
        F.right("yyyymm", F.lit(2)).alias("mm"),
        F.substring("yyyymm", 1, 4).alias("yyyy"),
        strings.zero_pad(F.col("o_orderkey").cast("string"), 4).alias("padded"),
    )


@bound(
    "path_parts",
    r"""
    SELECT page_id, list_extract(string_split(url, '/'), -1) AS base,
           regexp_replace(list_extract(string_split(url, '/'), -1), '\.[^.]*$', '') AS stem,
           len(string_split(url, '/'))::INTEGER AS parts
    FROM pages
    """,
)
def path_parts(spark: SparkSession, root: str) -> DataFrame:
    url = F.col("url")
    return table(spark, root, "pages").select(
        "page_id",
        strings.basename(url).alias("base"),
        strings.strip_suffix(strings.basename(url)).alias("stem"),
        F.size(F.split(url, "/")).alias("parts"),
    )


@bound(
    "path_label",
    """
    SELECT label, count(*) AS n FROM (
      SELECT list_extract(string_split(url, '/'), -2) AS label FROM pages)
    GROUP BY label
    """,
)
def path_label(spark: SparkSession, root: str) -> DataFrame:
    label = strings.parent_name(F.col("url")).alias("label")
    return table(spark, root, "pages").groupBy(label).agg(F.count("*").alias("n"))


@bound(
    "regex_bucket",
    r"""
    SELECT bucket, count(*) AS n FROM (
      SELECT regexp_replace('train' || lpad(o_orderkey::VARCHAR, 6, '0'), '(\d\d)\d\d', '\1__', 'g') AS bucket
      FROM orders)
    GROUP BY bucket
    """,
)
def regex_bucket(spark: SparkSession, root: str) -> DataFrame:
    name = F.concat(F.lit("train"), strings.zero_pad(F.col("o_orderkey").cast("string"), 6))
    bucket = strings.shard_bucket(name).alias("bucket")
    return table(spark, root, "orders").groupBy(bucket).agg(F.count("*").alias("n"))


@bound(
    "regex_extract",
    r"""
    SELECT page_id, nullif(regexp_extract(url, '[0-9]+', 0), '') AS number,
           nullif(regexp_extract(html, 'https?://[^ ]*', 0), '') AS first_url
    FROM pages
    """,
)
def regex_extract(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "pages").select(
        "page_id",
        strings.first_number(F.col("url")).alias("number"),
        strings.first_url(F.col("html")).alias("first_url"),
    )


@bound(
    "cut_translate",
    """
    SELECT event_id, CASE WHEN contains(props, ':') THEN coalesce(list_extract(string_split(props, ':'), 2), '')
                          ELSE props END AS field,
           translate(props, '"{} ', '') AS cleaned
    FROM events
    """,
)
def cut_translate(spark: SparkSession, root: str) -> DataFrame:
    props = F.col("props")
    return table(spark, root, "events").select(
        "event_id",
        strings.cut(props, ":", 2).alias("field"),
        strings.delete_characters(props, '"{} ').alias("cleaned"),
    )


@bound(
    "reshape_string",
    """
    WITH bits AS (SELECT doc_id, regexp_replace(md5(text), '[^01]', '', 'g') AS b FROM documents),
    sided AS (SELECT doc_id, b, floor(sqrt(length(b)))::BIGINT AS side FROM bits WHERE length(b) > 0)
    SELECT doc_id, i::INTEGER AS y, substr(b, (i * side + 1)::BIGINT, side) AS cells
    FROM sided, LATERAL (SELECT unnest(range(0, (ceil(length(b) / side))::BIGINT)) AS i)
    """,
)
def reshape_string(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents").select("doc_id", F.md5("text").alias("digest"))
    return documents.select("doc_id", F.posexplode(strings.grid_rows(F.col("digest"))).alias("y", "cells"))


@bound(
    "prev_month",
    """
    SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH, '%Y%m') AS previous
    FROM orders
    """,
)
def prev_month(spark: SparkSession, root: str) -> DataFrame:
    previous = dates.previous_month(dates.month_text(F.col("o_orderdate"))).alias("previous")
    return table(spark, root, "orders").select("o_orderkey", previous)


@bound(
    "calendar_days",
    """
    WITH months AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month FROM orders)
    SELECT month, unnest(generate_series(month::TIMESTAMP, last_day(month)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day
    FROM months
    """,
)
def calendar_days(spark: SparkSession, root: str) -> DataFrame:
    months = table(spark, root, "orders").select(dates.month_start(F.col("o_orderdate")).alias("month")).distinct()
    return months.select("month", F.explode(dates.month_days(F.col("month"))).alias("day"))


@bound(
    "even_second",
    """
    WITH e AS (
      SELECT event_id, date_trunc('second', ts) - to_seconds(second(ts) % 2) AS cut FROM events)
    SELECT event_id, cut, strftime(cut, '%H:%M:%S') AS clock FROM e
    """,
)
def even_second(spark: SparkSession, root: str) -> DataFrame:
    cut = table(spark, root, "events").select("event_id", dates.even_second(F.col("ts")).alias("cut"))
    return cut.withColumn("clock", dates.clock_text(F.col("cut")))


@bound(
    "math_funcs",
    f"""
    SELECT event_id, {fixed_sql('sin(2 * pi() * value)')} AS wave, {fixed_sql('sqrt(abs(value))')} AS root,
           ceil(value)::BIGINT AS up, floor(value)::BIGINT AS down, {fixed_sql('ln(1 + value)')} AS log1p,
           {fixed_sql('round(value, 1)')} AS rounded, {fixed_sql('least(greatest(value, 5.0), 50.0)')} AS clipped
    FROM events
    """,
)
def math_funcs(spark: SparkSession, root: str) -> DataFrame:
    value = F.col("value")
    return table(spark, root, "events").select(
        "event_id",
        fixed(F.sin(2 * F.pi() * value)).alias("wave"),
        fixed(F.sqrt(F.abs(value))).alias("root"),
        F.ceil(value).alias("up"),
        F.floor(value).alias("down"),
        fixed(F.log1p(value)).alias("log1p"),
        fixed(F.round(value, 1)).alias("rounded"),
        fixed(F.least(F.greatest(value, F.lit(5.0)), F.lit(50.0))).alias("clipped"),
    )


@bound(
    "onehot_signed",
    "SELECT c_custkey, "
    + ", ".join(
        f"CASE WHEN c_mktsegment = '{s}' THEN 1 ELSE -1 END AS c_mktsegment_{s}"
        for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    )
    + " FROM customer",
)
def onehot_signed(spark: SparkSession, root: str) -> DataFrame:
    customers = table(spark, root, "customer").select("c_custkey", "c_mktsegment")
    return signed_one_hot(customers, ["c_mktsegment"])


@bound(
    "onehot_index",
    """
    WITH v AS (SELECT vec_id // 10 AS video, list_distinct(list(label)) AS labels FROM embeddings GROUP BY 1)
    SELECT video, i::INTEGER AS position, list_contains(labels, i)::INTEGER AS hot
    FROM v, (SELECT unnest(range(0, 10)) AS i)
    """,
)
def onehot_index(spark: SparkSession, root: str) -> DataFrame:
    video = F.expr("vec_id div 10").alias("video")
    videos = table(spark, root, "embeddings").groupBy(video).agg(F.collect_set("label").alias("labels"))
    hot = arrays.multi_hot(F.col("labels"), 10)
    return videos.select("video", F.posexplode(hot).alias("position", "hot"))


@bound(
    "label_index",
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2
                                     WHEN 'signup' THEN 3 WHEN 'view' THEN 4 ELSE 0 END::INTEGER AS label_id
    FROM events
    """,
)
def label_index(spark: SparkSession, root: str) -> DataFrame:
    labels = ["click", "error", "purchase", "signup", "view"]
    position = arrays.label_position(F.col("event_type"), labels).cast("int").alias("label_id")
    return table(spark, root, "events").select("event_id", position)


@bound(
    "array_pad",
    f"""
    WITH p AS (SELECT vec_id, list_concat(embedding::DOUBLE[], list_transform(range(0, 36), lambda i: 0.0::DOUBLE)) AS v
               FROM embeddings)
    SELECT vec_id, len(v)::INTEGER AS width, {fixed_sql('list_sum(v)', 5)} AS total, {fixed_sql('v[64]', 5)} AS edge,
           v[100] AS last
    FROM p
    """,
)
def array_pad(spark: SparkSession, root: str) -> DataFrame:
    padded = arrays.pad_to(F.col("embedding").cast("array<double>"), 100)
    vectors = table(spark, root, "embeddings").select("vec_id", padded.alias("v"))
    add = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return vectors.select(
        "vec_id",
        F.size("v").alias("width"),
        fixed(add, 5).alias("total"),
        fixed(F.get("v", F.lit(63)), 5).alias("edge"),
        F.get("v", F.lit(99)).alias("last"),
    )


@bound(
    "array_scale",
    f"""
    WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, (generate_subscripts(embedding, 1) - 1)::INTEGER AS position
               FROM embeddings)
    SELECT vec_id, position, {fixed_sql('v * 255.0 / 255.0', 5)} AS same, {fixed_sql('v / 255.0', 7)} AS scaled FROM e
    """,
)
def array_scale(spark: SparkSession, root: str) -> DataFrame:
    vector = F.col("embedding").cast("array<double>")
    pairs = F.arrays_zip(vector.alias("same"), arrays.rescale(vector, 255.0).alias("scaled"))
    exploded = table(spark, root, "embeddings").select("vec_id", F.posexplode(pairs).alias("position", "p"))
    return exploded.select(
        "vec_id", "position", fixed("p.same", 5).alias("same"), fixed("p.scaled", 7).alias("scaled")
    )


@bound(
    "json_map",
    """
    SELECT event_id, 'k' AS name, (json_extract(props, '$.k'))::INTEGER AS value FROM events
    """,
)
def json_map(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select(
        "event_id", F.explode(codecs.json_entries(F.col("props"))).alias("name", "value")
    )


@bound(
    "json_path",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS k,
           concat('{"user":"', user_id::VARCHAR, '","type":"', event_type, '"}') AS body
    FROM events
    """,
)
def json_path(spark: SparkSession, root: str) -> DataFrame:
    body = F.to_json(F.struct(F.col("user_id").cast("string").alias("user"), F.col("event_type").alias("type")))
    return table(spark, root, "events").select(
        "event_id", codecs.json_field(F.col("props"), "k").alias("k"), body.alias("body")
    )


@bound(
    "codec_enum",
    """
    SELECT doc_id, CASE WHEN quality = 1 THEN ':)' ELSE ':(' END AS face, quality = 1 AS happy FROM labels
    """,
)
def codec_enum(spark: SparkSession, root: str) -> DataFrame:
    faces = table(spark, root, "labels").select("doc_id", codecs.flag_to_face(F.col("quality") == 1).alias("face"))
    return faces.withColumn("happy", codecs.face_to_flag(F.col("face")))


def describe(memory: str, cores: int) -> str:
    return f"{cores} cores support {memory}"


@bound(
    "typed_function",
    """
    SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN json_extract_string(props, '$.k') || ' cores support ' || event_type END AS described
    FROM events
    """,
)
def typed_function(spark: SparkSession, root: str) -> DataFrame:
    """An annotated Python function applied to text arguments, some of them missing."""
    function = codecs.typed_udf(describe)
    text = F.when(F.col("event_id") % 7 != 0, codecs.json_field(F.col("props"), "k"))
    return table(spark, root, "events").select("event_id", function(F.col("event_type"), text).alias("described"))


@bound(
    "bytes_to_floats",
    """
    WITH h AS (SELECT doc_id, hex(encode(text)) AS h, strlen(text) AS n FROM documents)
    SELECT doc_id, n::INTEGER AS width,
           coalesce(list_sum(list_transform(regexp_extract_all(h, '..'), lambda x: ('0x' || x)::BIGINT)), 0)::DOUBLE AS total
    FROM h
    """,
)
def bytes_to_floats(spark: SparkSession, root: str) -> DataFrame:
    raw = F.encode("text", "UTF-8")
    floats = table(spark, root, "documents").select("doc_id", arrays.bytes_to_floats(raw).alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return floats.select("doc_id", F.size("v").alias("width"), total.alias("total"))
