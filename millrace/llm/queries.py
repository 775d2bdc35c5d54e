"""The operators of this package on the shared tables, with their SQL oracles."""

from __future__ import annotations

import pyarrow as pa
from hashlib import sha256
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import adaptive_scan, html_blocks, lines, lm_scoring, mixing, packing, phrases, quality, ranked, secrets, simhash, suffixes, warc
from millrace.llm.common import map_batches, texts_of
from millrace.sources.storage import scratch_path
from millrace.sources.tables import table

QUERIES = {}
ORACLES = {}


def query(key: str, sql: str | None = None):
    def register(function):
        QUERIES[key] = function
        if sql:
            ORACLES[key] = sql
        return function

    return register


def _sha_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    shas = pa.array([sha256(t.encode()).hexdigest() for t in texts_of(batch.column("__text"))], pa.string())
    return pa.RecordBatch.from_arrays([*batch.columns[:-1], shas], [*batch.schema.names[:-1], "kept_sha256"])


@query("op1_suffix_dedup")
def suffix_dedup(spark: SparkSession, root: str) -> DataFrame:
    done = suffixes.dedup_substrings(table(spark, root, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query(
    "op2_line_dedup",
    r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split),
holders AS (
  SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT k.doc_id, k.pos, k.line, h.key IS NOT NULL AND k.doc_id > h.first_id AS gone
  FROM keyed k LEFT JOIN holders h USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""",
)
def line_dedup(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    done = lines.dedup_lines(docs).select("doc_id", F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"), "__text")
    return map_batches(done, _sha_batch, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


@query("op3_recurrent_lm")
def recurrent_lm(spark: SparkSession, root: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, root, "documents"))


@query("op4_pareto_mix")
def pareto_mix(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix(table(spark, root, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op5_quality_divergence")
def quality_divergence(spark: SparkSession, root: str) -> DataFrame:
    return quality.judge(table(spark, root, "documents"))


@query("op6_tier_packing")
def tier_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack_documents(table(spark, root, "documents")).drop("ids")


@query("op7_randomness_battery")
def randomness_battery(spark: SparkSession, root: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, root, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{secrets.KINDS[k]}") for k in range(3)],
        F.sha2(secrets.spelled("base"), 256).alias("base_sha256"),
        secrets.spelled("found").alias("spans"),
    )


@query("op8_block_rules")
def block_rules(spark: SparkSession, root: str) -> DataFrame:
    return html_blocks.extract(table(spark, root, "pages"))


@query("op9_adaptive_scan")
def nearest_vectors(spark: SparkSession, root: str) -> DataFrame:
    return adaptive_scan.nearest(table(spark, root, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query("op10_deletion_simhash")
def deletion_simhash(spark: SparkSession, root: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, root, "documents"))
    return found.select("doc_id", simhash.hex_print().alias("fingerprint"), "component_id")


@query(
    "op11_prefix_free_phrases",
    r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
spelled AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM worded, (VALUES (1), (2), (3), (4)) sizes(size) WHERE len(w) >= size),
f AS (SELECT lang, size, phrase, count(*)::HUGEINT AS c FROM spelled GROUP BY ALL HAVING count(*) >= 30),
candidates AS (SELECT lang, size, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
scored AS (
  SELECT x.lang, x.size, x.phrase, x.a, x.k, h.c AS l, t.c AS r, (2000000 * x.a) // (h.c + t.c) AS score
  FROM cuts x
  JOIN f h ON h.lang = x.lang AND h.phrase = array_to_string(x.w[1:x.k], ' ')
  JOIN f t ON t.lang = x.lang AND t.phrase = array_to_string(x.w[x.k + 1:x.size], ' ')),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
subs AS (
  SELECT lang, a, w, size, unnest(range(2, size)) AS m FROM candidates WHERE size >= 3),
inside AS (
  SELECT lang, unnest(list_transform(range(1, size - m + 2), lambda s: array_to_string(w[s:s + m - 1], ' '))) AS phrase, a AS longer FROM subs),
held AS (SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY ALL),
kept AS (
  SELECT x.* FROM lowest x LEFT JOIN held USING (lang, phrase)
  WHERE held.longer IS NULL OR 100 * held.longer < 80 * x.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
""",
)
def prefix_free_phrases(spark: SparkSession, root: str) -> DataFrame:
    return phrases.collocations(table(spark, root, "documents"))


@query(
    "op12_seekable_bundles",
    r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages),
fives AS (
  SELECT *, list_transform(range(0, 4), lambda i: ('0x' || substr(hex, 1 + 10 * i::INTEGER, 10))::BIGINT) AS parts FROM p)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((parts[1 + i // 8] >> (35 - 5 * (i % 8))::INTEGER) & 31)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM fives
""",
)
def seekable_bundles(spark: SparkSession, root: str) -> DataFrame:
    done = warc.archive(table(spark, root, "pages"), scratch_path(spark, "warc"))
    return done.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(
    "op13_interval_search",
    r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
lengths AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
totals AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM lengths),
m AS (SELECT doc_id, 100 - 25 + ((25 * n * nn) // ll) AS m FROM lengths, totals),
p AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, totals GROUP BY term, nn),
qt AS (SELECT item_id, term, count(*) AS q FROM q GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM qt JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 20
""",
)
def interval_search(spark: SparkSession, root: str) -> DataFrame:
    return ranked.top_documents(table(spark, root, "documents"), table(spark, root, "benchmark"))
