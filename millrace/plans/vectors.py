"""Vector queries: frame = embedding, video = ten consecutive frames, label = label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.operators import communities, evaluation, linear, neighbours, signals
from millrace.operators.sequences import with_ordinal
from millrace.plans.registry import bound, fixed, fixed_sql
from millrace.sources.storage import materialize
from millrace.sources.tables import table

ENTRIES_SQL = """
    e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v,
                 (generate_subscripts(embedding, 1) - 1)::INTEGER AS i FROM embeddings)
"""


@bound(
    "gram_matrix",
    f"""
    WITH {ENTRIES_SQL}
    SELECT a.i, b.i AS j, {fixed_sql('sum(a.v * b.v)', 6)} AS value
    FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.i <= b.i GROUP BY 1, 2
    """,
)
def gram_matrix(spark: SparkSession, root: str) -> DataFrame:
    sums = linear.entries(linear.moments(table(spark, root, "embeddings"), "embedding"))
    return sums.where("kind = 'xx'").select("i", "j", fixed("value", 6).alias("value"))


@bound(
    "label_moments",
    f"""
    WITH {ENTRIES_SQL}
    SELECT label, i AS feature, count(*) AS frames, {fixed_sql('sum(v)', 6)} AS value FROM e GROUP BY 1, 2
    """,
)
def label_moments(spark: SparkSession, root: str) -> DataFrame:
    """Label-by-feature sums X'Y and label counts, the other half of the shared moments."""
    frames = table(spark, root, "embeddings").withColumn("labels", F.array("label"))
    sums = linear.entries(linear.moments(frames, "embedding", "labels"))
    counts = sums.where("kind = 'yy'").select(F.col("i").alias("label"), F.col("value").cast("bigint").alias("frames"))
    cross = sums.where("kind = 'xy'").select(F.col("i").alias("label"), F.col("j").alias("feature"), "value")
    return cross.join(counts, "label").select("label", "feature", "frames", fixed("value", 6).alias("value"))


@bound("ridge_fit")
def ridge_fit(spark: SparkSession, root: str) -> DataFrame:
    frames = table(spark, root, "embeddings").withColumn("labels", F.array("label"))
    return linear.ridge_fit(frames, "embedding", "labels")


MODEL_SQL = f"""
    {ENTRIES_SQL},
    model AS (SELECT label, i, avg(v) AS w FROM e GROUP BY 1, 2),
    x AS (SELECT vec_id // 10 AS video, i, avg(v) AS v FROM e GROUP BY 1, 2),
    scores AS (SELECT video, model.label, sum(v * w) AS score FROM x JOIN model ON x.i = model.i GROUP BY 1, 2),
    top AS (
      SELECT *, row_number() OVER (PARTITION BY video ORDER BY score DESC, label) AS rank FROM scores)
"""


def centroid_model(spark: SparkSession, root: str) -> DataFrame:
    """A model table both engines can build: the mean vector of each label."""
    means = linear.group_means(table(spark, root, "embeddings"), ["label"], "embedding")
    return means.select("label", F.posexplode("mean").alias("feature", "weight"))


def scored_videos(spark: SparkSession, root: str, keep: int | None = None) -> DataFrame:
    """Mean frame per video first, then the model: the score is linear, so both orders agree."""
    frames = table(spark, root, "embeddings").withColumn("video", F.expr("vec_id div 10"))
    videos = linear.group_means(frames, ["video"], "embedding")
    return linear.linear_scores(videos, "mean", centroid_model(spark, root), keep)


@bound(
    "score_linear",
    f"WITH {MODEL_SQL} SELECT video, label, {fixed_sql('score', 6)} AS score FROM scores",
)
def score_linear(spark: SparkSession, root: str) -> DataFrame:
    scored = scored_videos(spark, root).select("video", F.inline("scores"))
    return scored.withColumn("score", fixed("score", 6))


@bound(
    "top5_labels",
    f"WITH {MODEL_SQL} SELECT video, rank::INTEGER AS rank, label, {fixed_sql('score', 6)} AS score FROM top WHERE rank <= 5",
)
def top5_labels(spark: SparkSession, root: str) -> DataFrame:
    best = scored_videos(spark, root, 5).select("video", F.posexplode("scores").alias("at", "s"))
    return best.select(
        "video", (F.col("at") + 1).alias("rank"), "s.label", fixed(F.col("s.score"), 6).alias("score")
    )


@bound(
    "label_confusion",
    f"""
    WITH {MODEL_SQL},
    predicted AS (SELECT video, label FROM top WHERE rank <= 5),
    actual AS (SELECT DISTINCT vec_id // 10 AS video, label FROM embeddings)
    SELECT (SELECT count(*) FROM predicted JOIN actual USING (video, label)) AS true_positive,
           (SELECT count(*) FROM predicted ANTI JOIN actual USING (video, label)) AS false_positive,
           (SELECT count(*) FROM actual ANTI JOIN predicted USING (video, label)) AS false_negative
    """,
)
def label_confusion(spark: SparkSession, root: str) -> DataFrame:
    frames = table(spark, root, "embeddings")
    actual = frames.groupBy(F.expr("vec_id div 10").alias("video")).agg(F.collect_set("label").alias("actual"))
    predicted = scored_videos(spark, root, 5).select("video", F.col("scores.label").alias("predicted"))
    return evaluation.set_confusion(predicted.join(actual, "video"), "predicted", "actual")


@bound(
    "ridge_normal",
    """
    SELECT ridge, label, i::INTEGER AS feature, 0.0::DOUBLE AS gap
    FROM (SELECT unnest([0.0, 1.0, 10.0, 100.0, 500.0])::DOUBLE AS ridge), (SELECT DISTINCT label FROM embeddings),
         (SELECT unnest(range(0, 64)) AS i)
    """,
)
def ridge_normal(spark: SparkSession, root: str) -> DataFrame:
    """How far each fit is from solving (X'X + ridge n I) b = X'y, from the table itself.

    X'(y - Xb) - ridge n b must vanish for every ridge, label and feature.
    """
    frames = table(spark, root, "embeddings").withColumn("labels", F.array("label"))
    model = linear.ridge_fit(frames, "embedding", "labels")
    sums = linear.entries(linear.moments(frames, "embedding", "labels"))
    upper = sums.where("kind = 'xx'")
    square = upper.select("i", "j", "value").unionByName(
        upper.where("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "value")
    )
    cross = sums.where("kind = 'xy'").select(F.col("i").alias("label"), F.col("j").alias("feature"), F.col("value").alias("xy"))
    n = sums.where("kind = 'n'").select("value").scalar()
    fitted = (
        square.join(model, F.col("j") == F.col("feature"))
        .groupBy("ridge", "label", F.col("i").alias("feature"))
        .agg(F.sum(F.col("value") * F.col("weight")).alias("xxb"))
    )
    own = model.select("ridge", "label", "feature", "weight")
    gap = F.col("xy") - F.col("xxb") - F.col("ridge") * n * F.col("weight")
    return (
        fitted.join(own, ["ridge", "label", "feature"])
        .join(cross, ["label", "feature"])
        .select("ridge", "label", "feature", fixed(gap, 6).alias("gap"))
    )


@bound(
    "pca_invariants",
    f"""
    WITH {ENTRIES_SQL},
    cv AS (SELECT a.i, b.i AS j, covar_samp(a.v, b.v) AS c FROM e a JOIN e b ON a.vec_id = b.vec_id GROUP BY 1, 2)
    SELECT {fixed_sql('sum(c) FILTER (WHERE i = j)', 6)} AS total_variance,
           {fixed_sql('sum(c * c)', 6)} AS squared_variances, 64::BIGINT AS components
    FROM cv
    """,
)
def pca_invariants(spark: SparkSession, root: str) -> DataFrame:
    """Sum and sum of squares of the component variances, which the covariances fix."""
    variance = pca_variance(spark, root).agg(
        F.sum("variance").alias("t"), F.sum(F.col("variance") * F.col("variance")).alias("s"), F.count("*").alias("components")
    )
    return variance.select(
        fixed("t", 6).alias("total_variance"), fixed("s", 6).alias("squared_variances"), "components"
    )


@bound("pca_variance")
def pca_variance(spark: SparkSession, root: str) -> DataFrame:
    found = linear.principal_components(table(spark, root, "embeddings"), "embedding")
    rows = [(i, float(v), float(s)) for i, (v, s) in enumerate(zip(found.variance, found.share))]
    return spark.createDataFrame(rows, "component int, variance double, share double")


@bound("pca_scores")
def pca_scores(spark: SparkSession, root: str) -> DataFrame:
    frames = table(spark, root, "embeddings")
    found = linear.principal_components(frames, "embedding", 40)
    return frames.select("vec_id", linear.project(F.col("embedding"), found).alias("scores"))


@bound(
    "pca_uncorrelated",
    """
    SELECT i::INTEGER AS component, 0.0::DOUBLE AS mean, 0.0::DOUBLE AS covariance, true AS falling
    FROM (SELECT unnest(range(0, 40)) AS i)
    """,
)
def pca_uncorrelated(spark: SparkSession, root: str) -> DataFrame:
    """What holds of scores on principal components: means of 0, no covariance with any other, variances in falling order."""
    scores = materialize(pca_scores(spark, root), "scores")
    sums = materialize(linear.entries(linear.moments(scores, "scores")), "moments")
    n = sums.where("kind = 'n'").select("value").scalar()
    means = sums.where("kind = 'x'").select(F.col("i").alias("component"), (F.col("value") / n).alias("mean"))
    products = sums.where("kind = 'xx'").select("i", "j", (F.col("value") / n).alias("value"))
    apart = products.where("i <> j").select(F.explode(F.array("i", "j")).alias("component"), F.abs("value").alias("value"))
    others = apart.groupBy("component").agg(F.max("value").alias("covariance"))
    own = products.where("i = j").select(F.col("i").alias("component"), F.col("value").alias("variance"))
    after = own.select((F.col("component") - 1).alias("component"), F.col("variance").alias("after"))
    falling = F.coalesce(F.col("variance") >= F.col("after"), F.lit(True))
    joined = means.join(others, "component").join(own, "component").join(after, "component", "left")
    return joined.select("component", fixed("mean", 6).alias("mean"), fixed("covariance", 6).alias("covariance"), falling.alias("falling"))


KNN_SQL = """
    pairs AS (
      SELECT a.vec_id, b.vec_id AS neighbour,
             list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS distance
      FROM embeddings a, embeddings b),
    knn AS (
      SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbour) AS rank FROM pairs)
"""


@bound(
    "knn_exact",
    f"""
    WITH {KNN_SQL}
    SELECT vec_id, neighbour, {fixed_sql('distance', 6)} AS distance, rank::INTEGER AS rank FROM knn WHERE rank <= 10
    """,
)
def knn_exact(spark: SparkSession, root: str) -> DataFrame:
    found = neighbours.nearest_neighbours(table(spark, root, "embeddings"), "vec_id", "embedding", 10)
    return found.select("vec_id", "neighbour", fixed("distance", 6).alias("distance"), "rank")


@bound(
    "knn_share",
    f"""
    WITH {KNN_SQL}
    SELECT count(*) FILTER (WHERE rank <= 10) AS pairs, count(DISTINCT vec_id) AS rows, true AS recall_reached FROM knn
    """,
)
def knn_share(spark: SparkSession, root: str) -> DataFrame:
    """Approximate neighbours from some leaves of the tree, held against the exact ones: a recall of 0.9 at least."""
    vectors = table(spark, root, "embeddings")
    near = materialize(neighbours.nearest_neighbours(vectors, "vec_id", "embedding", 10, block_rows=256, share=SHARE), "probed")
    exact = neighbours.nearest_neighbours(vectors, "vec_id", "embedding", 10).select("vec_id", "neighbour")
    met = near.join(exact.withColumn("hit", F.lit(1)), ["vec_id", "neighbour"], "left")
    totals = met.agg(F.count("*").alias("pairs"), F.count_distinct("vec_id").alias("rows"), F.count("hit").alias("found"))
    return totals.select("pairs", "rows", (F.col("found") >= 0.9 * F.col("pairs")).alias("recall_reached"))


SHARE = 0.8  # of the leaves that an approximate search looks into; vectors without clusters need most of them


def neighbour_graph(spark: SparkSession, root: str) -> DataFrame:
    found = neighbours.nearest_neighbours(table(spark, root, "embeddings"), "vec_id", "embedding", 10)
    return neighbours.undirected(found, "vec_id", "neighbour")


@bound(
    "modularity",
    f"""
    WITH {KNN_SQL},
    one AS (SELECT vec_id AS s, neighbour AS t FROM knn WHERE rank <= 10 AND vec_id <> neighbour),
    edges AS (SELECT s, t FROM one UNION SELECT t, s FROM one),
    l AS (SELECT a.label AS a, b.label AS b FROM edges JOIN embeddings a ON a.vec_id = s JOIN embeddings b ON b.vec_id = t),
    c AS (SELECT a, count(*) AS degree, count(*) FILTER (WHERE a = b) AS inside FROM l GROUP BY a)
    SELECT count(*) AS clusters,
           {fixed_sql('sum(inside / (SELECT count(*) FROM l) - (degree / (SELECT count(*) FROM l)) * (degree / (SELECT count(*) FROM l)))', 6)} AS modularity
    FROM c
    """,
)
def modularity(spark: SparkSession, root: str) -> DataFrame:
    labels = table(spark, root, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("cluster"))
    graph = materialize(neighbour_graph(spark, root), "graph")
    score = neighbours.modularity(graph, labels)
    return score.withColumn("modularity", fixed("modularity", 6))


@bound("graph_clusters")
def graph_clusters(spark: SparkSession, root: str) -> DataFrame:
    """Communities of the neighbour graph with their sizes, and the modularity they reach."""
    graph = materialize(neighbour_graph(spark, root), "graph")
    clusters = communities.cluster_graph(graph)
    reached = neighbours.modularity(graph, clusters).select("modularity").scalar()
    return clusters.groupBy("cluster").agg(F.count("*").alias("size")).withColumn("modularity", reached)


@bound(
    "cluster_quality",
    "SELECT count(DISTINCT vec_id) AS nodes, count(DISTINCT vec_id) AS placed, true AS above_labels, true AS several FROM embeddings",
)
def cluster_quality(spark: SparkSession, root: str) -> DataFrame:
    """What must hold for any clustering worth its name: every node once, and better than the given labels."""
    graph = materialize(neighbour_graph(spark, root), "graph")
    clusters = communities.cluster_graph(graph)
    labels = table(spark, root, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("cluster"))
    score = lambda found: neighbours.modularity(graph, found).first()
    reached, given = score(clusters), score(labels)
    return clusters.agg(F.count("*").alias("nodes"), F.count_distinct("id").alias("placed")).select(
        "nodes",
        "placed",
        F.lit(reached["modularity"] > max(given["modularity"], 0.0)).alias("above_labels"),
        F.lit(reached["clusters"] > 1).alias("several"),
    )


COHERENCE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def line_signals(spark: SparkSession, root: str) -> DataFrame:
    lines = table(spark, root, "lineitem").select(*COHERENCE_ORDER)
    return with_ordinal(lines, COHERENCE_ORDER)


@bound(
    "coherence",
    f"""
    WITH o AS (
      SELECT row_number() OVER (ORDER BY {', '.join(COHERENCE_ORDER)}) - 1 AS ordinal,
             l_quantity AS x, l_extendedprice AS y FROM lineitem),
    s AS (
      SELECT ordinal // 256 AS seg, ordinal % 256 AS p,
             x * (0.5 - 0.5 * cos(2 * pi() * (ordinal % 256) / 255)) AS x,
             y * (0.5 - 0.5 * cos(2 * pi() * (ordinal % 256) / 255)) AS y
      FROM o WHERE ordinal // 256 < (SELECT count(*) // 256 FROM o)),
    f AS (
      SELECT seg, k, sum(x * cos(2 * pi() * ((k * p) % 256) / 256)) AS xr, -sum(x * sin(2 * pi() * ((k * p) % 256) / 256)) AS xi,
             sum(y * cos(2 * pi() * ((k * p) % 256) / 256)) AS yr, -sum(y * sin(2 * pi() * ((k * p) % 256) / 256)) AS yi
      FROM s, (SELECT unnest(range(0, 129)) AS k) GROUP BY seg, k),
    a AS (
      SELECT k, sum(xr * xr + xi * xi) AS xx, sum(yr * yr + yi * yi) AS yy,
             sum(xr * yr + xi * yi) AS re, sum(xr * yi - xi * yr) AS im
      FROM f GROUP BY k)
    SELECT k::INTEGER AS k, {fixed_sql('k * 100.0::DOUBLE / 256', 6)} AS frequency,
           {fixed_sql('(re * re + im * im) / (xx * yy)', 6)} AS coherence
    FROM a
    """,
)
def coherence(spark: SparkSession, root: str) -> DataFrame:
    spectrum = signals.coherence(
        line_signals(spark, root), "ordinal", "l_quantity", "l_extendedprice", rate=100.0
    )
    return spectrum.select("k", fixed("frequency", 6).alias("frequency"), fixed("coherence", 6).alias("coherence"))


@bound(
    "stft_frames",
    f"""
    WITH clip AS (
      SELECT vec_id, list_concat(embedding::DOUBLE[], list_transform(range(0, 36), lambda i: 0.0::DOUBLE)) AS v
      FROM embeddings),
    s AS (
      SELECT vec_id, fr, p, v[(fr * 16 + p + 1)::BIGINT] * (0.5 - 0.5 * cos(2 * pi() * p / 30)) AS x
      FROM clip, (SELECT unnest(range(0, 5)) AS fr), (SELECT unnest(range(0, 31)) AS p))
    SELECT vec_id, fr::INTEGER AS frame, k::INTEGER AS bin,
           {fixed_sql('sqrt(pow(sum(x * cos(2 * pi() * ((k * p) % 32) / 32)), 2) + pow(sum(x * sin(2 * pi() * ((k * p) % 32) / 32)), 2))', 5)} AS magnitude
    FROM s, (SELECT unnest(range(0, 17)) AS k) GROUP BY vec_id, fr, k
    """,
)
def stft_frames(spark: SparkSession, root: str) -> DataFrame:
    magnitudes = signals.short_time_magnitudes(F.col("embedding"), pad=100, length=31, step=16, fft=32)
    clips = table(spark, root, "embeddings").select("vec_id", F.posexplode(magnitudes).alias("frame", "m"))
    return clips.select("vec_id", "frame", F.posexplode("m").alias("bin", "magnitude")).withColumn(
        "magnitude", fixed("magnitude", 5)
    )
