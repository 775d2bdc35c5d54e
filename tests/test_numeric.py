"""Count tables, markers, linear models, spectra and neighbours against numpy and pandas."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import communities, counts, linear, markers, mergeable, metric_tree, neighbours, primes, signals
from millrace.sources.storage import materialize

CELLS, GENES = 40, 12


@pytest.fixture(scope="module")
def dense():
    draw = np.random.default_rng(5)
    table = draw.poisson(draw.uniform(0.1, 4, GENES), (CELLS, GENES)).astype(float)
    table[:, 0] += 1  # no empty cell
    table[:, 3] = 0  # a gene never seen
    return pd.DataFrame(table, index=range(CELLS), columns=[f"g{i:02d}" for i in range(GENES)])


def to_long(spark, table):
    long = table.rename_axis("cell").reset_index().melt("cell", var_name="gene", value_name="value")
    return spark.createDataFrame(long[long["value"] > 0], "cell bigint, gene string, value double")


@pytest.fixture(scope="module")
def long(spark, dense):
    return to_long(spark, dense).cache()


@pytest.fixture(scope="module")
def groups(spark):
    rows = [(i, "abc"[i % 3] if i % 5 else "a") for i in range(CELLS)]
    return spark.createDataFrame(rows, "cell bigint, `group` string").cache()


def by_gene(df, *columns):
    return df.toPandas().set_index("gene").sort_index()[list(columns)]


# Count tables ----------------------------------------------------------------------------


def test_quality(long, dense):
    got = counts.cell_quality(long, F.col("gene").isin("g01", "g02")).toPandas().set_index("cell").sort_index()
    assert (got["n_genes"] == (dense > 0).sum(axis=1)).all()
    assert np.allclose(got["flagged_pct"], 100 * dense[["g01", "g02"]].sum(axis=1) / dense.sum(axis=1))


def test_normalising_gives_equal_totals(long, dense):
    got = counts.normalize_log(long).groupBy("cell").agg(F.sum(F.expm1("value")).alias("t")).toPandas()
    assert np.allclose(got["t"], 1e4)


def test_top_shares_count_absent_genes(long, dense):
    expected = (100 * dense.div(dense.sum(axis=1), axis=0)).mean().sort_values(ascending=False)
    got = counts.top_share_genes(long, 5).toPandas()
    assert np.allclose(got["mean_pct"], expected.head(5)) and got["gene"].tolist() == expected.head(5).index.tolist()


def test_variable_genes_match_pandas(long, dense):
    norm = dense.div(dense.sum(axis=1), axis=0) * 1e4
    seen = norm.loc[:, norm.sum() > 0]
    mean, var = seen.mean(), seen.var(ddof=1)
    stats = pd.DataFrame({"mean": np.log1p(mean), "disp": np.log(var / mean)})
    stats["bin"] = pd.cut(stats["mean"], bins=20, labels=False)
    centre = stats.groupby("bin")["disp"].transform("mean")
    spread = stats.groupby("bin")["disp"].transform("std")
    alone = stats.groupby("bin")["disp"].transform("count") == 1
    expected = ((stats["disp"] - centre) / spread).where(~alone, 1.0)
    got = by_gene(counts.variable_genes(counts.normalize_log(long)), "mean", "bin", "score")
    assert np.allclose(got["mean"], stats["mean"].sort_index())
    assert (got["bin"] == stats["bin"].sort_index()).all()
    assert np.allclose(got["score"].astype(float), expected.sort_index(), equal_nan=True)


def test_regression_residuals_are_least_squares(spark, long, dense):
    cells = counts.cell_quality(long, F.col("gene") == "g01").select("cell", "total", "flagged_pct")
    kept = long.where("gene in ('g02', 'g04', 'g05')")
    got = counts.regress_out(kept, cells, ("total", "flagged_pct")).toPandas()
    table = got.pivot(index="cell", columns="gene", values="value").sort_index()
    total = dense.sum(axis=1)
    design = np.column_stack([np.ones(CELLS), total, 100 * dense["g01"] / total])
    for gene in ("g02", "g04", "g05"):
        beta, *_ = np.linalg.lstsq(design, dense[gene].to_numpy(), rcond=None)
        assert np.allclose(table[gene], dense[gene] - design @ beta, atol=1e-9)


def test_constant_covariate_is_no_problem(spark, long):
    cells = long.select("cell").distinct().withColumns({"a": F.lit(1.0), "b": F.col("cell") * 1.0})
    got = counts.regress_out(long.where("gene = 'g02'"), cells, ("a", "b"))
    assert got.where(F.isnan("value") | F.col("value").isNull()).count() == 0


def test_scaling_clips_and_survives_constant_genes(spark):
    rows = [(i, "a", float(i == 9) * 100) for i in range(10)] + [(i, "b", 4.0) for i in range(10)]
    got = counts.scale_clip(spark.createDataFrame(rows, "cell bigint, gene string, value double"), 2.0, -0.2).toPandas()
    a = got[got["gene"] == "a"]["value"]
    assert a.max() == 2.0 and a.min() == -0.2
    assert (got[got["gene"] == "b"]["value"] == 0).all()


def test_dense_vectors_fill_zeros(spark, long, dense):
    names = counts.kept_names(long)
    assert "g03" not in names
    vectors = counts.dense_vectors(long, spark.range(CELLS + 1).withColumnRenamed("id", "cell"), names)
    got = {r["cell"]: r["vector"] for r in vectors.collect()}
    assert got[CELLS] == [0.0] * len(names)
    assert all(got[i] == dense.loc[i, names].tolist() for i in range(CELLS))


def test_more_genes_groups_and_categories_than_any_list_would_hold(spark):
    many = spark.range(12_000).select(F.col("id").alias("cell"), F.format_string("g%05d", F.col("id") % 5000).alias("gene"), F.lit(1.0).alias("value"))
    assert len(counts.kept_names(many)) == 5000
    sized = counts.scale_clip(many).where("gene = 'g00007'").collect()
    assert {r["value"] for r in sized} == {0.0}
    wide = spark.range(10_500).select(F.col("id").alias("cell"), F.col("id").alias("group"))
    assert counts.gene_by_group(many.where("cell < 2"), wide).count() == 2 * 10_500
    named = spark.range(1200).select(F.col("id").cast("string").alias("c"))
    from millrace.operators.onehot import categories

    assert len(categories(named, "c")) == 1200


@pytest.mark.parametrize("rows, message", [([[1.0, 2.0, 3.0], [4.0]], "vectors of 1 and of 3")])
def test_moments_refuse_ragged_vectors(spark, rows, message):
    from millrace.operators import linear

    df = spark.createDataFrame([(r,) for r in rows], "v array<double>")
    with pytest.raises(Exception, match=message):
        linear.moments(df.repartition(1), "v").collect()
    with pytest.raises(Exception, match="(?i)dimension"):  # in different tasks
        linear.moments(df.repartition(2), "v", tasks=2).collect()


def test_moments_leave_out_vectors_with_a_missing_element(spark):
    from millrace.operators import linear

    df = spark.createDataFrame([([1.0, 2.0], [3]), ([None, 1.0], [3]), (None, [3]), ([3.0, 5.0], [3, 4])], "v array<double>, l array<int>")
    got = {(r["kind"], r["i"], r["j"]): r["value"] for r in linear.entries(linear.moments(df, "v", "l")).collect()}
    assert got["n", 0, 0] == 2 and got["xx", 0, 1] == 17 and got["xy", 3, 1] == 7 and got["xy", 4, 0] == 3 and got["yy", 3, 3] == 2


def test_typed_functions_do_not_see_missing_arguments(spark):
    from millrace.functions.codecs import typed_udf

    def label(n: int, name: str) -> str:
        return f"{n} {name}"

    df = spark.createDataFrame([("7", "a"), (None, "b"), ("8", None), ("9007199254740993", "c")], "n string, name string")
    got = [r[0] for r in df.select(typed_udf(label)(F.col("n"), F.col("name"))).collect()]
    assert got == ["7 a", None, None, "9007199254740993 c"]


def test_primes_of_any_size(spark):
    values = list(range(-3, 200)) + [10**12 + 39, 10**12 + 40, 2**61 - 1, 2**63 - 25, 2**63 - 1, 3215031751, None]
    got = {r[0] for r in primes.prime_rows(spark.createDataFrame([(v,) for v in values], "n bigint"), "n").collect()}
    small = {n for n in range(2, 200) if all(n % d for d in range(2, n))}
    assert got == small | {10**12 + 39, 2**61 - 1, 2**63 - 25}


def test_group_expression_counts_absent_cells(long, groups, dense):
    labels = pd.Series({r["cell"]: r["group"] for r in groups.collect()})
    got = counts.group_expression(long, groups).toPandas().set_index(["gene", "group"])
    for group, part in dense.groupby(labels):
        for gene in part.columns.drop("g03"):
            assert got.loc[(gene, group), "mean"] == pytest.approx(part[gene].mean())
            assert got.loc[(gene, group), "fraction"] == pytest.approx((part[gene] > 0).mean())


def test_exact_quantiles_of_a_hot_key(spark):
    draw = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": np.where(draw.random(500) < 0.6, 0, draw.integers(1, 5, 500)), "v": draw.integers(0, 40, 500) * 0.5})
    got = counts.exact_quantiles(spark.createDataFrame(pdf), ["k"], "v", [0.1, 0.5, 1.0]).toPandas().set_index("k")
    for k, part in pdf.groupby("k"):
        ordered = np.sort(part["v"])
        for q, name in ((0.1, "q10"), (0.5, "q50"), (1.0, "q100")):
            assert got.loc[k, name] == ordered[math.ceil(q * len(ordered)) - 1]


# Markers ------------------------------------------------------------------------------------


def test_welch_scores(long, groups, dense):
    labels = pd.Series({r["cell"]: r["group"] for r in groups.collect()})
    got = markers.welch_scores(long, groups).toPandas().set_index(["gene", "group"])
    for group in "abc":
        inside, rest = dense[labels == group], dense[labels != group]
        for gene in dense.columns.drop("g03"):
            a, b = inside[gene].var() / len(inside), rest[gene].var() / len(rest)
            t = (inside[gene].mean() - rest[gene].mean()) / math.sqrt(a + b)
            v = (a + b) ** 2 / (a**2 / (len(inside) - 1) + b**2 / (len(rest) - 1))
            assert got.loc[(gene, group), "score"] == pytest.approx(t)
            assert got.loc[(gene, group), "freedom"] == pytest.approx(v)


def test_rank_sums_include_the_zeros(long, groups, dense):
    labels = pd.Series({r["cell"]: r["group"] for r in groups.collect()})
    ranks = dense.rank()
    got = markers.rank_sums(long, groups).toPandas().set_index(["gene", "group"])["rank_sum"]
    for group in "abc":
        for gene in dense.columns.drop("g03"):
            assert got[(gene, group)] == pytest.approx(ranks.loc[labels == group, gene].sum())


def test_pair_of_groups(long, groups, dense):
    labels = pd.Series({r["cell"]: r["group"] for r in groups.collect()})
    pair = dense[labels.isin(["a", "b"])]
    ranks = pair.rank()
    got = markers.against_one(long, groups, "a", "b").toPandas().set_index("gene")
    for gene in got.index:
        n, total = (labels[pair.index] == "a").sum(), len(pair)
        rank_sum = ranks.loc[labels[pair.index] == "a", gene].sum()
        z = (rank_sum - n * (total + 1) / 2) / math.sqrt(n * (total - n) * (total + 1) / 12)
        assert got.loc[gene, "score"] == pytest.approx(z)


def test_top_markers_break_ties_by_name(spark):
    df = spark.createDataFrame([("a", "z", 1.0), ("a", "b", 1.0), ("a", "c", None)], "`group` string, gene string, score double")
    assert [r["gene"] for r in markers.top_markers(df, 2).orderBy("rank").collect()] == ["b", "z"]


def test_tail_probabilities():
    # Published two-sided tail areas of Student's t.
    assert markers.student_two_sided([2.228139], [10.0])[0] == pytest.approx(0.05, abs=1e-6)
    assert markers.student_two_sided([12.706205], [1.0])[0] == pytest.approx(0.05, abs=1e-6)
    assert markers.student_two_sided([0.0], [3.0])[0] == 1.0
    assert markers.student_two_sided([1.0], [1.0])[0] == pytest.approx(0.5, abs=1e-12)
    big = markers.student_two_sided([1.959964], [1e7])[0]
    assert big == pytest.approx(0.05, abs=1e-6)
    assert np.isnan(markers.student_two_sided([np.nan], [3.0])[0])
    t, v = np.linspace(-6, 6, 41), np.full(41, 5.0)
    x = np.linspace(0, 400, 4_000_001)
    density = math.gamma(3) / (math.sqrt(5 * math.pi) * math.gamma(2.5)) * (1 + x * x / 5) ** -3
    area = np.concatenate([[0], np.cumsum((density[1:] + density[:-1]) / 2 * (x[1] - x[0]))])
    assert np.allclose(markers.student_two_sided(t, v), 1 - 2 * np.interp(np.abs(t), x, area), atol=1e-6)


# Linear models -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def frames(spark):
    draw = np.random.default_rng(9)
    x = draw.normal(size=(300, 6)).astype(np.float32)
    labels = [sorted(set(draw.integers(0, 4, draw.integers(1, 3)))) for _ in range(300)]
    rows = [(i, x[i].tolist(), [int(l) for l in labels[i]]) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, x array<float>, y array<int>")
    hot = np.array([[1.0 if l in ls else 0.0 for l in range(4)] for ls in labels])
    return df, x.astype(float), hot


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_moments_do_not_depend_on_partitions(frames, parts):
    df, x, hot = frames
    table = linear.moments(df.repartition(parts), "x", "y", tasks=parts).cache()
    sums = linear.Moments(table)
    assert sums.n == 300
    assert np.allclose(sums.xx, x.T @ x) and np.allclose(sums.x, x.sum(axis=0))
    numbers = {r["i"]: r["numbers"] for r in table.where("kind = 'xy'").collect()}
    assert all(np.allclose(numbers[label], [hot[:, label].sum(), *(hot.T @ x)[label]]) for label in range(4))
    xx = {(r["i"], r["j"]): r["value"] for r in linear.entries(table).where("kind = 'xx'").collect()}
    assert len(xx) == 21 and np.allclose(xx[2, 5], (x.T @ x)[2, 5])


def test_bands_of_a_wide_matrix(spark, monkeypatch):
    monkeypatch.setattr(linear, "BAND", 4)
    x = np.random.default_rng(1).normal(size=(20, 10))
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(5)
    table = linear.moments(df, "x")
    assert table.where("kind = 'xx'").count() == 3
    assert np.allclose(linear.Moments(table).xx, x.T @ x)


def test_labels_are_scored_in_blocks(spark, frames, monkeypatch):
    df, x, hot = frames
    model = linear.ridge_fit(df, "x", "y", [0.0])
    whole = {r["id"]: r["scores"] for r in linear.linear_scores(df, "x", model, 3).collect()}
    monkeypatch.setattr(linear, "SHARED_BYTES", 6 * 8)  # one label at a time
    parts = {r["id"]: r["scores"] for r in linear.linear_scores(df, "x", model, 3).collect()}
    for row, best in whole.items():
        assert [b["label"] for b in best] == [b["label"] for b in parts[row]]
        assert np.allclose([b["score"] for b in best], [b["score"] for b in parts[row]])


def test_moments_leave_out_missing_vectors_and_empty_partitions(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id int, x array<double>").repartition(6)
    sums = linear.Moments(linear.moments(df, "x"))
    assert sums.n == 1 and np.allclose(sums.xx, [[1, 2], [2, 4]])
    with pytest.raises(ValueError):
        linear.Moments(linear.moments(df.where("id = 2"), "x"))


def test_ridge_fit_matches_numpy(frames):
    df, x, hot = frames
    got = linear.ridge_fit(df, "x", "y").toPandas()
    assert sorted(got["ridge"].unique()) == list(linear.RIDGES)
    for ridge, part in got.groupby("ridge"):
        beta = np.linalg.pinv(x.T @ x + ridge * 300 * np.eye(6)) @ x.T @ hot
        table = part.pivot(index="feature", columns="label", values="weight").to_numpy()
        assert np.allclose(table, beta)
        fitted = x @ beta
        r2 = (2 * (fitted * hot).sum(axis=0) - (fitted**2).sum(axis=0)) / (hot**2).sum(axis=0)
        assert np.allclose(part.drop_duplicates("label").sort_values("label")["r2"], r2)


def test_scores_of_the_mean_equal_mean_scores(spark, frames):
    df, x, hot = frames
    model = linear.ridge_fit(df, "x", "y", [0.0])
    videos = linear.group_means(df.withColumn("video", F.expr("id div 10")), ["video"], "x")
    got = {r["video"]: r["scores"] for r in linear.linear_scores(videos, "mean", model, 3).collect()}
    beta = np.linalg.pinv(x.T @ x) @ x.T @ hot
    for video in range(30):
        scores = (x[video * 10 : video * 10 + 10] @ beta).mean(axis=0)
        best = np.argsort(-scores, kind="stable")[:3]
        assert [s["label"] for s in got[video]] == best.tolist()
        assert np.allclose([s["score"] for s in got[video]], scores[best], atol=1e-6)


def test_components_match_numpy(frames):
    df, x, _ = frames
    found = linear.principal_components(df, "x")
    values = np.linalg.eigvalsh(np.cov(x.T))[::-1]
    assert np.allclose(found.variance, values) and np.allclose(found.share, values / values.sum())
    scores = np.array([r["s"] for r in df.orderBy("id").select(linear.project(F.col("x"), found).alias("s")).collect()])
    assert np.allclose(scores.mean(axis=0), 0, atol=1e-9)
    assert np.allclose(np.cov(scores.T), np.diag(values), atol=1e-9)
    largest = found.loadings[np.arange(6), np.abs(found.loadings).argmax(axis=1)]
    assert (largest > 0).all()


def test_few_components_of_many_features(spark):
    draw = np.random.default_rng(5)
    x = 1e3 + draw.normal(size=(400, 3)) @ (draw.normal(size=(3, 50)) * 4) + 0.1 * draw.normal(size=(400, 50))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(999, None)], "id int, x array<double>").repartition(7)
    found = linear.principal_components(df, "x", 5, oversample=3)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert np.allclose(found.variance[:3], values[::-1][:3], rtol=1e-6)
    assert np.allclose(found.variance, values[::-1][:5], rtol=0.1)
    assert np.allclose(found.share, found.variance / values.sum())
    assert np.allclose(np.abs(np.sum(found.loadings[:3] * vectors[:, ::-1][:, :3].T, axis=1)), 1, atol=1e-6)
    scores = (x - x.mean(axis=0)) @ found.loadings.T
    assert np.allclose(np.cov(scores.T), np.diag(found.variance), atol=1e-6)


@pytest.mark.parametrize("tasks", [1, 3, 20])
def test_states_merge_in_any_order(spark, tasks):
    draw = np.random.default_rng(7)
    pdf = pd.DataFrame({"k": draw.choice(["a", "a", "b"], 500), "v": 1e8 + draw.normal(size=500)})
    df = spark.createDataFrame(pdf).repartition(tasks)
    got = mergeable.spread_states(df, "k", "v").toPandas().set_index("k").sort_index()
    expected = pdf.groupby("k")["v"]
    assert (got["n"] == expected.count()).all()
    assert np.allclose(got["squares"] / got["n"], expected.var(ddof=0))
    assert mergeable.spread_states(df.where("k = 'z'"), "k", "v").count() == 0


# Spectra --------------------------------------------------------------------------------------


def test_coherence_matches_numpy(spark):
    from millrace.sources.generators import noisy_waves

    waves = noisy_waves(spark)
    got = signals.coherence(waves, "ordinal", "x", "y", rate=100.0).orderBy("k").toPandas()
    table = waves.orderBy("ordinal").toPandas()
    x, y = (table[c].to_numpy()[: 3000 // 256 * 256].reshape(-1, 256) * np.hanning(256) for c in "xy")
    fx, fy = np.fft.rfft(x), np.fft.rfft(y)
    expected = np.abs((np.conj(fx) * fy).sum(axis=0)) ** 2 / ((np.abs(fx) ** 2).sum(axis=0) * (np.abs(fy) ** 2).sum(axis=0))
    assert np.allclose(got["coherence"], expected, atol=1e-9)
    best = got.loc[got["coherence"].idxmax()]
    assert abs(best["frequency"] - 10) < 0.5 and best["coherence"] > 0.85


def test_short_time_magnitudes(spark):
    clip = np.random.default_rng(4).normal(size=700)
    df = spark.createDataFrame([(clip.tolist(),)], "clip array<double>")
    got = np.array(df.select(signals.short_time_magnitudes(F.col("clip")).alias("m")).first()["m"])
    padded = np.concatenate([clip, np.zeros(16_000 - 700)])
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(255) / 254)
    expected = np.array([np.abs(np.fft.rfft(padded[i * 128 : i * 128 + 255] * window, 256)) for i in range(124)])
    assert got.shape == (124, 129) and np.allclose(got, expected)


def test_missing_vectors_stay_missing(spark, frames):
    df, _, _ = frames
    model = linear.ridge_fit(df, "x", "y", [0.0])
    few = spark.createDataFrame([(1, [1.0] * 6), (2, None)], "id int, x array<double>").coalesce(1)
    got = {r["id"]: r for r in linear.linear_scores(few, "x", model, 2).select(
        "id", "scores", linear.project(F.col("x"), linear.principal_components(df, "x", 2)).alias("p"),
        signals.short_time_magnitudes(F.col("x"), 16, 8, 4, 8).alias("m"),
        signals.short_time_magnitudes(F.col("x"), 6, 8, 4, 8).alias("short"),
    ).collect()}
    assert len(got[1]["scores"]) == 2 and len(got[1]["p"]) == 2 and len(got[1]["m"]) == 3 and got[1]["short"] == []
    assert got[2]["scores"] is None and got[2]["p"] is None and got[2]["m"] is None


# Neighbours -------------------------------------------------------------------------------------


def brute_neighbours(x, k):
    distance = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    return [
        [(j, distance[i, j]) for j in sorted(range(len(x)), key=lambda j: (distance[i, j], j))[:k]]
        for i in range(len(x))
    ]


@pytest.mark.parametrize("shape", ["spread", "clustered", "copies", "line"])
def test_neighbours_are_exact_in_any_blocking(spark, shape, monkeypatch):
    draw = np.random.default_rng(6)
    x = draw.normal(size=(120, 5))
    if shape == "clustered":
        x += 30 * draw.integers(0, 4, 120)[:, None]
    if shape == "copies":
        x[:50] = x[0]  # one group of copies is more than a third of the rows
        x[60:64] = x[119]
    if shape == "line":  # very uneven cells
        x = np.zeros((120, 5))
        x[:, 0] = 1.2 ** np.arange(120)
    monkeypatch.setattr(metric_tree, "PIECE_ROWS", 30)
    monkeypatch.setattr(metric_tree, "PIECE_PARTNERS", 5)
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(120)] + [(500, None)], "id bigint, v array<double>")
    got = neighbours.nearest_neighbours(df, "id", "v", 4, block_rows=10, fanout=4).orderBy("id", "rank").toPandas()
    expected = brute_neighbours(x, 4)
    assert len(got) == 480
    for i, part in got.groupby("id"):
        assert part["neighbour"].tolist() == [j for j, _ in expected[i]]
        assert np.allclose(part["distance"], [d for _, d in expected[i]])


def test_the_tree_has_levels_and_bounded_leaves(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(300, 3)) + 40 * draw.integers(0, 4, (300, 1))
    points = spark.createDataFrame([(i, x[i].tolist()) for i in range(300)], "id bigint, v array<double>")
    tree = metric_tree.build(points, 20, 3)
    assert len(tree.levels) >= 3
    leaves = {r["leaf"]: r["n"] for r in tree.rows.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    assert sum(leaves.values()) == 300 and max(leaves.values()) <= 20
    nodes = {r["node"]: r for r in tree.levels[-1].collect()}
    assert {n: r["n"] for n, r in nodes.items()} == leaves
    for row in tree.rows.collect():
        node = nodes[row["leaf"]]
        assert np.linalg.norm(np.array(row["v"]) - node["centre"]) <= node["radius"] + 1e-9
    # far leaves are ruled out
    assert metric_tree.leaf_pairs(tree, 3).count() < len(leaves) ** 2 / 2


def test_a_share_of_the_leaves_finds_most_neighbours(spark):
    draw = np.random.default_rng(9)
    x = draw.normal(size=(400, 8)) + 6 * draw.normal(size=(12, 8))[draw.integers(0, 12, 400)]
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(400)], "id bigint, v array<double>")
    found = neighbours.nearest_neighbours(df, "id", "v", 5, block_rows=32, fanout=8, share=0.5).collect()
    truth = {(i, j) for i, near in enumerate(brute_neighbours(x, 5)) for j, _ in near}
    assert len(found) == 2000
    assert len({(r["id"], r["neighbour"]) for r in found} & truth) >= 0.9 * len(truth)


def test_a_share_is_of_the_leaves_nearest_to_the_point(spark, monkeypatch):
    draw = np.random.default_rng(10)
    x = draw.normal(size=(300, 4)) + 8 * draw.normal(size=(6, 4))[draw.integers(0, 6, 300)]
    points = spark.createDataFrame([(i, x[i].tolist()) for i in range(300)], "id bigint, v array<double>")
    monkeypatch.setattr(metric_tree, "COARSE", 10_000)
    monkeypatch.setattr(metric_tree, "QUERY_ROWS", 2)  # blocks of 35 queries
    monkeypatch.setattr(metric_tree, "TILE", 16)
    monkeypatch.setattr(metric_tree, "PIECE_PARTNERS", 3)
    got = {}
    for r in metric_tree.neighbours(points, 5, 20, 4, 0.4).collect():
        got.setdefault(r["id"], []).append((r["distance"], r["neighbour"]))
    tree = metric_tree.build(points, 20, 4)
    leaf_of = {r["id"]: r["leaf"] for r in tree.rows.collect()}
    shapes = {r["node"]: (np.array(r["centre"]), r["radius"]) for r in tree.levels[-1].collect()}
    bound = {r["q"]: r["reach"] for r in metric_tree.leaf_pairs(tree, 5).collect()}
    for i in range(300):
        distance = np.linalg.norm(x - x[i], axis=1)
        own = sorted(distance[[j for j in range(300) if leaf_of[j] == leaf_of[i]]])
        reach = min(own[4] if len(own) >= 5 else np.inf, bound[leaf_of[i]])
        gaps = sorted((np.linalg.norm(x[i] - c) - r, n) for n, (c, r) in shapes.items() if n != leaf_of[i])
        gaps = [g for g in gaps if g[0] - 1e-6 <= reach]
        seen = {leaf_of[i]} | {n for _, n in gaps[: int(np.ceil(len(gaps) * 0.4))]}
        expected = sorted((distance[j], j) for j in range(300) if leaf_of[j] in seen)[:5]
        assert [j for _, j in sorted(got[i])] == [j for _, j in expected]


def test_rows_are_sent_once_to_a_block_of_queries(spark):
    # without clusters every point may have neighbours in every leaf
    x = np.random.default_rng(11).normal(size=(600, 24))
    points = spark.createDataFrame([(i, x[i].tolist()) for i in range(600)], "id bigint, v array<double>")
    tree = metric_tree.build(points, 20, 16)
    leaves = tree.levels[-1].count()
    laid = metric_tree._laid_out(tree, 5)
    sent = {r["kind"]: r["count"] for r in laid.groupBy("kind").count().collect()}
    blocks = laid.agg(F.count_distinct("block")).first()[0]
    assert leaves > 50 and blocks <= np.sqrt(600) / metric_tree.QUERY_ROWS + 1
    assert sent == {metric_tree.QUERY: 600, metric_tree.LEAF: leaves * blocks, metric_tree.TARGET: 600 * blocks}


@pytest.mark.parametrize("shape", ["spread", "offset", "near", "tiny", "huge"])
def test_a_block_of_queries_finds_what_all_pairs_find(shape):
    draw = np.random.default_rng(13)
    x = draw.normal(size=(1500, 6))
    x = {
        "spread": x,
        "offset": x + 1e5,  # single precision cannot tell these apart
        "near": np.repeat(x[:50], 30, axis=0) + 1e-5 * x,
        "tiny": x * 1e-30,
        "huge": x * 1e20,
    }[shape]
    ids, leaves = draw.permutation(1500), np.arange(1500) // 100
    queries = metric_tree._Queries(ids[200:900], x[200:900], leaves[200:900], np.full(700, np.inf), 7, 1.0)
    shapes = {n: (x[100 * n], np.linalg.norm(x[100 * n : 100 * n + 100] - x[100 * n], axis=1).max()) for n in range(15)}
    for start in range(0, 1500, 400):
        some = slice(start, start + 400)
        queries.meet(ids[some], x[some], leaves[some], shapes)
    got = [np.concatenate(c) for c in zip(*queries.found())]
    for a, b in zip(got, metric_tree.closest(ids[200:900], x[200:900], ids, x, 7)):
        assert np.array_equal(a, b)


def test_ids_may_be_text_or_missing(spark, monkeypatch):
    monkeypatch.setattr(metric_tree, "QUERY_ROWS", 1)
    for kind, names in (("string", [f"n{i:02d}" for i in range(40)]), ("int", [None, *range(1, 40)])):
        df = spark.createDataFrame([(n, [float(i), 0.0]) for i, n in enumerate(names)], f"id {kind}, v array<float>")
        found = {}
        for r in neighbours.nearest_neighbours(df, "id", "v", 3, block_rows=8, fanout=3).orderBy("rank").collect():
            found.setdefault(r["id"], []).append(r["neighbour"])
        assert len(found) == 40
        assert found[names[0]] == names[:3]
        assert found[names[20]] == [names[20], names[19], names[21]]  # a tie goes to the smaller id


def test_more_neighbours_than_rows(spark):
    df = spark.createDataFrame([(i, [float(i)]) for i in range(3)], "id bigint, v array<double>")
    assert neighbours.nearest_neighbours(df, "id", "v", 10).count() == 9


def two_cliques(spark):
    edges = [(a, b) for block in (range(5), range(5, 10)) for a in block for b in block if a < b] + [(4, 5)]
    return neighbours.undirected(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b")


def test_modularity_of_two_cliques(spark):
    labels = spark.range(10).select("id", (F.col("id") >= 5).cast("int").alias("cluster"))
    got = neighbours.modularity(two_cliques(spark), labels).first()
    assert got["clusters"] == 2
    assert got["modularity"] == pytest.approx(20 / 21 - 0.5)


def test_clusters_are_the_cliques(spark):
    got = communities.cluster_graph(two_cliques(spark)).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["cluster"], set()).add(r["id"])
    assert sorted(map(sorted, groups.values())) == [list(range(5)), list(range(5, 10))]


def pieces_of(edges, labels):
    """How many connected pieces the clusters fall into."""
    parent = {i: i for i in labels}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges:
        if labels[a] == labels[b]:
            parent[root(a)] = root(b)
    return len({root(i) for i in labels})


def plain_modularity(edges, labels):
    degree, inside = {}, 0
    for a, b in edges:
        degree[labels[a]] = degree.get(labels[a], 0) + 1
        degree[labels[b]] = degree.get(labels[b], 0) + 1
        inside += labels[a] == labels[b]
    return inside / len(edges) - sum((d / (2 * len(edges))) ** 2 for d in degree.values())


@pytest.mark.parametrize("blocks", ["one", "many"])
def test_clusters_are_connected_and_better_than_the_planted(spark, blocks, monkeypatch):
    draw = np.random.default_rng(12)
    group = {i: i // 25 for i in range(150)}
    edges = [(a, b) for a in range(150) for b in range(a) if draw.random() < (0.3 if group[a] == group[b] else 0.01)]
    edges += [(0, i) for i in range(1, 150, 4)] + [(200, 201), (300, 301)]
    edges = sorted({tuple(sorted(e)) for e in edges})
    if blocks == "many":
        monkeypatch.setattr(communities, "BLOCK_EDGES", 300)
        monkeypatch.setattr(communities, "HUB_EDGES", 30)
    graph = neighbours.undirected(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b")
    labels = {r["id"]: r["cluster"] for r in communities.cluster_graph(graph).collect()}
    assert labels.keys() == {i for e in edges for i in e}
    assert all(labels[c] == c and c <= i for i, c in labels.items())
    assert pieces_of(edges, labels) == len(set(labels.values()))
    planted = {i: group.get(i, i // 100 * 100) for i in labels}
    assert plain_modularity(edges, labels) >= plain_modularity(edges, planted) - (0.02 if blocks == "many" else 0)


def test_graphs_of_millions_of_edges_need_no_rounds(spark, monkeypatch):
    draw = np.random.default_rng(14)
    group = np.arange(11_000) // 100
    near = group.repeat(8) * 100 + draw.integers(0, 100, 88_000)
    far = draw.integers(0, 11_000, 33_000)
    ends = np.concatenate([np.arange(11_000).repeat(8), np.arange(11_000).repeat(3)]), np.concatenate([near, far])
    frame = pd.DataFrame({"a": ends[0], "b": ends[1]})
    graph = materialize(neighbours.undirected(spark.createDataFrame(frame), "a", "b"), "graph")
    assert graph.count() > 200_000

    def rounds(*_):
        raise AssertionError("rounds of joins on a graph that one task can hold")

    monkeypatch.setattr(communities, "settled", rounds)
    found = communities.cluster_graph(graph)
    planted = spark.createDataFrame(pd.DataFrame({"id": np.arange(11_000), "cluster": group}))
    reached, given = (neighbours.modularity(graph, x).first()["modularity"] for x in (found, planted))
    assert found.count() == 11_000 and reached >= given - 0.01


def test_disconnected_clusters_are_split(spark):
    edges = [(1, 2), (2, 3), (7, 8), (3, 20)]
    graph = neighbours.undirected(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (7, 1), (8, 1), (20, 5)], "id bigint, cluster bigint")
    got = communities._connected(graph, labels).collect()
    assert sorted((r["id"], r["cluster"]) for r in got) == [(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (20, 20)]


def test_moves_in_turn_only_gain():
    rows = [(a, b) for a in range(6) for b in range(6) if a != b and a // 3 == b // 3] + [(2, 3), (3, 2)]
    frame = pd.DataFrame([(a, b, 1.0, a, 2.0 + (a in (2, 3)), 2.0 + (a in (2, 3)), b, 2.0 + (b in (2, 3)), 14.0) for a, b in rows])
    frame.columns = ["src", "dst", "weight", "src_cluster", "src_size", "degree", "dst_cluster", "dst_size", "total"]
    moved = dict(communities._settle_block(frame).itertuples(index=False, name=None))
    labels = {n: moved.get(n, n) for n in range(6)}
    assert len({labels[n] for n in (0, 1, 2)}) == len({labels[n] for n in (3, 4, 5)}) == 1
    assert labels[0] != labels[5]
