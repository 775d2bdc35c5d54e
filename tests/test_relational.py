"""Filters, joins, summaries, grid and primes on hand-made rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import arrays, codecs, dates, strings
from millrace.operators import aggregates, evaluation, filters, grid, joins, moving, onehot, primes


def values(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# Joins -----------------------------------------------------------------------------


def test_inner_join_matches_missing_keys_and_suffixes(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y"), (3, "z")], "k int, v string")
    joined = joins.inner_join(left, right, "k")
    assert joined.columns == ["k", "v_x", "v_y"]
    assert set(map(tuple, joined.collect())) == {(1, "a", "x"), (None, "b", "y")}


def test_salted_join_equals_plain_join(spark):
    left = spark.range(20).withColumn("name", F.concat(F.lit("n"), "id"))
    right = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20).alias("id"), F.col("id").alias("row")
    )
    assert joins.hot_keys(right, "id", 0.05)
    salted = joins.inner_join(left, right, "id")
    plain = joins.inner_join(left, right, "id", hot_share=None)
    assert values(salted, "id", "name", "row") == values(plain, "id", "name", "row")
    assert salted.count() == 600


def test_a_hot_key_is_joined_in_several_tasks(spark):
    left = spark.range(50).withColumn("name", F.lit("x"))
    right = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 50).alias("id"), F.col("id").alias("row"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        largest = {
            share: max(
                r["count"]
                for r in joins.inner_join(left, right, "id", share).groupBy(F.spark_partition_id().alias("p")).count().collect()
            )
            for share in (0.05, None)
        }
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert largest[None] > 10_000 > 1.5 * largest[0.05]


@pytest.mark.parametrize("n, chunk", [(1, 5), (10, 3), (5000, 5000), (5001, 5000), (12, 12)])
def test_batch_ranges_cover_all_rows(spark, n, chunk):
    got = values(joins.batch_ranges(spark.range(n), chunk), "start", "end")
    assert got[0][0] == 0 and got[-1][1] == n
    assert all(a[1] == b[0] for a, b in zip(got, got[1:]))
    assert all(end - start <= chunk for start, end in got)
    assert len(got) == -(-n // (-(-n // -(-n // chunk))))


def test_no_ranges_for_no_rows(spark):
    assert joins.batch_ranges(spark.range(0), 5).count() == 0


def test_ids_and_indexes_are_inverse(spark):
    ids = spark.range(62 * 62).select("id", joins.id_text(F.col("id")).alias("text"))
    back = ids.select("id", "text", joins.id_index(F.col("text")).alias("index"))
    assert back.where("id <> index").count() == 0
    assert back.select("text").distinct().count() == 3844
    assert values(back.where("id in (0, 1, 3843)"), "id", "text") == [(0, "aa"), (1, "ab"), (3843, "99")]


# Filters -----------------------------------------------------------------------------


def test_regex_filter_needs_the_key(spark):
    df = spark.createDataFrame([("STEO.ZWHD_X.M",), ("STEO.ZWHD_A_B.M",), (None,)], "series_id string")
    kept = filters.keep_matching(df, "series_id", r"^STEO.ZWHD_[^_]*\.M$")
    assert values(kept, "series_id") == [("STEO.ZWHD_X.M",)]


def test_missing_text_contains_nothing(spark):
    df = spark.createDataFrame([("Kate Mara",), (None,)], "cast string")
    found = df.select(filters.contains_pattern(F.col("cast"), "Kate").alias("f")).collect()
    assert [r["f"] for r in found] == [True, False]


def test_first_record_raises_when_nothing_matches(spark):
    df = spark.range(3)
    assert filters.first_record(df, F.col("id") > 0, ["id"])["id"] == 1
    with pytest.raises(LookupError):
        filters.first_record(df, F.col("id") > 9, ["id"])


def test_zero_denominator_gives_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double")
    got = [r["r"] for r in filters.add_ratios(df, {"r": ("a", "b")}).collect()]
    assert got == [None, 0.5]


def test_incomplete_rows_include_nan(spark):
    df = spark.createDataFrame([(1.0, 1), (float("nan"), 2), (None, 3)], "a double, id int")
    assert values(filters.drop_incomplete(df), "id") == [(1,)]


def test_support_filter_counts_genes_in_remaining_cells(spark):
    long = spark.createDataFrame(
        [("c1", "a"), ("c1", "b"), ("c2", "a"), ("c2", "b"), ("c3", "a"), ("c3", "c"), ("c4", "c")],
        "cell string, gene string",
    )
    kept = filters.by_support(long, "cell", "gene", 2, 2)
    assert values(kept, "cell", "gene") == [
        ("c1", "a"), ("c1", "b"), ("c2", "a"), ("c2", "b"), ("c3", "a"),
    ]


def test_shards_partition_names(spark):
    import hashlib

    names = spark.range(300).select(F.concat(F.lit("f"), "id").alias("f"))
    shards = [filters.hash_shard(names, "f", k, 4) for k in range(1, 5)]
    assert sum(s.count() for s in shards) == 300
    for k, shard in enumerate(shards):
        for r in shard.collect():
            assert int(hashlib.md5(r["f"].encode()).hexdigest(), 16) % 4 == k
    with pytest.raises(ValueError):
        filters.hash_shard(names, "f", 0, 4)


def test_row_slice(spark):
    got = filters.slice_rows(spark.range(10), ["id"], 3, 6)
    assert values(got, "id") == [(3,), (4,), (5,)]


def test_category_names_by_position():
    assert aggregates.rename_by_position(["x", "y"], ["b", "a"]) == {"a": "x", "b": "y"}
    with pytest.raises(ValueError):
        aggregates.rename_by_position(["x"], ["b", "a"])


# Summaries -----------------------------------------------------------------------------


def test_group_total_drops_missing_keys(spark):
    df = spark.createDataFrame([("NY", 1), (None, 2), ("CA", 3), ("NY", 4)], "state string, n int")
    got = aggregates.grouped_total(df, "state", "n").collect()
    assert [tuple(r) for r in got] == [("CA", 3), ("NY", 5)]


def test_month_means_ignore_missing_values(spark):
    df = spark.createDataFrame(
        [("s", "202001", 1.0), ("s", "202101", 3.0), ("s", "202102", None)], "name string, m string, v double"
    )
    means = aggregates.month_of_year_mean(df, ["name"], "m", "v")
    wide = aggregates.series_by_month(means, ["name"]).first()
    assert (wide["m1"], wide["m2"], wide["m3"]) == (2.0, None, None)
    tall = aggregates.months_by_series(means, "name", ["s"]).orderBy("month").collect()
    assert [(r["month"], r["s"]) for r in tall] == [(1, 2.0), (2, None)]


def test_constant_column_scales_to_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = values(aggregates.minmax_scale(df, ["a", "b"]).select("a", F.col("b").isNull().alias("b")), "a", "b")
    assert got == [(0.0, True), (1.0, True)]


def test_status_rollup(spark):
    rows = [(f"/pmt/poll/{i}", int(i == 1002)) for i in range(1104)]
    df = spark.createDataFrame(rows, "path string, exit int")
    got = {
        r["node"]: (r["leaves"], r["errors"], r["failed"], r["done"])
        for r in aggregates.status_rollup(df, "path", F.col("exit") != 0, F.col("exit") == 0)
        .where("node in ('/pmt', '/pmt/poll', '/pmt/poll/7', '/pmt/poll/1002')").collect()
    }
    assert got["/pmt"] == got["/pmt/poll"] == (1104, 1, True, False)
    assert got["/pmt/poll/7"] == (1, 0, False, True)
    assert got["/pmt/poll/1002"] == (1, 1, True, False)


def test_head_and_tail_overlap_once(spark):
    assert aggregates.head_and_tail(spark.range(4), "id", 3).count() == 4
    assert values(aggregates.head_and_tail(spark.range(9), "id", 3), "id") == [(0,), (1,), (2,), (6,), (7,), (8,)]


def test_one_hot_leaves_numbers_alone_and_takes_any_number_of_categories(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "s string, n int")
    got = onehot.signed_one_hot(df, ["s", "n"])
    assert got.columns == ["n", "s_a", "s_b"]
    assert values(got, "n", "s_a", "s_b") == [(1, 1, -1), (2, -1, 1), (3, -1, -1)]
    many = spark.range(1100).selectExpr("cast(id as string) as s")
    assert len(onehot.signed_one_hot(many, ["s"]).columns) == 1100


# Evaluation ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def scored(spark):
    draw = np.random.default_rng(3)
    proba = np.round(draw.random(400), 2)
    proba[:6] = [0.0, 1.0, 0.29, 0.57, 0.58, 0.07]
    truth = (draw.random(400) < proba).astype(int)
    return pd.DataFrame({"y": truth, "p": proba})


def test_roc_sweep_counts_strictly_above(spark, scored):
    got = evaluation.roc_sweep(spark.createDataFrame(scored), "y", "p").orderBy("step").toPandas()
    assert len(got) == 101
    for i, row in got.iterrows():
        over = scored["p"] > i / 100
        assert row["true_positives"] == (over & (scored["y"] == 1)).sum()
        assert row["false_positives"] == (over & (scored["y"] == 0)).sum()
    assert got["tpr"].is_monotonic_decreasing and got["fpr"].is_monotonic_decreasing


def test_area_counts_ties_half(spark, scored):
    pos, neg = (scored.loc[scored["y"] == c, "p"].to_numpy() for c in (1, 0))
    won = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    got = evaluation.area_under_curve(spark.createDataFrame(scored), "y", "p").first()
    assert got["auc"] == pytest.approx(won / (len(pos) * len(neg)), abs=1e-12)


def test_area_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.3)], "y int, p double")
    assert evaluation.area_under_curve(df, "y", "p").first()["auc"] is None


def test_curve_ends_at_one(spark, scored):
    points = evaluation.roc_points(spark.createDataFrame(scored), "y", "p").orderBy("score").toPandas()
    assert points["tpr"].iloc[0] == points["fpr"].iloc[0] == 1.0
    assert len(points) == scored["p"].nunique()


def test_report_of_a_known_case(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] + [(0, 0)] * 4 + [(0, 1)] * 2 + [(2, 0)]
    got = {r["label"]: r for r in evaluation.classification_report(spark.createDataFrame(rows, "y int, p int"), "y", "p").collect()}
    assert got["1"]["precision"] == pytest.approx(3 / 5) and got["1"]["recall"] == pytest.approx(3 / 4)
    assert got["2"]["f1"] == 0.0 and got["2"]["support"] == 1
    assert got["accuracy"]["f1"] == pytest.approx(7 / 11)
    assert got["weighted avg"]["recall"] == pytest.approx(7 / 11)


def test_label_sets(spark):
    df = spark.createDataFrame([([1, 2, 3], [2, 9]), ([4], [4])], "p array<int>, a array<int>")
    assert tuple(evaluation.set_confusion(df, "p", "a").first()) == (2, 2, 1)


def test_r2_is_null_without_variation(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 1.0, 2.0), ("b", 1.0, 1.0), ("b", 3.0, 2.0)], "g string, y double, p double")
    assert {r["g"]: r["r2"] for r in evaluation.r_squared(df, "y", "p", ["g"]).collect()} == {"a": None, "b": 0.5}


# Moving averages ------------------------------------------------------------------------------


def test_lagged_averages_match_pandas(spark):
    days = pd.bdate_range("2019-10-03", "2020-04-20")
    days = days[~((days.year == 2020) & (days.month == 2))]  # a missing month
    pdf = pd.DataFrame({"day": days, "value": np.random.default_rng(1).integers(1, 99, len(days)).astype(float)})
    df = spark.createDataFrame(pdf).withColumn("day", F.col("day").cast("date"))
    got = moving.training_rows(df).orderBy("day").toPandas()
    parts = []
    months = sorted(pdf["day"].dt.to_period("M").unique())
    for month in months[1:]:
        both = pdf[pdf["day"].dt.to_period("M").isin([month - 1, month])].copy()
        for w in moving.WINDOWS:
            both[f"avg_{w}"] = both["value"].rolling(w).mean().shift(1)
        parts.append(both[both["day"].dt.to_period("M") == month])
    expected = pd.concat(parts).dropna()
    assert got["day"].tolist() == [d.date() for d in expected["day"]]
    for w in moving.WINDOWS:
        assert np.allclose(got[f"avg_{w}"], expected[f"avg_{w}"])
    late = moving.lagged_averages(df, start="20200300").select("yyyymm").distinct().collect()
    assert sorted(r[0] for r in late) == ["202003", "202004"]


# Grid ------------------------------------------------------------------------------------------


def test_text_to_rows(spark):
    df = spark.createDataFrame([("101\n001\n111",), ("10100",), ("x",), ("1",)], "t string")
    got = [r["r"] for r in df.select(strings.grid_rows(F.col("t")).alias("r")).collect()]
    assert got == [["101", "001", "111"], ["10", "10", "0"], [], ["1"]]


def test_cells_to_rows(spark):
    cells = spark.createDataFrame([(0, 0, False), (1, 0, False), (0, 1, True), (1, 1, True)], "x int, y int, alive boolean")
    got = grid.rows_from_cells(cells).orderBy("y").collect()
    assert [r["cells"] for r in got] == ["00", "11"]


def test_wide_rows_are_joined_from_pieces(spark):
    width = 3000
    cells = spark.range(width).select(F.col("id").cast("int").alias("x"), F.lit(0).alias("y"), (F.col("id") % 7 == 0).alias("alive"))
    got = grid.rows_from_cells(cells).first()["cells"]
    assert got == "".join("1" if i % 7 == 0 else "0" for i in range(width))


def test_neighbours_of_a_known_grid(spark):
    df = spark.createDataFrame([("010001111",)], "t string")
    cells = grid.neighbour_counts(grid.cells_from_text(df, "t")).orderBy("y", "x").collect()
    assert [c["neighbors"] for c in cells] == [1, 1, 2, 3, 5, 3, 1, 3, 2]


def test_one_pass_rules_equal_five_filters(spark):
    rows = [(a, n) for a in (True, False) for n in range(9)]
    cells = spark.createDataFrame([(i, 0, a, n) for i, (a, n) in enumerate(rows)], "x int, y int, alive boolean, neighbors int")
    a, n = F.col("alive"), F.col("neighbors")
    filters_ = [
        (a & (n < 2), "isolate", False), (a & n.isin(2, 3), "survive", True), (a & (n > 3), "crowd", False),
        (~a & (n == 3), "reproduce", True), (~a & (n != 3), "ignore", False),
    ]
    united = None
    for condition, rule, lives in filters_:
        part = cells.where(condition).select("x", F.lit(rule).alias("rule"), F.lit(lives).alias("alive_next"))
        united = part if united is None else united.unionByName(part)
    assert values(grid.classify_cells(cells), "x", "rule", "alive_next") == values(united, "x", "rule", "alive_next")


# Primes ------------------------------------------------------------------------------------------


def test_primes_below_200(spark):
    got = [r["id"] for r in primes.prime_rows(spark.range(200), "id").orderBy("id").collect()]
    assert len(got) == 46 and got[:4] == [2, 3, 5, 7] and got[-1] == 199
    assert all(all(p % d for d in range(2, p)) for p in got)


@pytest.mark.parametrize("rule, lower", [("nagura", 25), ("bertrand", 4)])
def test_primes_are_dense_and_gaps_are_found(spark, rule, lower):
    found = primes.prime_rows(spark.range(400), "id")
    assert primes.sparse_ranges(found, "id", lower, rule).count() == 0
    holed = found.where("id < 40 or id > 97")
    keys = sorted(r["id"] for r in holed.collect())
    close = (lambda n, p: n < p and 5 * p < 6 * n) if rule == "nagura" else (lambda n, p: n < p < 2 * n - 2)
    brute = {n for n in range(lower, max(keys)) if not any(close(n, p) for p in keys)}
    ranges = primes.sparse_ranges(holed, "id", lower, rule).collect()
    assert brute and {n for r in ranges for n in range(r["first_n"], r["last_n"] + 1)} == brute


# Functions ---------------------------------------------------------------------------------------


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_string_functions(spark):
    assert one(spark, strings.year_month(F.lit("2020-03-09"))) == "202003"
    assert one(spark, strings.zero_pad(F.lit("7"), 4)) == "0007"
    assert one(spark, strings.zero_pad(F.lit("123456"), 4)) == "123456"
    assert one(spark, strings.shard_bucket(F.lit("train3554"))) == "train35__"
    assert one(spark, strings.first_number(F.lit("Served 12 of 30"))) == "12"
    assert one(spark, strings.first_number(F.lit("none"))) is None
    assert one(spark, strings.cut(F.lit("a:b:c"), ":", 2)) == "b"
    assert one(spark, strings.cut(F.lit("plain"), ":", 2)) == "plain"
    assert one(spark, strings.cut(F.lit("a:b"), ":", 5)) == ""
    assert one(spark, strings.delete_characters(F.lit('"x", y'), '", ')) == "xy"
    assert one(spark, strings.parent_name(F.lit("file:/d/yes/a.wav"))) == "yes"
    assert one(spark, strings.strip_suffix(F.lit("a.b.csv"))) == "a.b"


def test_date_functions(spark):
    assert one(spark, dates.previous_month(F.lit("202001"))) == "201912"
    days = one(spark, dates.month_days(F.lit("2020-02-10").cast("date")))
    assert len(days) == 29 and days[0].day == 1
    at = F.lit("2024-01-01 10:00:03.7").cast("timestamp_ntz")
    assert one(spark, dates.clock_text(dates.even_second(at))) == "10:00:02"


def test_array_functions(spark):
    numbers = F.array(F.lit(1.0), F.lit(2.0))
    assert one(spark, arrays.pad_to(numbers, 4)) == [1.0, 2.0, 0.0, 0.0]
    assert one(spark, arrays.pad_to(F.lit(None).cast("array<double>"), 4)) is None
    with pytest.raises(Exception, match="longer"):
        one(spark, arrays.pad_to(numbers, 1))
    assert one(spark, arrays.multi_hot(F.array(F.lit(2), F.lit(0)), 4)) == [1, 0, 1, 0]
    assert one(spark, arrays.label_position(F.lit("b"), ["a", "b"])) == 1
    assert one(spark, arrays.label_position(F.lit("z"), ["a", "b"])) == 0
    assert one(spark, arrays.frames(F.array(*[F.lit(float(i)) for i in range(6)]), 4, 2)) == [[0, 1, 2, 3], [2, 3, 4, 5]]
    assert one(spark, arrays.frames(numbers, 3, 1)) == []
    assert one(spark, arrays.bytes_to_floats(F.encode(F.lit("AB"), "UTF-8"))) == [65.0, 66.0]


def test_codecs(spark):
    assert one(spark, codecs.json_entries(F.lit('{"foo": 2, "bar": 3}'))) == {"foo": 2, "bar": 3}
    assert one(spark, codecs.json_field(F.lit('{"message": "Hello World"}'), "message")) == "Hello World"
    assert one(spark, codecs.flag_to_face(codecs.face_to_flag(F.lit(":)")))) == ":)"
    assert one(spark, codecs.face_to_flag(F.lit("other"))) is False


def test_typed_function_restores_types(spark):
    def half(n: int, name: str) -> float:
        return n / 2 + len(name)

    assert one(spark, codecs.typed_udf(half)(F.lit("7"), F.lit("ab"))) == 5.5
    with pytest.raises(TypeError):
        codecs.typed_udf(lambda x: x)
