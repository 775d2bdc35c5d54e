"""Ordered operators against pandas, with a hot key, ties at slice edges and odd sizes."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators.sequences import SLICE, running_sums, slice_layout, with_neighbour, with_ordinal
from millrace.operators.splits import ordered_split, shuffled_split, unique_names


def keyed(n, keys=5, seed=0, hot=0.5):
    draw = np.random.default_rng(seed)
    key = np.where(draw.random(n) < hot, 0, draw.integers(0, keys, n))
    return pd.DataFrame({"k": key, "t": draw.integers(0, 20, n), "id": draw.permutation(n), "v": draw.integers(0, 9, n)})


def frame(spark, pdf):
    return spark.createDataFrame(pdf, "k bigint, t bigint, id bigint, v bigint")


def test_a_hot_key_is_spread_over_slices(spark):
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(7).alias("k"), "id")
    sizes = [r["count"] for r in slice_layout(hot, ["k", "id"], 8).groupBy(SLICE).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.6 * sum(sizes) / 8


def test_ordinal_is_the_sorted_position(spark):
    pdf = keyed(500)
    got = with_ordinal(frame(spark, pdf), ["t", "id"], "at").toPandas().sort_values("at")
    expected = pdf.sort_values(["t", "id"]).reset_index(drop=True)
    assert got["at"].tolist() == list(range(500))
    assert got["id"].tolist() == expected["id"].tolist()


@pytest.mark.parametrize("n", [0, 1, 2, 7])
def test_ordinal_of_few_rows(spark, n):
    got = with_ordinal(frame(spark, keyed(n)), ["t", "id"], "at").toPandas()
    assert sorted(got["at"]) == list(range(n))


def expected_sums(pdf):
    ordered = pdf.sort_values(["k", "t", "id"])
    return ordered.assign(n=ordered.groupby("k").cumcount() + 1, s=ordered.groupby("k")["v"].cumsum())


@pytest.mark.parametrize("hot", [0.0, 0.4, 1.0])
def test_running_sums_per_key(spark, hot):
    pdf = keyed(400, hot=hot)
    got = running_sums(frame(spark, pdf), ["k"], ["t", "id"], {"n": F.lit(1), "s": F.col("v")}).toPandas()
    expected = expected_sums(pdf)
    merged = expected.merge(got, on="id", suffixes=("", "_got"))
    assert len(got) == 400
    assert (merged["n"] == merged["n_got"]).all() and (merged["s"] == merged["s_got"]).all()


@pytest.fixture(params=[10_000, 3])
def batch_rows(spark, request):
    """Slices in one Arrow batch, and in many."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", request.param)
    yield request.param
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("n, keys, seed, slices", [(1, 1, 0, 5), (9, 1, 1, 4), (23, 6, 2, 1), (60, 2, 3, 12), (57, 4, 4, 7)])
def test_running_sums_any_slicing(spark, batch_rows, n, keys, seed, slices):
    pdf = keyed(n, keys, seed)
    got = running_sums(frame(spark, pdf), ["k"], ["t", "id"], {"n": F.lit(1)}, slices=slices).toPandas()
    merged = expected_sums(pdf).merge(got, on="id", suffixes=("", "_got"))
    assert (merged["n"] == merged["n_got"]).all()


def test_running_sums_without_keys_and_with_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, None), (4, 2.5)], "id bigint, v double")
    got = running_sums(df, [], ["id"], {"s": F.col("v")}).orderBy("id").collect()
    assert [r["s"] for r in got] == [0.0, 5.0, 5.0, 7.5]


@pytest.mark.parametrize("by", [[], ["k"]])
def test_running_sums_of_decimals_integers_and_doubles(spark, batch_rows, by):
    df = spark.range(40).selectExpr("id", "id % 2 as k", "cast(id as decimal(12,2)) / 4 as d", "cast(id as int) as i", "id / 8 as f")
    terms = {"sd": F.col("d").cast("decimal(12,2)"), "si": F.col("i"), "sf": F.col("f")}
    result = running_sums(df, by, ["id"], terms, slices=6)
    assert dict(result.dtypes) | {"sd": "decimal(38,2)", "si": "bigint", "sf": "double"} == dict(result.dtypes)
    for r in result.collect():
        ids = [i for i in range(r["id"] + 1) if not by or i % 2 == r["id"] % 2]
        assert (float(r["sd"]), r["si"], r["sf"]) == (sum(i / 4 for i in ids), sum(ids), sum(i / 8 for i in ids))


def test_not_a_number_is_one_key(spark, batch_rows):
    nan = float("nan")
    rows = [(nan, i) for i in range(8)] + [(1.0, 8), (None, 9), (None, 10)]
    got = running_sums(spark.createDataFrame(rows, "k double, id bigint"), ["k"], ["id"], {"n": F.lit(1)}, slices=5).collect()
    assert sorted(r["n"] for r in got) == [1, 1, 1, 2, 2, 3, 4, 5, 6, 7, 8]


def test_rows_are_shuffled_once(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 as k")
    for result in (running_sums(df, ["k"], ["id"], {"n": F.lit(1)}), with_neighbour(df, ["k"], ["id"], {"p": "id"})):
        plan = result._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and not [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "id#" in x]


def test_missing_keys_form_their_own_group(spark):
    rows = [(None, 1), (None, 2), (1, 3), (1, 4), (None, 5)]
    df = spark.createDataFrame(rows, "k bigint, id bigint")
    got = running_sums(df, ["k"], ["id"], {"n": F.lit(1)}).collect()
    assert {(r["k"], r["id"]): r["n"] for r in got} == {(None, 1): 1, (None, 2): 2, (None, 5): 3, (1, 3): 1, (1, 4): 2}


@pytest.mark.parametrize("step", [-1, 1])
def test_neighbour_matches_shift(spark, batch_rows, step):
    pdf = keyed(300)
    got = with_neighbour(frame(spark, pdf), ["k"], ["t", "id"], {"near": "v"}, step).toPandas()
    ordered = pdf.sort_values(["k", "t", "id"])
    ordered["near"] = ordered.groupby("k")["v"].shift(-step)
    merged = ordered.merge(got, on="id", suffixes=("", "_got"))
    assert len(merged) == 300
    assert np.array_equal(merged["near"].to_numpy(float), merged["near_got"].to_numpy(float), equal_nan=True)


def test_neighbour_rejects_other_steps(spark):
    with pytest.raises(ValueError):
        with_neighbour(frame(spark, keyed(2)), [], ["id"], {"x": "v"}, 2)


def test_ordered_split_takes_the_last_fifth(spark):
    split = ordered_split(spark.range(103), ["id"], 0.2).toPandas()
    assert split[split["part"] == "test"]["id"].min() == 103 - 21
    assert (split["part"] == "test").sum() == 21


def test_shuffled_split_has_fixed_counts_and_repeats(spark):
    df = spark.range(100)
    first = shuffled_split(df, "id", 1, 64, 8, 8).toPandas()
    again = shuffled_split(df.repartition(5), "id", 1, 64, 8, 8).toPandas()
    other = shuffled_split(df, "id", 2, 64, 8, 8).toPandas()
    assert first["part"].value_counts().to_dict() == {"train": 64, "unused": 20, "validate": 8, "test": 8}
    assert set(map(tuple, first.to_numpy())) == set(map(tuple, again.to_numpy()))
    assert set(map(tuple, first.to_numpy())) != set(map(tuple, other.to_numpy()))


def brute_unique(names):
    taken, counts, out, seen = set(names), {}, [], set()
    for name in names:
        if name not in seen:
            seen.add(name)
            out.append(name)
            continue
        while True:
            counts[name] = counts.get(name, 0) + 1
            candidate = f"{name}-{counts[name]}"
            if candidate not in taken:
                taken.add(candidate)
                out.append(candidate)
                break
    return out


@pytest.mark.parametrize(
    "names",
    [
        ["a", "b", "a", "a", "c", "b"],
        ["a", "a-1", "a", "a", "a-3", "a", "b", "a-1"],
        ["x", "y"],
        ["a", "a", "a-1", "a-2", "a-2", "a"],
    ],
)
def test_unique_names_skip_names_that_exist(spark, names):
    df = spark.createDataFrame(list(enumerate(names)), "id bigint, name string")
    got = unique_names(df, "name", ["id"]).orderBy("id").collect()
    assert [r["name"] for r in got] == brute_unique(names)
