"""Plans hold no operator that puts everything in one task or pairs everything with everything."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

import __spark_entry__ as contract
from millrace.plans import selection, summaries
from millrace.sources.tables import table
from tests.conftest import SMALL

QUERIES = contract.queries()
# Models are fitted while these are built, which `test_oracles` does once already.
SKIPPED = {k for k in QUERIES if k.startswith("churn_")} | {"graph_clusters", "cluster_quality"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def global_windows(plan):
    """Window specifications whose first part is an ordering or a frame, so without keys."""
    starts = re.findall(r"windowspecdefinition\(([^,]*),", plan)
    return [s for s in starts if re.search(r" (ASC|DESC) |specifiedwindowframe", s)]


def single_task_inputs(plan):
    """Operators that feed an exchange to one partition."""
    lines = [re.sub(r"^[\s:+\-*()0-9]*", "", line) for line in plan.splitlines()]
    return [re.split(r"[ (]", b)[0] for a, b in zip(lines, lines[1:]) if a.startswith("Exchange SinglePartition")]


# What may feed one task: partial aggregates and limits, which are one or a few rows per task.
BOUNDED = ("HashAggregate", "ObjectHashAggregate", "SortAggregate", "LocalLimit")


@pytest.mark.parametrize("key", sorted(set(QUERIES) - SKIPPED))
def test_nothing_whole_in_one_task(spark, key):
    plan = plan_of(QUERIES[key](spark, SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert global_windows(plan) == []
    assert [s for s in single_task_inputs(plan) if not s.startswith(BOUNDED)] == []
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python


def test_the_checks_see_what_they_forbid(spark):
    ids = spark.range(10)
    assert global_windows(plan_of(ids.select(F.row_number().over(Window.orderBy("id")))))
    assert not global_windows(plan_of(ids.select(F.row_number().over(Window.partitionBy("id").orderBy("id")))))
    assert single_task_inputs(plan_of(ids.select(F.row_number().over(Window.orderBy("id"))))) == ["Range"]
    assert single_task_inputs(plan_of(ids.agg(F.sum("id")))) == ["HashAggregate"]


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(summaries.daily_quantity(spark, SMALL))
    assert re.search(r"ReadSchema: struct<l_quantity:double,l_shipdate:timestamp_ntz>", plan)


def test_filters_reach_the_scan(spark):
    plan = plan_of(selection.value_exclusion(spark, SMALL))
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,signup))]" in plan


def test_top_n_limits_groups_before_the_shuffle(spark):
    assert plan_of(QUERIES["topn_per_group"](spark, SMALL)).count("WindowGroupLimit") == 2


def test_sums_combine_before_the_shuffle(spark):
    assert "partial_sum" in plan_of(QUERIES["cell_qc"](spark, SMALL))


def test_library_never_pulls_frames_to_the_driver():
    for path in Path(__file__).parent.parent.joinpath("millrace").rglob("*.py"):
        text = path.read_text()
        for banned in ("toPandas", "localCheckpoint", "crossJoin", "foreachPartition", ".rdd"):
            assert banned not in text, f"{banned} in {path.name}"
        if not path.match("*/plans/*"):
            assert "toLocalIterator" not in text


def test_tables_are_all_there(spark):
    assert table(spark, SMALL, "region").count() == 5
