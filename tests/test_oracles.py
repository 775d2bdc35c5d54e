"""Every bound query against its oracle on the smallest tables."""

import re

import pytest

import __spark_entry__ as contract
from tests.conftest import SMALL
from tests.oracle import connect, differences

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, connection, key):
    problems = differences(QUERIES[key](spark, SMALL), connection, ORACLES[key])
    assert [p for p in problems if p != "oracle result is empty"] == []


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, key):
    assert QUERIES[key](spark, SMALL).count() > 0


def test_entry_has_a_stable_schema(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["yyyymm", "day", "avg_1", "avg_5", "avg_10", "avg_15", "y"]


def test_readme_lists_exactly_the_queries():
    from pathlib import Path

    text = Path(__file__).parent.parent.joinpath("README.md").read_text()
    table = text[text.index("## Coverage") : text.index("### Re-aimed")]
    listed = {name for name in re.findall(r"`([a-z0-9_]+)`", table)}
    # the training-data pipeline has a section and tests of its own
    own = {k for k in QUERIES if not re.match(r"op\d+_|pipeline$", k)}
    assert own - listed <= {k for k in own if k.startswith("volume_")}
    assert listed <= own


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
