"""Every registered query against its SQL counterpart on the smallest tables."""

from pathlib import Path

import pytest
from compare import connect, differences

from oreworks.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# Nothing in the smallest tables meets the condition of these.
MAY_BE_EMPTY = {"failed_pages"}

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    problems = differences(QUERIES[name](spark, SF), con, ORACLES[name])
    if name in MAY_BE_EMPTY:
        problems = [p for p in problems if p != "no rows"]
    assert problems == []


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(ORACLES)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 3
