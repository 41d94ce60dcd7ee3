"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest
from oracle import compare, connect, kinds

from gaugeline.plans.table_queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = db.execute(ORACLES[name]).df()
    assert compare(got, want) is None
    assert kinds(got) == kinds(want) or len(got) == 0


def test_no_filter_repeats_the_parse(spark):
    """A filter that the optimizer pushed below a parse holds the text of all its steps and runs once more for every row."""
    for name in sorted(QUERIES):
        if name in ("placeholder_filter", "drop_trailing_col", "wide_to_long", "sensor_join", "quarantine", "header_dim", "file_errors", "whole_file_readings"):
            left, longest = [QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan()], 0
            while left:
                node = left.pop()
                if node.nodeName() == "Filter":
                    longest = max(longest, len(node.condition().toString()))
                left += [node.children().apply(i) for i in range(node.children().size())]
            assert longest < 6000, (name, longest)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
