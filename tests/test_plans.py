"""Plans that would not hold at scale: nested loops, cartesian products, windows over everything."""

import os

import pytest

from termdrift.plans import oracle
from termdrift.plans.queries import QUERIES
from termdrift.plans.testdata import Inputs

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")


@pytest.mark.parametrize("name", ["compare_changes", "subject_filter_qualified", "fasta_first_valid", "fasta_issues", "identity_match", "onto_ancestors", "gaf_rows"])
def test_plan(spark, name):
    plan = QUERIES[name](Inputs(spark, DATA))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "Python" not in plan
    lines = plan.split("\n")
    for above, below in zip(lines, lines[1:]):
        assert not (" Window" in above and "SinglePartition" in below)


def test_columns_reach_the_scan(spark):
    plan = QUERIES["gaf_row_issues"](Inputs(spark, DATA))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "l_comment" not in plan and "l_extendedprice" not in plan


def test_each_query_has_sql():
    assert set(QUERIES) == set(oracle.sql())
