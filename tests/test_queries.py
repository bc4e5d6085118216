"""Queries on tables of other sizes than the driver's small ones."""

import pytest

from termdrift.plans.queries import QUERIES, told
from termdrift.plans.testdata import Inputs


def test_codes_without_issues_are_told(spark):
    issues = spark.createDataFrame([("A",), ("A",), ("B",)], "code string")
    assert {tuple(r) for r in told(issues, "what", "B", "C").collect()} == {("A", 2), ("B", 1), ("C", 0)}


@pytest.mark.parametrize("n, roots", [(100, 1), (6000, 0)])
def test_faults_of_ontologies_with_and_without_roots(spark, tmp_path, n, roots):
    spark.range(n).withColumnRenamed("id", "p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    got = {r.code: r.n for r in QUERIES["onto_faults"](Inputs(spark, str(tmp_path))).collect()}
    assert got == {"AMBIGUOUS_ALTERNATE_ID": n - 1, "ONTOLOGY_CYCLE": 1, "MISSING_GO_ROOTS": roots}
