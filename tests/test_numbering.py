import pytest
from pyspark.sql import functions as F

from termdrift.plans.testdata import Inputs
from termdrift.sources.files import numbered_lines


def test_the_lines_of_a_small_file_are_not_collected_to_number_them(spark, tmp_path):
    (tmp_path / "x.txt").write_text("a\nb\n" * 1000)
    plan = numbered_lines(spark, str(tmp_path / "x.txt")).drop("value")._jdf.queryExecution().executedPlan().toString()
    broadcast = plan[plan.index("BroadcastExchange") :].split("\n")
    assert "HashAggregate" in "".join(broadcast[:6]) and "BuildRight" in plan and "BuildLeft" not in plan


@pytest.mark.parametrize("name", ["all.txt", "all.txt.gz"])
def test_a_file_is_written_by_many_tasks_and_in_order(spark, name):
    rows = spark.range(0, 5000, 1, 7).select((5000 - F.col("id")).alias("at"), F.concat(F.lit("line "), 5000 - F.col("id")).alias("value"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        path = Inputs(spark, "").put(name, rows, "at")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    stored = open(path.removeprefix("file:"), "rb").read()
    assert stored.count(b"\x1f\x8b\x08") > 1 or not name.endswith(".gz")  # a member for each task
    got = numbered_lines(spark, path).collect()
    assert sorted(r.line for r in got) == list(range(1, 5001)) and all(r.value == f"line {r.line}" for r in got)
