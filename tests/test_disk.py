"""What stays on disk of files and tables that are written on the way, and how often annotations are shuffled."""

import os
import time

import pytest
from pyspark.sql import functions as F

from termdrift.operators.identity import SequenceIndex
from termdrift.operators.snapshot import by_subjects
from termdrift.plans.testdata import Inputs


def shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def shared(spark):
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


@pytest.mark.parametrize("name", ["all.txt", "all.txt.gz"])
def test_only_the_whole_stays_of_a_file(spark, name):
    files, tables = shuffles(spark), shared(spark)
    path = Inputs(spark, "").put(name, spark.range(5000).select("id", F.concat(F.lit("line "), "id").alias("value")), "id")
    assert {x.lstrip(".").split("-")[0] for x in shared(spark) - tables} == {"whole"}
    late = time.time() + 20
    while shuffles(spark) - files and time.time() < late:  # they go in the background
        time.sleep(0.1)
    assert not shuffles(spark) - files
    assert [r.value for r in spark.read.text(path).collect()] == [f"line {n}" for n in range(5000)]


def test_sequences_go_once_they_are_matched(spark):
    tables = shared(spark)
    rows = spark.createDataFrame([("A", "ACD", 1), ("B", "WWW", 2)], "identifier string, sequence string, line long")
    found = SequenceIndex.of(rows.where("line = 1"), "r").match(rows)
    kept = [spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/{x}").columns for x in shared(spark) - tables if not x.startswith(".")]
    assert kept and not any("sequence" in c for c in kept)
    assert [r.target_id for r in found.matches.collect()] == ["A"] and [r.target_id for r in found.unmatched.collect()] == ["B"]


def test_annotations_are_joined_with_their_subjects_once(spark):
    rows = [("DB", "P1"), ("DB", "P2"), ("MGI", "MGI:7"), ("MGI:MGI", "7"), ("MGI", "7"), ("", "P3"), ("X", ":P3"), ("DB", "P2")]
    table = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "database string, subject_id string, line long")
    lines = lambda *s: sorted(r.line for r in by_subjects(table, spark.createDataFrame([(x,) for x in s], "subject_id string")).collect())
    assert lines("P2", "DB:P2", None, "DB:P2") == [1, 7] and lines("MGI:MGI:7") == [2, 3] and lines("MGI:7") == [2, 4]
    assert lines(":P3") == [5, 6] and lines("P3") == [5] and lines("DB:", "DB", "") == [] and lines("OTHER:P1") == []
    plan = by_subjects(table, spark.range(9).select(F.col("id").cast("string").alias("subject_id")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftSemi") == 1 and "LeftOuter" not in plan and "NestedLoop" not in plan
