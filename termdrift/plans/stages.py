"""Cutting the lineage of iterative plans."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """df computed once and written to the shared checkpoint folder, and read from there.

    Executors may be lost later without loss, plans that use it start from files, and the
    optimizer knows its size.
    """
    return counted(df)[0]


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """The same, and the number of rows, which is observed as they are written."""
    spark, path, seen = df.sparkSession, scratch(df.sparkSession, "stage"), Observation()
    with shuffles_dropped(spark):
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out, seen.get["n"]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written or counted within this leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def forget(spark: SparkSession, *paths: str) -> None:
    """Deletes what was written at paths of the shared folder, and nothing will read again."""
    for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the folder that driver and executors share, the session's spark.checkpoint.dir.

    Only a session that runs on this machine alone gets a folder here if it names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="termdrift-"))
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/{what}-{uuid.uuid4().hex}"
