"""Annotation rows as they arrive: the row rules are projections, so they hold for streams as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termdrift.plans.issues import issue_rows
from termdrift.sources.gaf import accepted_rows, annotation_rows, row_issues


def stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    """source and value of lines of files that appear in folder; a line's number isn't known in a stream."""
    text = spark.readStream.text(folder)
    return text.select(F.col("_metadata.file_path").alias("source"), F.lit(None).cast("bigint").alias("line"), "value")


def stream_annotations(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted annotations and the issues of faulty rows, both as streams."""
    rows = annotation_rows(lines)
    return accepted_rows(rows), issue_rows(rows, *row_issues())
