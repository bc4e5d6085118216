"""A training-data pipeline over documents: five operators, each on all that the one before kept.

Every stage's result is written as Parquet to the shared folder and read again as the next
stage's documents, so a lost executor costs at most a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from termdrift.llm.byte_bpe import encode_documents, vocabulary
from termdrift.llm.common import documents, written
from termdrift.llm.line_quality import clean_documents
from termdrift.llm.mixing import mix_documents
from termdrift.llm.secrets import redact_documents
from termdrift.llm.similar import drop_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules keep, without the lines that fail."""
    return clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 5-word shingles, similarity of 0.8 or more."""
    return drop_near_copies(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return redact_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes from each document, a row for each pass over it."""
    return mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each row."""
    return encode_documents(docs, *vocabulary())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: Fingerprints, Markov models, permutations and merges are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents in sf_dir."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
