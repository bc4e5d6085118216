import datetime
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from termdrift.sources.fasta import FastaReader

#: Texts of documents, several without any letter; their sequence is one that others have, too.
TEXTS = ["one", None, "two", "WWW", "", "three", "12 34", "four", "one", "日本", "five", "...", "six", "", "seven", "eight", None, "nine", "5", "ten"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("empty"))
    spark.range(60).select(F.col("id").alias("p_partkey")).write.parquet(f"{at}/part.parquet")
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{at}/documents.parquet")
    days = (datetime.datetime(1998, 1, 1), datetime.datetime(2000, 1, 1))
    rows = [(i, 2 * i, 0, line, float(i + line + k), 0.0, days[k]) for i in range(len(TEXTS)) for line in range(1, 8) for k in (0, 1)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, schema).write.parquet(f"{at}/lineitem.parquet")
    return at


@pytest.mark.parametrize("name", ["compare_changes", "files_compare"])
def test_changes_of_texts_without_letters(spark, folder, name):
    con = duckdb.connect()
    for table in ("part", "documents", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = entry.queries()[name](spark, folder).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall()) and any("T1|" in r.target_ids for r in got)


def test_empty_sequences_are_records_only_if_asked_for(spark, tmp_path):
    (tmp_path / "x.fasta").write_text(">A\n\n>B\nac\n>\n>A\nd\n")
    for reader, want, codes in ((FastaReader(), [("A", "D"), ("B", "AC")], {"EMPTY_FASTA_SEQUENCE", "EMPTY_FASTA_IDENTIFIER"}), (FastaReader(empty=True), [("A", ""), ("B", "AC")], {"EMPTY_FASTA_IDENTIFIER", "DUPLICATE_FASTA_IDENTIFIER"})):
        records, report = reader.read(spark, str(tmp_path / "x.fasta"), strict=False)
        assert sorted((r.identifier, r.sequence) for r in records.collect()) == want
        assert {r.code for r in report.issues.collect()} == codes
