import datetime
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables whose annotations name terms that cut alternates of eight digits claim as well."""
    at = str(tmp_path_factory.mktemp("large"))
    spark.range(1_010_000).select(F.col("id").alias("p_partkey")).write.parquet(f"{at}/part.parquet")
    docs = range(76_900, 77_000)
    spark.createDataFrame([(i, f"text {'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}") for i in docs], "doc_id long, text string").write.parquet(f"{at}/documents.parquet")
    days = (datetime.datetime(1998, 1, 1), datetime.datetime(2000, 1, 1))
    rows = [(i, 2 * i, 0, line, float(i + line + k), 0.0, days[k]) for i in docs for line in range(1, 8) for k in (0, 1)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_shipdate timestamp_ntz"
    spark.createDataFrame(rows, schema).write.parquet(f"{at}/lineitem.parquet")
    return at


@pytest.mark.parametrize("name", ["compare_changes", "compare_changes_reviewed"])
def test_changes_of_identifiers_that_several_terms_claim(spark, folder, name):
    con = duckdb.connect()
    for table in ("part", "documents", "lineitem"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = entry.queries()[name](spark, folder).select(*columns).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall()) and len(got) > 1000
