"""What the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: Bytes of text handed to a Python function at once; a longer text makes a slice of its own.
SLICE_BYTES = 8 << 20

#: Runs of other characters than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where a session names none, one is made and set if the session runs on this machine alone;
    on a cluster a folder of one machine would lose tables, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="termdrift-"))
    return spark.sparkContext.getCheckpointDir()


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts lineage and outlives executors."""
    return counted(df, what)[0]


def counted(df: DataFrame, what: str) -> tuple[DataFrame, int]:
    """The same, and the number of rows, which is observed as they are written."""
    out, seen = observed(df, what, F.count(F.lit(1)).alias("n"))
    return out, seen["n"]


def observed(df: DataFrame, what: str, *totals: Column) -> tuple[DataFrame, dict]:
    """The same, and totals of the rows by name, which are observed as they are written."""
    spark, path, seen = df.sparkSession, shared_path(df.sparkSession, what), Observation()
    df.observe(seen, *totals).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out, seen.get


def forget(*tables: DataFrame) -> None:
    """Deletes tables of written() that nothing will read again."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def plain_text(text: Column) -> Column:
    """text with U+FFFD for bytes that are no UTF-8, which Python couldn't read."""
    return F.make_valid_utf8(text)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the values of a column have some bytes (most, if they can) together."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = batch.column(column)
        length = pa.compute.list_value_length if pa.types.is_list(values.type) else pa.compute.binary_length
        sizes = pa.compute.fill_null(length(values), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if total and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        yield batch.slice(start)


@contextmanager
def batches_of(spark: SparkSession, most: int) -> Iterator[None]:
    """What is planned within this gets batches of so many bytes, about, and of fewer rows than the session's; a longer row makes its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def arrow_schema(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def per_text(
    df: DataFrame,
    make: Callable[[], Callable[[list], list]],
    fields: str,
    keep: tuple[str, ...] = ("doc_id",),
    column: str = "text",
    size_of: str | None = None,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Columns keep of df with new columns computed from whole texts.

    make is called once in each task and returns a function from a list of texts (None for
    null) to the list of new columns, each a list or array as long as the texts. size_of: the column whose
    bytes count for a slice (slice_bytes, about), if column itself is no text. Bytes of column that
    are no UTF-8 are U+FFFD.
    """
    schema = StructType([df.schema[c] for c in keep]).fields
    out = StructType(schema + StructType.fromDDL(fields).fields)
    arrow, n = arrow_schema(out), len(keep)

    def run(batches):
        work = make()
        for part in slices(batches, size_of or column, slice_bytes):
            new = work(part.column(column).to_pylist())
            columns = [part.column(c).cast(arrow.field(i).type) for i, c in enumerate(keep)]
            columns += [v.cast(arrow.field(n + i).type) if isinstance(v, pa.Array) else pa.array(v, arrow.field(n + i).type) for i, v in enumerate(new)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    extra = [c for c in (column, size_of) if c and c not in keep]
    plain = {column: plain_text(F.col(f"`{column}`"))} if isinstance(df.schema[column].dataType, StringType) and column not in keep else {}
    return df.select(*keep, *extra).withColumns(plain).mapInArrow(run, out)


def with_texts(df: DataFrame, make: Callable[[], Callable[[list], list]], text_col: str, chars_col: str, *, drop: bool = False) -> DataFrame:
    """df with another text_col; chars_col, if df has it, becomes the new texts' length.

    make is called once in each task and returns a function from a list of texts to that of the
    new ones. drop: rows for which that is None go. All columns, whatever their names, stay.
    """
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    rows = df.select(*((plain_text(F.col(f"`{c}`")) if c == text_col else F.col(f"`{c}`")).alias(n) for c, n in names.items()))

    def start():
        work = make()
        return lambda texts: [work(texts)]

    done = per_text(rows, start, "_new string", tuple(names.values()), names[text_col])
    done = done.where("_new IS NOT NULL") if drop else done
    out = {text_col: F.col("_new")}
    if chars_col in names and chars_col != text_col:
        out[chars_col] = F.char_length("_new").cast(df.schema[chars_col].dataType)
    return done.select(*(out.get(c, F.col(n)).alias(c) for c, n in names.items()))


#: A key with more than 1/HOT of all rows is hot; there are fewer than HOT such keys, whatever the input's size.
HOT = 2000


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], total: int, how: str = "inner") -> DataFrame:
    """left joined to right, which has one row for each key and, in column n, left's rows with it.

    total: left's rows. Keys that hold more than 1/HOT of them, fewer than HOT, are broadcast and
    skip the shuffle; no other key can make a large task. Columns of right but n and the keys
    must not be in left. how: inner or left. Rows with a null in a key match nothing.
    """
    own = [c for c in right.columns if c not in (*keys, "n")]
    hot = right.where(F.col("n") > total // HOT).select(*keys, F.struct(*own).alias("_hot"))
    rest = right.where(F.col("n") <= total // HOT).drop("n")
    first = left.join(F.broadcast(hot), keys, "left")
    found = first.where("_hot IS NOT NULL").select(*left.columns, "_hot.*")
    return found.unionByName(first.where("_hot IS NULL").drop("_hot").join(rest, keys, how).select(*left.columns, *own))


def only(df: DataFrame, row_hash: Column, kept: DataFrame) -> DataFrame:
    """One row of df for each of kept (_id: its doc_id, _hash: its row_hash), with df's columns.

    Rows that repeat each other have one partitioning with the join, so texts are shuffled once.
    """
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    keys = lambda doc, h: [F.coalesce(F.col(doc).cast("string"), F.lit("")).alias("_key"), h.alias("_row")]
    whole = df.select(*keys("doc_id", row_hash), *(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    found = whole.join(kept.select(*keys("_id", F.col("_hash"))), ["_key", "_row"], "left_semi")
    return found.dropDuplicates(["_key", "_row"]).select(*(F.col(n).alias(c) for c, n in names.items()))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


__all__ = ["F", "WORD", "arrow_schema", "batches_of", "counted", "documents", "forget", "join_unique", "observed", "only", "per_text", "plain_text", "shared_dir", "shared_path", "slices", "with_texts", "written"]
