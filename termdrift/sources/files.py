"""Files as inputs: names, checksums and numbered lines."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass
from os import PathLike, fspath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termdrift.plans.issues import ERROR, issue, issue_rows


@dataclass(frozen=True)
class Source:
    """A file that Spark can read; .gz files (in any case) are decompressed by their codec."""

    path: str

    @classmethod
    def of(cls, value: Source | str | PathLike) -> Source:
        return value if isinstance(value, cls) else cls(fspath(value))

    from_value = of

    @property
    def name(self) -> str:
        return self.path

    @property
    def is_gzip(self) -> bool:
        return self.path.lower().endswith(".gz")

    def open_binary(self, spark: SparkSession, chunk: int = 1 << 20) -> DataFrame:
        """path, chunk (from 0) and content of each chunk of the file, decompressed if it is a .gz.

        A task streams a file, so no chunk but the one at hand is in memory.
        """

        def run(batches):
            for path in (p for batch in batches for p in batch.column(0).to_pylist()):
                with opened(path) as stream:
                    for n, data in enumerate(iter(lambda: stream.read(chunk), b"")):
                        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([data], pa.binary())], names=["path", "chunk", "content"])

        return listed(spark, self.path).select("path").mapInArrow(run, "path string, chunk bigint, content binary")

    def open_text(self, spark: SparkSession) -> DataFrame:
        return numbered_lines(spark, self)

    def checksum(self, spark: SparkSession, algorithm: str = "sha256") -> str:
        """Hex digest of the stored bytes, compressed or not; any algorithm of hashlib."""
        return checksums(spark, [self], algorithm).first().digest


def listed(spark: SparkSession, *paths: str) -> DataFrame:
    """path and length of the files that paths name (files, folders or patterns); their content isn't read."""
    return spark.read.format("binaryFile").load(list(paths)).select("path", "length")


def opened(path: str, *, stored: bool = False):
    """A stream of a file's bytes, on an executor; of a .gz file the decompressed ones unless stored."""
    from urllib.parse import quote

    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(quote(path, safe="/:@"))
    return store.open_input_stream(name, compression="gzip" if path.lower().endswith(".gz") and not stored else None)


def joined(spark: SparkSession, parts: str, whole: str) -> str:
    """The bytes of parts (a pattern; Spark's part files), in the order of their names, as one file; its path.

    Compressed parts make a compressed whole if its name ends with .gz, as such files may have several members; else they are decompressed.
    """
    from urllib.parse import quote

    packed = whole.lower().endswith(".gz")

    def run(batches):
        from pyarrow import fs

        found = sorted((p for batch in batches for p in batch.column(0).to_pylist()), key=lambda p: (len(p), p))
        store, name = fs.FileSystem.from_uri(quote(whole, safe="/:@"))
        with store.open_output_stream(name, compression=None) as out:
            for path in found:
                with opened(path, stored=packed) as stream:
                    for data in iter(lambda: stream.read(1 << 23), b""):  # noqa: B023
                        out.write(data)
        yield pa.RecordBatch.from_arrays([pa.array([whole])], names=["path"])

    return listed(spark, parts).select("path").repartition(1).mapInArrow(run, "path string").collect()[0].path


def checksums(spark: SparkSession, sources: Iterable[Source | str | PathLike], algorithm: str = "sha256") -> DataFrame:
    """path, length and digest (hex, of the stored bytes) of files; a task for each streams it in chunks."""
    hashlib.new(algorithm)  # an unknown one is the caller's error

    def run(batches):
        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                digest = hashlib.new(algorithm)
                with opened(path, stored=True) as stream:
                    for data in iter(lambda: stream.read(1 << 20), b""):
                        digest.update(data)
                out.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=["path", "length", "digest"])

    files = listed(spark, *(Source.of(x).path for x in sources))
    return files.repartition("path").mapInArrow(run, "path string, length bigint, digest string")


def numbered_lines(spark: SparkSession, source: Source | str | PathLike) -> DataFrame:
    """source, block, line and value of each line, numbered from 1 through the file.

    Lines end with \\n, \\r\\n or \\r. A file is read in blocks by as many tasks; lines are counted by
    block, and a running sum over the (few) blocks numbers them all, so no task holds a file.
    """
    source = Source.of(source)
    text = spark.read.text(source.path)
    rows = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), "value",
    )
    sums = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    # A hint, as the size of a compressed file would have its lines be the side that the driver collects.
    return rows.join(F.broadcast(sums), ["file", "block"]).select(
        F.lit(source.name).alias("source"), "file", "block", (F.col("id") - F.col("first") + F.col("offset") + 1).alias("line"), "value"
    )


def encoding_issues(lines: DataFrame) -> DataFrame:
    """An error for each line that has bytes that are no UTF-8."""
    faulty = lines.where(~F.is_valid_utf8("value"))
    return issue_rows(faulty, issue("INVALID_TEXT_ENCODING", "the line isn't valid UTF-8", ERROR, source=F.col("source"), line=F.col("line")))
