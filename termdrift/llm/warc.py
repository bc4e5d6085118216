"""WARC archives, index first.

Writing: each task appends records, every one a gzip member of its own, to an archive file of its
own in the shared folder, and returns an index row (file, offset, length, URL, digest) for each.
The index is a Parquet table; a task that is run again writes another file, and only rows of the
attempt that was committed reach the index, so lost executors leave at most files nobody refers to.

Reading: index rows are selected like any rows, sorted by file and offset, and neighbouring byte
ranges are read together.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import arrow_schema, join_unique, plain_text, shared_path, slices, written

#: Payloads below this size are always stored.
MIN_REVISIT = 100
FILE_BYTES, GAP_BYTES, READ_BYTES, SHARE_BYTES = 512 << 20, 64 << 10, 8 << 20, 16 << 20

INDEX = "page_id bigint, url string, file string, offset bigint, length bigint, payload_digest string, record_type string"
RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def typed_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest, bytes, record_type and refers_to of each row.

    A null html is an empty payload; bytes that are no UTF-8 are U+FFFD. Of rows with equal payloads of MIN_REVISIT bytes or more,
    those with the smallest page_id that isn't null are responses (so is a row that repeats it);
    if all are null, all are. The others, a null page_id among them, revisit it.
    """
    payload = plain_text(F.coalesce(F.col("html"), F.lit("")))
    rows = pages.select("page_id", plain_text(F.col("url")).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("bigint").alias("bytes"))
    large = rows.where(F.col("bytes") >= MIN_REVISIT)
    groups = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL")
    both = join_unique(rows, written(groups, "warc-groups"), ["digest"], pages.count(), "left")
    revisit = (F.col("bytes") >= MIN_REVISIT) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return both.select(
        "page_id", "url", "payload", "digest", "bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"),
    )


def _escaped(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id, url, payload: bytes, digest: str, record_type: str, refers_to) -> bytes:
    """A WARC/1.1 record; a revisit has the HTTP header of its payload, but not the payload."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if record_type == "response":
        block += payload
    head = ["WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_escaped(url)}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if record_type == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Header fields (names in lower case) and payload of a record; raises ValueError if it is broken."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict((k.lower(), v) for k, _, v in (x.partition(": ") for x in lines[1:]))
    block = rest[: int(fields["content-length"])]
    http, found, payload = block.partition(b"\r\n\r\n")
    if not found or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a WARC record that is cut short")
    size = re.search(rb"(?i)\r\ncontent-length: (\d+)", http)
    fields["payload"], fields["payload_bytes"] = payload, int(size[1])
    return fields


def write_archives(typed: DataFrame, path: str) -> DataFrame:
    """Writes the rows of typed_pages as archives below path, and the index at path/index; returns it."""
    schema = StructType.fromDDL(INDEX)
    arrow = arrow_schema(schema)

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(f"{root}/data", recursive=True)
        out, name, at = None, "", 0
        for part in (x for b in batches for x in slices([b], "payload")):
            if out is None or at > FILE_BYTES:
                if out is not None:
                    out.close()
                name, at = f"{root}/data/{uuid.uuid4().hex}.warc.gz", 0
                out = store.open_output_stream(name, compression=None)
            rows = []
            for x in part.to_pylist():
                data = gzip.compress(record(x["page_id"], x["url"], x["payload"].encode(), x["digest"], x["record_type"], x["refers_to"]), 1, mtime=0)
                out.write(data)
                rows.append((x["page_id"], x["url"], name, at, len(data), x["digest"], x["record_type"]))
                at += len(data)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)
        if out is not None:
            out.close()

    typed.mapInArrow(run, schema).write.parquet(f"{path}/index")
    return typed.sparkSession.read.schema(schema).parquet(f"{path}/index")


def ranges(rows: list[tuple[str, int, int]]) -> list[list]:
    """(file, offset, length) sorted -> [file, start, end, row numbers]: neighbours read together."""
    out: list[list] = []
    for i, (file, offset, length) in enumerate(rows):
        last = out[-1] if out else None
        if last and last[0] == file and offset - last[2] <= GAP_BYTES and offset + length - last[1] <= READ_BYTES:
            last[2] = max(last[2], offset + length)
            last[3].append(i)
        else:
            out.append([file, offset, offset + length, [i]])
    return out


def read_records(index: DataFrame, path: str, *, payloads: bool = False) -> DataFrame:
    """The records that index rows point to, read back from the archives below path.

    Columns RECORD and, if payloads, payload (empty for a revisit). A response's digest is
    computed from what was read, and must be the one in its header; a revisit's is its header's.
    """
    schema = StructType.fromDDL(RECORD + (", payload string" if payloads else ""))
    arrow = arrow_schema(schema)

    def run(batches):
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(path)
        name, source = None, None
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            for file, start, end, members in ranges(rows):
                if file != name:
                    name, source = file, store.open_input_file(file)
                data = source.read_at(end - start, start)
                out = []
                for i in members:
                    at = rows[i][1] - start
                    x = parse(zlib.decompress(data[at : at + rows[i][2]], 31))
                    digest = x["warc-payload-digest"].removeprefix("sha256:")
                    if x["warc-type"] == "response" and hashlib.sha256(x["payload"]).hexdigest() != digest:
                        raise ValueError(f"{file} at {rows[i][1]}: the payload's digest differs")
                    page, to = (re.search(r"-?\d+", x.get(k, "")) for k in ("warc-record-id", "warc-refers-to"))
                    out.append((page and int(page[0]), x.get("warc-target-uri"), x["payload_bytes"], digest, x["warc-type"], to and int(to[0]), x["payload"].decode()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    # Index rows are small however much they point to, so the number of tasks is set by the bytes to read.
    share = F.floor(F.col("offset") / SHARE_BYTES)
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    tasks = max(8, 2 * total // SHARE_BYTES)
    return index.select("file", "offset", "length").repartition(tasks, F.col("file"), share).sortWithinPartitions("file", "offset").mapInArrow(run, schema)


def archive_pages(pages: DataFrame, path: str) -> DataFrame:
    """Writes pages (page_id, url, html; other columns are ignored) as archives; returns the index.

    Each row, repeated ones too, becomes a record. See typed_pages for nulls; a null URL has no
    header field. Control characters and blanks of a URL are percent-encoded in its record. An
    empty table gives no archive and an empty index.
    """
    return write_archives(typed_pages(pages), path)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    index = archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_records(index, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
