"""Near duplicates by SimHash, with pigeonring filtering.

A 64-bit fingerprint is a ring of four segments of 16 bits. If two fingerprints differ in three
bits at most, then from some segment on, the differences of the next 1, 2, 3 and 4 segments add
up to no more than 0, 1, 2 and 3 (3/4 for each segment, rounded down). So from there the first
segment is equal and one half of the second one is: these 24 bits, for each of the four starts
and two halves, are the keys by which candidates meet. Chains whose cumulative differences
exceed a budget are pruned, the rest goes to the full Hamming check.

Equal fingerprints are one node. Within a bucket only a spanning forest of its links is emitted;
a bucket of more than CELL nodes is dealt out as cells, one for each two of its blocks.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, join_unique, only, per_text, written
from .components import components

SEGMENTS, BITS, MAX_BITS = 4, 16, 3
#: Nodes of a bucket that are compared in one cell.
CELL = 4096


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in more than half of the hashes (uint64)."""
    n, counts = len(hashes), np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        part = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned SimHash of a text: A-Z in lower case, shingles of words, XXH64 of each.

    A bit is set if it is set in more than half of the hashes. Fewer words than a shingle has
    make one shingle; no words (a null or empty text) give 0.
    """
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) > shingle else [b" ".join(words)]
    n = max(1, len(words) - shingle + 1)
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(seed)), np.uint64, n))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(df: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns keep, and fp: the fingerprint as a signed long, never null."""

    def start():
        return lambda texts: [[signed(fingerprint(t)) for t in texts]]

    return per_text(df, start, "fp bigint", keep)


def chained(a: np.ndarray, b: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which pairs have a chain from segment start on within the budgets, the last of which is MAX_BITS."""
    x = a ^ b
    turn = start.astype(np.uint64) * np.uint64(BITS)
    x = (x >> turn) | np.where(turn > 0, x << (np.uint64(64) - np.maximum(turn, np.uint64(1))), np.uint64(0))
    ok = np.ones(len(x), bool)
    for k in range(1, SEGMENTS + 1):
        prefix = x & np.uint64((1 << (BITS * k)) - 1)
        ok[ok] = np.bitwise_count(prefix[ok]) <= MAX_BITS * k // SEGMENTS
    return ok


def forest(keys: np.ndarray, nodes: np.ndarray, start: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links among nodes with equal keys (sorted): pairs of row numbers."""
    parent = list(range(len(keys)))

    def find(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    out, live, shift = [], np.arange(len(keys)), 1
    while True:  # each row against the one shift rows on, all buckets at once
        live = live[live + shift < len(keys)]
        live = live[keys[live] == keys[live + shift]]
        if not len(live):
            return out
        hit = live[chained(nodes[live], nodes[live + shift], start[live])]
        for i in hit.tolist():
            a, b = find(i), find(i + shift)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((i, i + shift))
        shift += 1


def links(nodes: DataFrame) -> DataFrame:
    """u, v: links between fingerprints (fp, distinct), a spanning forest of them in each cell.

    Their components are those of all links at MAX_BITS or fewer differing bits.
    """
    keys = []
    for i in range(SEGMENTS):
        turned = F.expr(f"shiftrightunsigned(fp, {BITS * i}) | shiftleft(fp, {64 - BITS * i})") if i else F.col("fp")
        for half in range(2):
            second = F.shiftrightunsigned(turned, BITS + half * BITS // 2).bitwiseAND((1 << BITS // 2) - 1)
            keys.append(F.shiftleft(turned.bitwiseAND((1 << BITS) - 1), 16).bitwiseOR(F.shiftleft(second, 8)).bitwiseOR(i * 2 + half))
    keyed = nodes.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL), "simhash-hot")
    n_hot = hot.count()
    if n_hot:
        few = F.broadcast(hot) if n_hot <= 100_000 else hot
        found = keyed.join(few, "key", "left")
        blocks = F.ceil(F.col("n") / CELL)
        block = F.pmod(F.xxhash64("fp"), blocks)
        cells = F.transform(F.sequence(F.lit(0).cast("bigint"), blocks - 1), lambda j: F.least(block, j) * blocks + F.greatest(block, j))
        keyed = found.where("n IS NULL").select("fp", "key", F.lit(0).cast("bigint").alias("cell")).union(found.where("n IS NOT NULL").select("fp", "key", F.explode(cells)))
    else:
        keyed = keyed.withColumn("cell", F.lit(0).cast("bigint"))

    def run(batches):
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        rest: list[np.ndarray] = []

        def done(columns):
            fp, key, cell = columns
            group = np.cumsum(np.append(0, (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])))
            pairs = forest(group, fp.view(np.uint64), (key & 255) >> 1)
            u, v = ([p[k] for p in pairs] for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(fp[u], pa.int64()), pa.array(fp[v], pa.int64())], schema=schema)

        for batch in batches:
            columns = [np.array(batch.column(c), np.int64) for c in ("fp", "key", "cell")]
            if rest:
                columns = [np.concatenate(x) for x in zip(rest, columns)]
            if not len(columns[0]):
                continue
            last = (columns[1] == columns[1][-1]) & (columns[2] == columns[2][-1])
            whole = int(np.argmax(last))  # the last group may go on in the next batch
            rest = [c[whole:] for c in columns]
            if whole:
                yield done([c[:whole] for c in columns])
        if rest:
            yield done(rest)

    return keyed.repartition("key", "cell").sortWithinPartitions("key", "cell", "fp").mapInArrow(run, "u bigint, v bigint")


def grouped(rows: DataFrame) -> DataFrame:
    """rows (doc_id, fp and others) with root (the smallest linked fingerprint) and component_id.

    component_id is the smallest doc_id that isn't null among the rows that links reach.
    """
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-nodes")
    ties = written(components(links(nodes.select("fp"))), "simhash-roots")
    nodes = written(nodes.join(ties, nodes.fp == ties.node, "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    roots = nodes.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n"))
    labelled = join_unique(nodes.withColumnRenamed("n", "rows"), written(roots, "simhash-least"), ["root"], nodes.count())
    labelled = written(labelled.select("fp", "root", "component_id", F.col("rows").alias("n")), "simhash-labels")
    return join_unique(rows, labelled, ["fp"], rows.count())


def near_duplicates(df: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row.

    A null or empty text has fingerprint 0 and is linked like any other. Repeated rows link. A
    null doc_id never names a component, but stays a row of it; if a component has no other,
    component_id is null. An empty table gives an empty one; other columns are ignored.
    """
    rows = written(fingerprints(df), "simhash")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return grouped(rows).select("doc_id", text.alias("fingerprint"), "component_id")


def drop_near_duplicates(df: DataFrame) -> DataFrame:
    """One row of each group of near duplicates, with df's columns: the one with the smallest doc_id.

    Among equal doc_ids the smallest hash of the row decides; a null doc_id comes last.
    """
    row_hash = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    ids = df.select("doc_id", "text", row_hash.alias("row_hash"))
    rows = written(fingerprints(ids, ("doc_id", "row_hash")), "simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash")).alias("k")
    kept = grouped(rows).groupBy("root").agg(first).select(F.col("k.doc_id").alias("_id"), F.col("k.row_hash").alias("_hash"))
    return only(df, row_hash, kept)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
