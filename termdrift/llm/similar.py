"""Near copies by the words themselves: sets of 5-word shingles with a Jaccard similarity of 0.8 or more.

Candidates are what SimHash links: fingerprints of the sets that differ in three bits at most, found by pigeonring
chains (simhash.py). That is a small part of the pairs at 0.8 or more, so those are candidates, too, that
share one of 40 bands of five MinHash values; a pair at exactly 0.8 shares none with a probability of 1.3e-7, and
less above. Every candidate is confirmed by its whole sets. Groups are
the components of confirmed pairs: first SimHash's links are confirmed, and each member of a bucket is held against the bucket's
least one, then those pairs that still lie in different components are, within the bucket: no row is
made of a pair. Of these only pairs whose sketches (four bits of each of the 200 values) differ in 76 places at most
are confirmed; a pair at exactly 0.8 differs in more with a probability of 6e-11 if values are independent, and less above.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import HOT, counted, join_unique, only, per_text, written
from .components import components
from .simhash import links, majority, signed

SHINGLE, BANDS, ROWS = 5, 40, 5
#: The least similarity of near copies, as a fraction.
PART, WHOLE = 4, 5
#: Rows whose hashes are broadcast; more are joined by a shuffle.
FEW = 2_000_000
#: Numbers that hold a sketch, 16 values each, and the places in which those of near copies may differ.
LONGS, APART = -(-BANDS * ROWS // 16), 76
#: Members of a bucket on either side of a cell, and their shingles, about.
CELL, CELL_SIZE = 512, 2_000_000

_RANDOM = np.random.Generator(np.random.PCG64(42))
_XOR = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64, False)
_ODD = _RANDOM.integers(0, 1 << 64, (BANDS * ROWS, 1), np.uint64, False) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """The distinct XXH64 of a text's shingles, sorted; A-Z in lower case. Fewer words make one shingle."""
    import xxhash

    words = (text or "").encode().lower().split()
    grams = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))) if len(words) > SHINGLE else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), np.uint64))


def least_hashes(found: np.ndarray) -> np.ndarray:
    """The MinHash values of a set of shingles."""
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for i in range(0, len(found), 512):
        mixed = (found[None, i : i + 512] ^ _XOR) * _ODD
        least = np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(1))
    return least


def bands(least: np.ndarray) -> np.ndarray:
    """A number for each band of MinHash values; different bands have different numbers."""
    out = np.arange(BANDS, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        out = (out ^ column) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def sketch(least: np.ndarray) -> np.ndarray:
    """The low four bits of each of the MinHash values, 16 to a number."""
    low = np.zeros(16 * LONGS, np.uint64)
    low[: len(least)] = least & np.uint64(15)
    return np.bitwise_or.reduce(low.reshape(LONGS, 16) << (np.uint64(4) * np.arange(16, dtype=np.uint64)), axis=1).view(np.int64)


def apart(a: str, b: str) -> Column:
    """The places in which two sketches differ; columns a0, a1, ... and b0, b1, ... hold their numbers."""
    out = F.lit(0)
    for i in range(LONGS):
        x = F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        out = out + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return out


def banded(df: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Columns keep; id, size, fp (its SimHash), bands and sketch of each text's set."""

    def start():
        def work(texts):
            found = [shingles(t) for t in texts]
            least = [least_hashes(x) for x in found]
            return [list(map(number, found)), list(map(len, found)), [signed(majority(x)) for x in found], list(map(bands, least)), list(map(sketch, least))]

        return work

    return per_text(df, start, "id bigint, size bigint, fp bigint, bands array<bigint>, sketch array<bigint>", keep)


def number(found: np.ndarray) -> int:
    """What names a set of shingles."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes())).view(np.int64))


def sets(df: DataFrame) -> DataFrame:
    """id and shingles of each text's set."""

    def start():
        def work(texts):
            found = [shingles(t) for t in texts]
            return [list(map(number, found)), [x.view(np.int64) for x in found]]

        return work

    return per_text(df, start, "id bigint, shingles array<bigint>", ())


def confirmed(pairs: DataFrame, whole: DataFrame) -> tuple[DataFrame, int]:
    """Those of pairs (u, v; distinct) that are similar enough, and their number; whole has id and shingles, a row for each id."""
    pairs, total = counted(pairs, "similar-pairs")
    for side in ("u", "v"):
        uses = pairs.groupBy(F.col(side).alias("id")).agg(F.count(F.lit(1)).alias("n"))
        own = whole.join(uses, "id").select(F.col("id").alias(side), F.col("shingles").alias(f"of_{side}"), "n")
        pairs = join_unique(pairs, written(own, "similar-sets"), [side], total)
    both = F.size(F.array_intersect("of_u", "of_v"))
    return counted(pairs.where(both * WHOLE >= (F.size("of_u") + F.size("of_v") - both) * PART).select("u", "v"), "similar-links")


def alike_in_size(a: str, b: str) -> Column:
    """Whether sets of two sizes can be similar enough."""
    return F.least(a, b) * WHOLE >= F.greatest(a, b) * PART


def by_simhash(nodes: DataFrame, total: int) -> DataFrame:
    """u, v: sets (ids) that SimHash links, if their sizes are near enough.

    nodes: id, size and fp of each set, total in number. Sets with one fingerprint are linked to the least one, and that one
    to others' by a spanning forest of links in each of the pigeonring's buckets.
    """
    least = written(nodes.groupBy("fp").agg(F.min("id").alias("u"), F.min_by("size", "id").alias("u_size"), F.count(F.lit(1)).alias("n")), "similar-fingerprints")
    same = by_key(nodes.select("id", "size", F.col("fp").alias("key")), least.where("n > 1").withColumnRenamed("fp", "key"), total).where("id <> u")
    of = lambda side: least.select(F.col("fp").alias(f"{side}_fp"), F.col("u").alias(side), F.col("u_size").alias(f"{side}_size"))
    other = links(least.select("fp")).toDF("u_fp", "v_fp").distinct().join(of("u"), "u_fp").join(of("v"), "v_fp").select("u", "u_size", "v", "v_size")
    return same.select("u", "u_size", F.col("id").alias("v"), F.col("size").alias("v_size")).union(other).where(alike_in_size("u_size", "v_size")).select("u", "v")


def by_key(left: DataFrame, right: DataFrame, total: int) -> DataFrame:
    """left (total rows) joined to right, which has one row for each key and, in column n, left's rows with it.

    Keys with more than 1/HOT of all rows, fewer than HOT, are told by the driver, as literals, and
    broadcast; so rows that right lacks go through no join but the one that drops them.
    """
    hot = [r.key for r in right.where(F.col("n") > total // HOT).select("key").collect()]
    right = right.drop("n")
    if not hot:
        return left.join(right, "key")
    often = F.col("key").isin(hot)
    return left.where(often).join(F.broadcast(right.where(often)), "key").unionByName(left.where(~often).join(right.where(~often), "key"))


def across(met: DataFrame, n_met: int, nodes: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """u, v: links of a bucket's sets in different components.

    met: id, size, key and root, a row for each set of a bucket; n_met: its rows; nodes: id, bands and sketch of
    each set; whole: id and shingles. Sets of a bucket's most frequent component aren't held against each other, the
    others are held against all, in cells of about CELL by CELL sets and CELL_SIZE by CELL_SIZE shingles. Within a cell
    pairs that meet in this bucket first and whose sketches are near enough are confirmed by their whole sets; of the
    links only those come out that tie components which no earlier one of the cell does. So no row is made of a pair.
    Without whole (nodes: id and sketch) all pairs whose sketches are near enough are links, each once.
    """
    parts = met.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"), F.sum("size").alias("s"))
    mixed = parts.groupBy("key").agg(F.sum("c").alias("n"), F.sum("s").alias("s"), F.max(F.struct("c", "root", "s")).alias("top"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    blocks = [F.ceil(F.greatest(n / CELL, s / CELL_SIZE)).alias(name) for n, s, name in ((F.col("n") - F.col("top.c"), F.col("s") - F.col("top.s"), "down"), (F.col("n"), F.col("s"), "wide"))]
    mixed = written(mixed.select("key", "n", F.col("top.root").alias("main"), *blocks), "similar-mixed")
    met = written(by_key(met, mixed, n_met).select("id", "size", "key", "root", "main", "down", "wide"), "similar-open")
    to = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    at = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    few = met.where("root <> main").withColumn("cell", F.explode(F.transform(to("wide"), lambda j: at("down") * F.col("wide") + j))).withColumn("few", F.lit(True))
    all_ = met.withColumn("cell", F.explode(F.transform(to("down"), lambda j: j * F.col("wide") + at("wide")))).withColumn("few", F.lit(False))
    sure = whole is not None
    own = nodes.select("id", "sketch", "bands").join(whole, "id") if sure else nodes.select("id", "sketch")
    rows = few.union(all_).drop("down", "wide").join(own, "id").repartition("key", "cell").sortWithinPartitions("key", "cell")
    found = rows.mapInArrow(lambda batches: in_cells(batches, sure), "u bigint, v bigint")
    return found if sure else found.distinct()


def in_cells(batches: Iterator[pa.RecordBatch], sure: bool) -> Iterator[pa.RecordBatch]:
    """The links of each cell, whose rows follow each other; see across(). sure: rows have bands and shingles."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    parts: list[pa.RecordBatch] = []
    last = None

    def done():
        pairs = cell_links(pa.Table.from_batches(parts).combine_chunks(), sure)
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], schema=schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        key, cell = (batch.column(c).to_numpy() for c in ("key", "cell"))
        starts = [0, *(np.flatnonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1).tolist(), len(key)]
        for start, end in pairwise(starts):
            if parts and last != (key[start], cell[start]):
                yield done()
                parts = []
            parts.append(batch.slice(start, end - start))
            last = key[start], cell[start]
    if parts:
        yield done()


def cell_links(rows: pa.Table, sure: bool) -> list[tuple[int, int]]:
    """The links of one cell; see across()."""
    few = rows.column("few").to_numpy()
    if not few.any() or few.all():
        return []
    ids, sizes, root, main, key = (rows.column(c).to_numpy() for c in ("id", "size", "root", "main", "key"))
    lists = lambda c: rows.column(c).combine_chunks().flatten().to_numpy()
    marks = lists("sketch").view(np.uint64).reshape(-1, LONGS)
    if sure:
        keys, found = lists("bands").reshape(-1, BANDS), lists("shingles").view(np.uint64)
        ends = np.cumsum(sizes)
    others, out, parent = np.flatnonzero(~few), [], {}

    def top(x):
        while x in parent:
            x = parent[x]
        return x

    def alike(i, j):
        a, b = (found[ends[k] - sizes[k] : ends[k]] for k in (i, j))
        both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
        return both * WHOLE >= (len(a) + len(b) - both) * PART

    for i in np.flatnonzero(few).tolist():
        n, m = np.minimum(sizes[others], sizes[i]), np.maximum(sizes[others], sizes[i])
        near = others[(root[others] != root[i]) & ((root[others] == main[0]) | (ids[i] < ids[others])) & (n * WHOLE >= m * PART)]
        if sure and len(near):
            first = (keys[near] == keys[i]).argmax(1)
            near = near[keys[i][first] == key[0]]
        if len(near):
            x = marks[near] ^ marks[i]
            x |= x >> np.uint64(1)
            x |= x >> np.uint64(2)
            near = near[np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(1) <= APART]
        for j in near.tolist():
            if sure:
                a, b = top(int(root[i])), top(int(root[j]))
                if a == b or not alike(i, j):
                    continue
                parent[max(a, b)] = min(a, b)
            out.append((min(int(ids[i]), int(ids[j])), max(int(ids[i]), int(ids[j]))))
    return out


def roots(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """id and root, the smallest id that confirmed pairs reach, of each set.

    rows: as of banded(), with row_hash; texts: text and row_hash. Only sets that share a band or a
    SimHash link with another one are made again from their texts.
    """
    nodes = rows.groupBy("id").agg(F.first("size").alias("size"), F.first("fp").alias("fp"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.min("row_hash").alias("row_hash"))
    nodes, n_nodes = counted(nodes, "similar-nodes")
    keyed = nodes.select("id", "size", "row_hash", F.explode("bands").alias("key"))
    least = keyed.groupBy("key").agg(F.min("id").alias("u"), F.min_by("size", "id").alias("u_size"), F.count(F.lit(1)).alias("n")).where("n > 1")
    met = written(by_key(keyed, written(least, "similar-least"), n_nodes * BANDS), "similar-met")
    linked = written(by_simhash(nodes, n_nodes), "similar-linked")
    ends = linked.select(F.col("u").alias("id")).union(linked.select("v"))
    wanted = met.select("row_hash").union(nodes.select("id", "row_hash").join(ends, "id", "left_semi").select("row_hash"))
    wanted, n_wanted = counted(wanted.distinct(), "similar-wanted")
    few = F.broadcast(wanted) if n_wanted <= FEW else wanted
    whole = written(sets(texts.join(few, "row_hash", "left_semi").select("text")), "similar-whole").dropDuplicates(["id"])
    least = met.where((F.col("id") != F.col("u")) & alike_in_size("size", "u_size")).select("u", F.col("id").alias("v"))
    first, _ = confirmed(least.union(linked.select(F.least("u", "v"), F.greatest("u", "v"))).distinct(), whole)

    ties = written(components(first), "similar-ties")
    rooted = nodes.select("id").join(ties, nodes.id == ties.node, "left").select("id", F.coalesce("root", "id").alias("root"))
    met = met.select("id", "size", "key").join(ties, met.id == ties.node, "left").select("id", "size", "key", F.coalesce("root", "id").alias("root"))
    met, n_met = counted(met, "similar-tied")
    more, n_more = counted(across(met, n_met, nodes, whole), "similar-across")
    if not n_more:
        return rooted
    # What the first links tie together is one node for those across.
    rooted = written(rooted, "similar-rooted")
    of = lambda side: rooted.select(F.col("id").alias(side), F.col("root").alias(f"{side}_root"))
    edges = more.join(of("u"), "u").join(of("v"), "v").select(F.col("u_root").alias("u"), F.col("v_root").alias("v"))
    above = written(components(edges), "similar-above").withColumnRenamed("root", "top")
    return rooted.join(above, rooted.root == above.node, "left").select("id", F.coalesce("top", "root").alias("root"))


def drop_near_copies(df: DataFrame) -> DataFrame:
    """One row of each group of near copies, with df's columns: the one with the smallest doc_id.

    Among equal doc_ids the smallest hash of the row decides; a null doc_id comes last. Texts
    without words are copies of each other.
    """
    row_hash = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    texts = df.select("doc_id", "text", row_hash.alias("row_hash"))
    rows = written(banded(texts, ("doc_id", "row_hash")), "similar")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_hash")
    nodes = rows.groupBy("id").agg(F.min(first).alias("k"))
    kept = nodes.join(roots(rows, texts), "id").groupBy("root").agg(F.min("k").alias("k")).select(F.col("k.doc_id").alias("_id"), F.col("k.row_hash").alias("_hash"))
    return only(df, row_hash, kept)
