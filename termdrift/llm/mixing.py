"""Mixing sources to target weights by blocks.

The words of a source, document after document, are packed into blocks of a fixed length. The
output is a row of shards with a fixed number of block slots. How many slots each source gets in
a shard is a multinomial draw, conditioned on the sources' totals so that targets are met: all
slots lie in one keyed pseudorandom order, and where a shard's places in that order fall among
the sources' totals, laid end to end, says how many slots of each it holds, and which. Any task
draws any shard alone, in 64 bits, so the draw is the same one at every size. The k-th slot of a
source with n blocks holds block permutation(k mod n), by a keyed permutation for each pass and
source. Slots and the documents' pieces are then joined by block index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import WORD, arrow_schema, documents, per_text, written


@dataclass(frozen=True)
class Mix:
    """weights repeat over the sources in order; share of all words wanted; passes over a source at most."""

    weights: tuple[float, ...] = (5, 2, 1)
    share: float = 1.5
    passes: int = 2
    block: int = 128
    shard_slots: int = 1024
    seed: int = 11
    #: Documents in a bucket of the running word count, about.
    bucket_rows: int = 500


def targets(sizes: Sequence[int], mix: Mix = Mix()) -> list[float]:
    """Words wanted from each source: by weight, but at most passes times its size, the rest reshared."""
    weights = [mix.weights[i % len(mix.weights)] for i in range(len(sizes))]
    out, left, open_ = [0.0] * len(sizes), mix.share * sum(sizes), list(range(len(sizes)))
    while open_:
        each = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * each >= mix.passes * sizes[i]]
        if not full:
            for i in open_:
                out[i] = weights[i] * each
            break
        for i in full:
            out[i] = float(mix.passes * sizes[i])
            left -= out[i]
        left = max(left, 0.0)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def slots_of(size: int, target: float, mix: Mix = Mix()) -> int:
    """Slots whose blocks hold target words, as nearly as whole blocks can."""
    blocks = -(-size // mix.block)
    whole = min(floor(target / size), mix.passes) if size else 0
    rest = 0 if whole == mix.passes else min(blocks, round((target - whole * size) / mix.block))
    return whole * blocks + rest


def permuted(k: np.ndarray, n: int, key: str) -> np.ndarray:
    """The images of indices k under a keyed permutation of range(n): a Feistel network, walked until within n."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.blake2b(f"{key}:{i}".encode(), digest_size=8).digest(), "big")) for i in range(4)]
    out, todo = k.astype(np.uint64), np.arange(len(k))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & mask
        for x in keys:
            mixed = (right + x) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def shard_slots(counts: np.ndarray, first: int, last: int, mix: Mix = Mix()) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shard, source, number within the source) of each slot of shards first to last - 1.

    counts: slots of each source. A shard's counts by source are multivariate hypergeometric: a
    multinomial draw given the totals.
    """
    total = int(counts.sum())
    place = np.arange(first * mix.shard_slots, min(last * mix.shard_slots, total))
    drawn = permuted(place, total, f"{mix.seed}:slots")
    ends = np.cumsum(counts)
    source = np.searchsorted(ends, drawn, "right")
    return place // mix.shard_slots, source, drawn - (ends - counts)[source]


def plan(sized: DataFrame, mix: Mix = Mix()) -> list[tuple]:
    """(index, source, size, target, slots) of each source by code point, null last.

    The recipe has a row for each source and is held by the driver, as its weights are given there.
    """
    found = {r[0]: r[1] for r in sized.groupBy("source").agg(F.sum("size")).collect()}
    names = sorted((x for x in found if x is not None)) + [None] * (None in found)
    sizes = [found[x] for x in names]
    return [(i, s, n, t, slots_of(n, t, mix)) for i, (s, n, t) in enumerate(zip(names, sizes, targets(sizes, mix)))]


def slot_table(spark: SparkSession, recipe: list[tuple], mix: Mix = Mix()) -> DataFrame:
    """shard, source (its index), pass, block: a row for each slot of the output."""
    schema = StructType.fromDDL("shard bigint, source_index int, pass int, block bigint")
    arrow = arrow_schema(schema)
    counts = np.array([r[4] for r in recipe], np.int64)
    blocks = [-(-r[2] // mix.block) for r in recipe]
    shards = ceil(int(counts.sum()) / mix.shard_slots)

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for low in range(0, len(ids), 256):
                some = ids[low : low + 256]
                shard, source, k = shard_slots(counts, int(some[0]), int(some[-1]) + 1, mix)
                turn, block = np.zeros_like(k), np.zeros_like(k)
                for s in np.unique(source).tolist():
                    own = np.flatnonzero(source == s)
                    turn[own] = k[own] // blocks[s]
                    for p in np.unique(turn[own]).tolist():
                        at = own[turn[own] == p]
                        block[at] = permuted(k[at] % blocks[s], blocks[s], f"{mix.seed}:{recipe[s][1]}:{p}")
                columns = (shard, source, turn, block)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    parts = max(1, min(shards, shards // 64 + 1))
    return spark.range(0, shards, 1, parts).mapInArrow(run, schema)


def sized_documents(df: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and row_hash (of all columns) of each row, as a table."""
    return written(
        df.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"), F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)).alias("row_hash")),
        "mix-sizes",
    )


def running(rows: DataFrame, keys: list[str], bucket: str, words: str, out: str, levels: int = 2, width: int = 4096) -> DataFrame:
    """rows (one for each keys and bucket, a number) with out: the sum of words in lower buckets.

    Buckets are summed by levels, each width times coarser than the one below, so that no window
    holds more than width rows but the topmost, whose buckets are width to the power of levels wide.
    """
    if not levels:
        over = W.partitionBy(*keys).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
        return rows.withColumn(out, F.coalesce(F.sum(words).over(over), F.lit(0)))
    wide, base = f"{bucket}_", f"{out}_"
    rows = rows.withColumn(wide, F.floor(F.col(bucket) / width))
    sums = running(rows.groupBy(*keys, wide).agg(F.sum(words).alias(words)), keys, wide, words, base, levels - 1, width)
    over = W.partitionBy(*keys, wide).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    inner = rows.withColumn(out, F.coalesce(F.sum(words).over(over), F.lit(0)))
    joined = inner.join(sums.drop(words), [*keys, wide])
    return joined.withColumn(out, F.col(out) + F.col(base)).drop(wide, base)


def placed(sized: DataFrame, recipe: list[tuple], mix: Mix = Mix()) -> DataFrame:
    """sized with source_index, source_size, target and start: the words of its source before it.

    The running count goes by buckets of different rows, and over the buckets by levels, so that a
    source with most rows is no single group. Equal rows are counted once and then laid out one
    after another, so that many copies of a row are no large group either.
    """
    spark = sized.sparkSession
    schema = "source_index int, recipe_source string, source_size bigint, target double"
    sources = spark.createDataFrame([r[:4] for r in recipe], schema)
    if len(recipe) <= 100_000:
        sources = F.broadcast(sources)
    buckets = max(1, -(-sized.count() // mix.bucket_rows))
    once = sized.groupBy("doc_id", "source", "size", "row_hash").agg(F.count(F.lit(1)).alias("copies"))
    rows = once.join(sources, F.col("source").eqNullSafe(F.col("recipe_source"))).drop("recipe_source")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "row_hash"), F.lit(buckets)))
    words = F.col("size") * F.col("copies")
    sums = rows.groupBy("source_index", "bucket").agg(F.sum(words).alias("words"))
    sums = running(sums, ["source_index"], "bucket", "words", "base").drop("words")
    within = W.partitionBy("source_index", "bucket").orderBy("doc_id", "row_hash").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum(words).over(within), F.lit(0)))
    rows = rows.join(sums, ["source_index", "bucket"])
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))
    rows = rows.withColumn("copy", each).withColumn("start", F.col("base") + F.col("inner") + F.col("copy") * F.col("size"))
    return rows.drop("bucket", "inner", "base", "copy", "copies")


def pieces(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """rows of placed that have words, once for each block they lie in: with block, low and high
    (their words within it, by number in the document)."""
    blocks = F.sequence(F.floor(F.col("start") / mix.block), F.floor((F.col("start") + F.col("size") - 1) / mix.block))
    out = rows.where("size > 0").withColumn("block", F.explode(blocks))
    low = F.greatest(F.lit(0), F.col("block") * mix.block - F.col("start"))
    high = F.least(F.col("size"), (F.col("block") + 1) * mix.block - F.col("start"))
    return out.withColumns({"low": low, "high": high})


def taken_words(df: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """doc_id, size, source_size, target and taken of each row of documents.

    A null or empty text has size 0 and nothing is taken from it. A null source is a source.
    Repeated rows are documents of their own. An empty table gives an empty one; other columns
    don't matter, and the result depends on the rows alone, not on their order.
    """
    spark = df.sparkSession
    sized = sized_documents(df.select("doc_id", "text", "source"))
    recipe = plan(sized, mix)
    rows = placed(sized, recipe, mix)
    times = slot_table(spark, recipe, mix).groupBy("source_index", "block").agg(F.count(F.lit(1)).alias("times"))
    columns = ("doc_id", "size", "source_size", "target")
    # Slots are made from a range, whose size the planner takes for theirs: never broadcast them.
    found = pieces(rows, mix).join(times.hint("merge"), ["source_index", "block"], "left")
    some = found.groupBy("source_index", "start", "row_hash", *columns).agg(F.sum((F.col("high") - F.col("low")) * F.coalesce("times", F.lit(0))).alias("taken"))
    none = rows.where("size = 0").select(*columns, F.lit(0).cast("bigint").alias("taken"))
    return some.select(*columns, "taken").unionByName(none)


def mix_documents(df: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mixture as documents: for each document and pass, the words taken from it, as text.

    Columns are those of df; text has the taken stretches of the document in order, joined by a
    line feed where words between them aren't taken, and n_chars, if there, is its length.
    Documents (with null or empty texts, too) of which nothing is taken go, an empty table gives
    an empty one; repeated rows are documents of their own; columns of other names pass through.
    """
    spark = df.sparkSession
    sized = sized_documents(df)
    recipe = plan(sized, mix)
    slots = slot_table(spark, recipe, mix).select("source_index", "block", "pass")
    found = pieces(placed(sized, recipe, mix), mix).join(slots.hint("merge"), ["source_index", "block"])
    spans = found.groupBy("doc_id", "row_hash", "source_index", "start", "pass").agg(F.array_sort(F.collect_list(F.struct("low", "high"))).alias("_spans"))
    names = {c: f"_c{i}" for i, c in enumerate(df.columns)}
    whole = df.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)).alias("_hash"),
        *(F.col(f"`{c}`").alias(n) for c, n in names.items()),
    ).dropDuplicates(["_id", "_hash"])
    spans = spans.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"), F.col("row_hash").alias("_hash"), "_spans")
    rows = whole.join(spans, ["_id", "_hash"]).drop("_id", "_hash")
    text = names["text"]
    rows = rows.withColumn("_both", F.struct(F.col(text).alias("text"), "_spans"))

    def start():
        import re

        words = re.compile(WORD)

        def cut(both):
            at = [m.span() for m in words.finditer(both["text"])]
            merged: list[list[int]] = []
            for x in both["_spans"]:
                if merged and merged[-1][1] == x["low"]:
                    merged[-1][1] = x["high"]
                else:
                    merged.append([x["low"], x["high"]])
            return "\n".join(both["text"][at[a][0] : at[b - 1][1]] for a, b in merged)

        return lambda both: [[cut(x) for x in both]]

    done = per_text(rows.drop("_spans"), start, "_cut string", tuple(n for n in names.values() if n != text), "_both", size_of=text)
    out = []
    for c, n in names.items():
        if c == "text":
            out.append(F.col("_cut").alias(c))
        elif c == "n_chars":
            out.append(F.char_length("_cut").cast(df.schema[c].dataType).alias(c))
        else:
            out.append(F.col(n).alias(c))
    return done.select(*out)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(documents(spark, sf_dir))
