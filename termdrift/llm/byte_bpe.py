"""Byte-level BPE by merge replay over the corpus's words.

1. Texts are split into words (pattern matches) once. A block of texts is written as the numbers
   of its words, together with the words that have the numbers, packed by buckets of their hash.
2. The words of all blocks meet by bucket. Each different one is encoded once: words are laid end
   to end as bytes, linked to their neighbours; an inverted index maps each mergeable token pair to
   the positions where it stands; merges are replayed in rank order, and each one touches only the
   positions of its pair and their neighbours.
3. The ids go back to the blocks, each of which gets a file of them, and
4. each text is put together from its numbers and its block's file.

Only packed words and ids are shuffled, neither texts nor numbers. Blocks and stretches of words
that are encoded together are bounded, so memory is, too, and every step can be run again.
"""

from __future__ import annotations

import base64
import hashlib
import os
import uuid
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import arrow_schema, batches_of, documents, per_text, plain_text, shared_path, slices

#: Bytes of text in a block; a longer text makes a block of its own.
BLOCK_BYTES = 32 << 20
#: Bytes of text, or of numbers, that a task has at once outside of a block's words, about.
PART_BYTES = 1 << 20
#: Buckets of a block's words, and different words that are encoded together, about.
BUCKETS, STRETCH = 256, 200_000
#: Words of blocks, repeats included, that wait for their ids at once, about.
WAITING = 1_000_000
#: Slots of the table of mergeable pairs, and positions that are indexed at once.
SLOTS, POSITIONS = 1 << 20, 1 << 18


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks by token of a .tiktoken file: base64 of the token, a blank and its rank, line by line."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}


class MergeReplay:
    """Encodes sets of words by replaying the merges in rank order over all of them at once.

    Positions are bytes of the words laid end to end, with a border between words. For each
    position there are the token that starts there, its neighbours and the rank of the pair it
    forms with the next one. waiting is the inverted index: pair rank -> positions.
    """

    NONE = 1 << 30  # the rank of a pair that doesn't merge
    BORDER, GONE = -1, -2

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([b])] for b in range(255)] + [self.BORDER], np.int32)  # UTF-8 has no byte 255
        keys, merged = [], []
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                left = ranks.get(token[:cut])
                right = left is not None and ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(r)
        pairs = np.array(keys, np.int64)
        self.keys, self.merged = np.full(SLOTS, -1, np.int64), np.full(SLOTS, self.NONE, np.int32)
        slot = self.slot(pairs)
        self.keys[slot], self.merged[slot] = pairs, merged
        lost = self.keys[slot] != pairs  # another pair has the slot
        order = np.argsort(pairs[lost])
        self.lost_keys, self.lost_merged = np.append(pairs[lost][order], 1 << 62), np.append(np.array(merged)[lost][order], self.NONE)
        self.shared = np.zeros(SLOTS, bool)
        self.shared[slot[lost]] = True

    @staticmethod
    def slot(pairs: np.ndarray) -> np.ndarray:
        return ((pairs ^ (pairs >> 29)) * 0x9E3779B97F4A7C1 >> 31) & (SLOTS - 1)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """What pairs merge to, NONE for those that don't."""
        pairs = (left.astype(np.int64) << 32) | right
        slot = self.slot(pairs)
        out = np.where((left >= 0) & (right >= 0) & (self.keys[slot] == pairs), self.merged[slot], self.NONE)
        if len(other := np.flatnonzero(self.shared[slot] & (out == self.NONE))):
            at = np.searchsorted(self.lost_keys, pairs[other])
            out[other] = np.where(self.lost_keys[at] == pairs[other], self.lost_merged[at], self.NONE)
        return out

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words (none is empty), and how many each has. A word that is a token is that token, as the library has it."""
        whole = np.fromiter((self.ranks.get(w, -1) for w in words), np.int64, len(words))
        rest = np.flatnonzero(whole < 0)
        sizes = np.ones(len(words), np.int64)
        merged, sizes[rest] = self.merge([words[i] for i in rest.tolist()]) if len(rest) else (whole[:0], 0)
        out, alone = np.empty(sizes.sum(), np.uint32), np.repeat(whole >= 0, sizes)
        out[alone], out[~alone] = whole[whole >= 0], merged
        return out, sizes

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = self.single[np.frombuffer(b"\xff" + b"\xff".join(words) + b"\xff", np.uint8)]
        if len(ids) >= 1 << 31:
            raise ValueError(f"words of {len(ids)} bytes can't be encoded together")
        after, before = np.arange(1, len(ids) + 1, dtype=np.int32), np.arange(-1, len(ids) - 1, dtype=np.int32)
        after[-1] = len(ids) - 1
        borders = np.flatnonzero(ids == self.BORDER)
        pair = np.full(len(ids), self.NONE, np.int32)
        for i in range(0, len(ids) - 1, POSITIONS):
            right = ids[i + 1 : i + 1 + POSITIONS]
            pair[i : i + len(right)] = self.rank(ids[i : i + len(right)], right)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []
        again: set[int] = set()

        def put(places: np.ndarray) -> None:
            """Adds positions to the index under the ranks of their pairs."""
            r = pair[places]
            places, r = places[r < self.NONE], r[r < self.NONE]
            order = np.argsort(r, kind="stable")
            places, r = places[order], r[order]
            cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
            for rank, group in zip(r[np.append(0, cuts)].tolist() if len(r) else (), np.split(places, cuts)):
                if rank in waiting:
                    waiting[rank].append(group)
                else:
                    waiting[rank] = [group]
                    heappush(queue, rank)

        for i in range(0, len(ids), POSITIONS):
            put(np.arange(i, min(i + POSITIONS, len(ids)), dtype=np.int32))
        while queue:
            r = heappop(queue)
            at = waiting.pop(r)
            at = at[0] if len(at) == 1 else np.concatenate(at)
            at = at[pair[at] == r]
            if not len(at):
                continue
            at.sort()
            at = at[np.append(True, at[1:] != at[:-1])]
            chained = np.append(False, after[at[:-1]] == at[1:])
            if chained.any():  # such pairs overlap: in each chain every other one merges, from the left
                index = np.arange(len(at))
                at = at[(index - np.maximum.accumulate(np.where(chained, 0, index))) % 2 == 0]
            gone = after[at]
            end = after[gone]
            ids[at], ids[gone], pair[gone] = r, self.GONE, self.NONE
            after[at], before[end] = end, at
            left = before[at]
            pair[at] = self.rank(ids[at], ids[end])
            pair[left] = self.rank(ids[left], ids[after[left]])
            touched = np.concatenate((left, at))
            low = touched[pair[touched] < r]
            if len(low):  # an earlier merge became possible: these words are done one by one below
                again.update(np.searchsorted(borders, low, "right").tolist())
            put(touched)
        left = ids[ids != self.GONE]
        sizes, flat = np.diff(np.flatnonzero(left == self.BORDER)) - 1, left[left != self.BORDER]
        ends, parts, at = np.cumsum(sizes), [], 0
        for i in sorted(again):
            one = self.merge_one(words[i - 1])
            parts += [flat[at : ends[i - 1] - sizes[i - 1]], np.array(one, flat.dtype)]
            at, sizes[i - 1] = ends[i - 1], len(one)
        return np.concatenate([*parts, flat[at:]]), sizes

    def merge_one(self, word: bytes) -> list[int]:
        """The same for one word by the definition: always the leftmost pair of the lowest rank."""
        parts = [bytes([b]) for b in word]
        while True:
            found = min(((self.ranks.get(a + b, self.NONE), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))), default=(self.NONE, 0))
            if found[0] == self.NONE:
                return [self.ranks[p] for p in parts]
            parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]


class Numbers(dict):
    """Words by number, in the order in which they were first asked for."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class Codec:
    """Splits texts, encodes words and decodes ids with a rank file's vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.find = regex.compile(pattern).findall
        self.replay = MergeReplay(ranks)
        self.bytes_of = {i: t for t, i in ranks.items()}

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Per text its ids; null is an empty text. What the steps below do, in one place."""
        numbers = Numbers()
        split = [[numbers[w] for w in self.find(t)] if t else [] for t in texts]
        flat, sizes = self.replay.encode([w.encode() for w in numbers])
        ids = [x.tolist() for x in np.split(flat, np.cumsum(sizes)[:-1])]
        return [[i for n in x for i in ids[n]] for x in split]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _codec(spark: SparkSession, path: str, pattern: str):
    """A function that makes a Codec on an executor; the rank file (its size is checked) is broadcast."""
    with open(path, "rb") as f:
        lines = f.read()
    if len(lines) > 64 << 20:
        raise ValueError(f"{path} has {len(lines)} bytes; a rank file of 64 MB at most is expected")
    sent = spark.sparkContext.broadcast(lines)
    return lambda: Codec(read_ranks(sent.value), pattern)


def planes(x: np.ndarray) -> bytes:
    """Numbers below 2^32 as bytes, the lowest bytes of all first: high ones are mostly alike and pack well."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unplaned(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def packed(*parts: bytes) -> bytes:
    """Byte strings as one, compressed."""
    raw = b"".join(len(x).to_bytes(8, "big") + x for x in parts)
    return len(raw).to_bytes(8, "big") + pa.Codec("zstd", compression_level=6).compress(raw, asbytes=True)


def unpacked(data: bytes) -> list[bytes]:
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "big"), codec="zstd", asbytes=True)
    out, at = [], 0
    while at < len(raw):
        end = at + 8 + int.from_bytes(raw[at : at + 8], "big")
        out.append(raw[at + 8 : end])
        at = end
    return out


def pieces(data: bytes, sizes: np.ndarray) -> list[bytes]:
    """data cut into pieces of the given sizes."""
    ends = np.cumsum(sizes).tolist()
    return [data[i:j] for i, j in zip([0, *ends], ends)]


def numbered(df: DataFrame, pattern: str, id_col: str, text_col: str) -> DataFrame:
    """df in blocks, as a table with two kinds of rows.

    block, key and data (its words' numbers) of each text; block, bucket and data (numbers and
    words) of each bucket of a block's words. A block's name is drawn; being written once, it is
    the same for all who read it.
    """
    schema = StructType.fromDDL("block bigint, bucket int, data binary").add("key", df.schema[id_col].dataType)
    arrow = arrow_schema(schema)

    def run(batches):
        import regex

        find = regex.compile(pattern).findall
        block, numbers, size = None, Numbers(), 0

        def done() -> Iterator[pa.RecordBatch]:
            """The rows of the block's words, which are forgotten."""
            words = [w.encode() for w in numbers]
            numbers.clear()
            bucket = np.fromiter(map(crc32, words), np.uint32, len(words)) % BUCKETS
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            groups = np.split(order, cuts) if len(words) else []
            data = []
            for g in groups:
                own = [words[i] for i in g.tolist()]
                data.append(packed(planes(np.diff(g, prepend=0)), planes(np.array([len(w) for w in own])), b"".join(own)))
            m = len(groups)
            columns = [pa.array(np.full(m, block)), pa.array([int(bucket[g[0]]) for g in groups], pa.int32()), pa.array(data, pa.binary()), pa.nulls(m, arrow.field("key").type)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

        for part in slices(batches, "text", min(PART_BYTES, BLOCK_BYTES)):  # few texts at a time as Python's strings
            more = pa.compute.sum(pa.compute.binary_length(part.column("text"))).as_py() or 0
            if block is not None and size + more > BLOCK_BYTES:
                yield from done()
                block = None
            if block is None:
                block, size = int.from_bytes(os.urandom(8), "big") >> 1, 0
            size += more
            n = part.num_rows
            found = [planes(np.fromiter(map(numbers.__getitem__, find(t)), np.uint32)) if t else b"" for t in part.column("text").to_pylist()]
            columns = [pa.array(np.full(n, block)), pa.nulls(n, pa.int32()), pa.array(found, pa.binary()), part.column("key").cast(arrow.field("key").type)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)
        if block is not None:
            yield from done()

    spark, path = df.sparkSession, shared_path(df.sparkSession, "bpe-numbers")
    rows = df.select(F.col(f"`{id_col}`").alias("key"), plain_text(F.col(f"`{text_col}`")).alias("text"))
    with batches_of(spark, 4 * PART_BYTES):
        rows.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def encoded_words(words: DataFrame, make: Callable[[], Codec]) -> DataFrame:
    """block and data (numbers and ids) of words (block, bucket, data): equal words meet and are encoded together.

    Words stay known, each with its number, until there are STRETCH of them and a bucket ends (or four
    times as many); what blocks ask for waits as numbers and is answered every WAITING words.
    """
    schema = StructType.fromDDL("block bigint, data binary")
    arrow = arrow_schema(schema)

    def run(batches):
        replay = make().replay
        known, ids = {}, pa.array([], pa.list_(pa.uint32()))
        rows, waiting, last = [], 0, None

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal ids
            flat, sizes = replay.encode(list(islice(known, len(ids), None)))
            ends = np.append(0, np.cumsum(sizes))
            ids = pa.concat_arrays([ids, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))])
            for i in range(0, len(rows), 256):
                out = []
                for block, steps, own in rows[i : i + 256]:
                    found = ids.take(pa.array(own))
                    out.append((block, packed(steps, planes(pa.compute.list_value_length(found).to_numpy()), planes(found.flatten().to_numpy()))))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

        for batch in batches:
            for block, bucket, data in zip(*(batch.column(c).to_pylist() for c in ("block", "bucket", "data"))):
                full = len(known) >= STRETCH and (bucket != last or len(known) >= 4 * STRETCH)
                if full or waiting >= WAITING:
                    yield from done()
                    rows, waiting = [], 0
                if full:
                    known, ids = {}, ids[:0]
                last = bucket
                steps, sizes, text = unpacked(data)
                own = pieces(text, unplaned(sizes))
                rows.append((block, steps, np.fromiter((known.setdefault(w, len(known)) for w in own), np.uint32, len(own))))
                waiting += len(own)
        yield from done()

    return words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def write_blocks(words: DataFrame, path: str) -> None:
    """A file for each block below path, named by it, with the ids of its words by number."""

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)

        def done(block: int, rows: list[bytes]) -> None:
            number, size, ids = ([], [], [])
            for data in rows:
                steps, sizes, flat = map(unplaned, unpacked(data))
                number.append(np.cumsum(steps, dtype=np.int64))
                size.append(sizes.astype(np.int64))
                ids.append(flat)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.concatenate(size))), pa.int32()), pa.array(np.concatenate(ids).astype(np.int32)))
            lists = lists.take(pa.array(np.argsort(np.concatenate(number))))
            table = pa.table({"ids": lists})
            name = f"{root}/{block}"
            part = f"{name}.{uuid.uuid4().hex}"  # an attempt that is run twice writes the same file
            with store.open_output_stream(part, compression=None) as sink, pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table)
            try:
                store.move(part, name)
            except OSError:
                if store.get_file_info(name).type != fs.FileType.File:
                    raise
                store.delete_file(part)

        block, rows, n = None, [], 0
        for batch in batches:
            for name, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist()):
                if name != block and rows:
                    done(block, rows)
                    rows, n = [], n + 1
                block = name
                rows.append(data)
        if rows:
            done(block, rows)
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    words.repartition("block").sortWithinPartitions("block").mapInArrow(run, "n bigint").agg(F.sum("n")).collect()


def encoded(df: DataFrame, path: str, pattern: str, id_col: str, text_col: str, fields: str, start: Callable) -> DataFrame:
    """id_col and fields of each text.

    start(codec) makes a function of the ids of a block's words (array of lists), which makes one
    of texts (arrays of word numbers) that gives the columns of fields.
    """
    make = _codec(df.sparkSession, path, pattern)
    table = numbered(df, pattern, id_col, text_col)
    folder = shared_path(df.sparkSession, "bpe-blocks")
    write_blocks(encoded_words(table.where("bucket IS NOT NULL").select("block", "bucket", "data"), make), folder)
    key = df.schema[id_col]
    schema = StructType([type(key)("key", key.dataType, True), *StructType.fromDDL(fields).fields])
    arrow = arrow_schema(schema)

    def run(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        of_block, block, work = start(make()), None, None
        none = pa.array([], pa.list_(pa.int32()))
        for batch in slices(batches, "data", PART_BYTES):
            names = batch.column("block").to_numpy()
            cuts = (np.flatnonzero(names[1:] != names[:-1]) + 1).tolist()
            for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
                if low == high:
                    continue
                part = batch.slice(low, high - low)
                texts = [unplaned(x) for x in part.column("data").to_pylist()]
                if names[low] != block:
                    block, work = names[low], None
                if work is None and any(map(len, texts)):  # a block without words has no file
                    with store.open_input_stream(f"{root}/{block}") as source:
                        work = of_block(pa.ipc.open_stream(source).read_all()["ids"].combine_chunks())
                new = (work or of_block(none))(texts)
                columns = [part.column("key"), *new]
                yield pa.RecordBatch.from_arrays([(c if isinstance(c, pa.Array) else pa.array(c)).cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return table.where("bucket IS NULL").select("block", "key", "data").mapInArrow(run, schema).withColumnRenamed("key", id_col)


def _taken(ids: pa.Array, texts: list[np.ndarray]) -> pa.Array:
    """The ids of texts given by the numbers of their words."""
    found = ids.take(pa.array(np.concatenate(texts)))
    sizes = np.append(0, np.cumsum(pa.compute.list_value_length(found).to_numpy()))
    ends = np.append(0, np.cumsum([len(x) for x in texts]))
    return pa.ListArray.from_arrays(pa.array(sizes[ends], pa.int32()), found.flatten())


def encode_documents(df: DataFrame, path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_tokens and ids (array of int): each whole text encoded, without special tokens.

    path: a rank file readable by the driver. A null or empty text gets an empty array; repeated
    rows each get a row; an empty table gives an empty one; other columns are left out, so their
    names can't clash. An id_col named n_tokens or ids is refused with ValueError. A text is one
    task's, however long, and a block of its own if it is longer than BLOCK_BYTES.
    """
    if id_col in ("n_tokens", "ids"):
        raise ValueError(f"id_col can't be {id_col}, which is a column of the result")
    done = encoded(df, path, pattern, id_col, text_col, "ids array<int>", lambda codec: lambda ids: lambda texts: [_taken(ids, texts)])
    return done.select(id_col, F.size("ids").cast("bigint").alias("n_tokens"), "ids")


def decode_documents(df: DataFrame, path: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id_col and text: the ids of encode_documents decoded again.

    Bytes that are no UTF-8 become U+FFFD; null ids give an empty text.
    """
    make = _codec(df.sparkSession, path, r"\S+")

    def start():
        codec = make()
        return lambda texts: [[codec.decode(t or ()).decode("utf-8", "replace") for t in texts]]

    bare = df.select(F.col(f"`{id_col}`").alias("_key"), F.col(f"`{ids_col}`").alias("_ids"))
    return per_text(bare, start, "text string", ("_key",), "_ids").withColumnRenamed("_key", id_col)


def token_digests(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: texts encoded, digested, decoded and digested.

    Null texts are empty ones: no tokens and the digests of nothing. Repeated rows give repeated
    rows, a null doc_id stays null, and other columns are ignored.
    """
    sha = lambda x: hashlib.sha256(x).hexdigest()

    def start(codec):
        names = {i: str(i) for i in codec.bytes_of}

        def of_block(ids):
            told, back = [], []
            for i in range(0, len(ids), 10_000):
                each = ids.slice(i, 10_000).to_pylist()
                told += [" ".join(map(names.__getitem__, x)) for x in each]
                back += [codec.decode(x) for x in each]
            counts = pa.compute.list_value_length(ids).to_numpy().astype(np.int64)

            def work(texts):
                lists = [x.tolist() for x in texts]
                return [
                    [int(counts[x].sum()) for x in texts],
                    [sha(" ".join(map(told.__getitem__, x)).encode()) for x in lists],
                    [sha(b"".join(map(back.__getitem__, x))) for x in lists],
                ]

            return work

        return of_block

    return encoded(df, path, pattern, "doc_id", "text", "n_tokens bigint, ids_sha256 string, decoded_sha256 string", start)


def vocabulary() -> tuple[str, str]:
    """Path and pattern of the public vocabulary that the query uses."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(documents(spark, sf_dir), *vocabulary())
