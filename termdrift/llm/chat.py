"""Transcript parsing: a hidden Markov model over lines recovers who speaks, by Viterbi.

A transcript is a conversation's rows in order, each split into lines. The hidden state of a line
is its role. A line shows a speaker marker ("User:", "### Assistant:", "<|system|>", ...) or none,
the row's role field (on its first line, as a marker), its length and whether it asks. Between
lines of a row the role mostly stays, from row to row it mostly alternates. Lines with one role
form a turn, which is rendered canonically.

Conversations of up to LONG rows are decoded where they lie. Longer ones are cut into pieces of
about LONG rows by range; each piece's best path scores between its border states form a small
matrix, the matrices are combined along the conversation, and then every piece is decoded on its
own between its borders, which gives the path of the whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby
from math import log as natural
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import plain_text, written

ROLES = ("system", "user", "assistant")
#: Rows of a conversation that one task holds at most, about.
LONG = 10_000


def log(p: float) -> int:
    """Millionths of a nat: whole numbers add up alike in any order, so pieces agree with the whole."""
    return round(1e6 * natural(p))


# Fixed values.
ALIASES = {
    "system": 0, "sys": 0, "instructions": 0, "instruction": 0, "context": 0,
    "user": 1, "human": 1, "prompter": 1, "customer": 1, "me": 1, "q": 1, "question": 1, "prompt": 1,
    "assistant": 2, "ai": 2, "bot": 2, "gpt": 2, "chatgpt": 2, "model": 2, "agent": 2, "a": 2, "answer": 2, "response": 2,
}
MARKER = re.compile(r"[ \t]*(?:#{1,4}[ \t]*|\*\*|[\[<]\|?|>[ \t]*)?([A-Za-z]{1,12})(?:\|?[\]>]:?|\*\*:|:\*\*|[ \t]?:)[ \t]*")
START = [log(p) for p in (0.38, 0.6, 0.02)]
BETWEEN_ROWS = [[log(p) for p in row] for row in ((0.04, 0.94, 0.02), (0.01, 0.07, 0.92), (0.01, 0.92, 0.07))]
WITHIN_ROW = [[log(p) for p in row] for row in ((0.98, 0.01, 0.01), (0.002, 0.988, 0.01), (0.002, 0.01, 0.988))]
#: A marker's probability by its role (rows) and the line's (columns); a table's fields are surer still.
MARKED, FIELD = ([[log(p if i == j else (1 - p) / 2) for j in range(3)] for i in range(3)] for p in (0.995, 0.998))
#: Lines with fewer characters than these, by role, and lines that ask.
LENGTHS = (40, 120, 300, 800)
LENGTH = [[log(p) for p in row] for row in ((0.1, 0.3, 0.3, 0.2, 0.1), (0.2, 0.35, 0.25, 0.14, 0.06), (0.1, 0.2, 0.3, 0.25, 0.15))]
ASKS = [(log(1 - p), log(p)) for p in (0.02, 0.25, 0.08)]


def alias(role: str | None) -> int | None:
    return ALIASES.get(role.strip().lower()) if role else None


def lines_of(turn: int | None, role: str | None, text: str | None) -> list[tuple[bool, list[int], str]]:
    """(whether it is the row's first, log-likelihood by role, text without its marker) of each line.

    A few millionths from a hash of the line's place settle ties.
    """
    out = []
    for i, line in enumerate((text or "").split("\n")):
        m = MARKER.match(line)
        told = ALIASES.get(m[1].lower()) if m else None
        body = line[m.end() :] if told is not None else line
        kind = sum(len(body) >= n for n in LENGTHS)
        asks = body.rstrip().endswith(("?", "？"))
        place = crc32(f"{turn}:{i}:{len(body)}".encode())
        score = [LENGTH[s][kind] + ASKS[s][asks] + (place >> 6 * s & 63) for s in range(3)]
        if told is not None:
            score = [x + MARKED[told][s] for s, x in enumerate(score)]
        elif i == 0 and (told := alias(role)) is not None:
            score = [x + FIELD[told][s] for s, x in enumerate(score)]
        out.append((i == 0, score, body))
    return out


def viterbi(lines: list[tuple[bool, list[int], str]], before: list[float] | None = None, after: list[float] | None = None) -> list[int]:
    """The likeliest roles; before: scores of the states just before the lines; after: of what follows them."""
    best: list[float] = []
    back: list[tuple[int, int, int]] = []
    for i, (first, score, _) in enumerate(lines):
        if i == 0 and before is None:
            best = [START[s] + score[s] for s in range(3)]
            continue
        if i == 0:
            best = before
        move = BETWEEN_ROWS if first else WITHIN_ROW
        come = [max(range(3), key=lambda p: best[p] + move[p][s]) for s in range(3)]  # noqa: B023
        best = [best[p] + move[p][s] + score[s] for s, p in enumerate(come)]
        back.append(tuple(come))
    if not lines:
        return []
    path = [max(range(3), key=lambda s: best[s] + (after[s] if after else 0.0))]
    for come in reversed(back if before is None else back[1:]):  # the first of a piece leads out of it
        path.append(come[path[-1]])
    return path[::-1]


def matrix(lines: list[tuple[bool, list[int], str]]) -> tuple[np.ndarray, np.ndarray]:
    """Best scores over the lines from each state before them to each last state; and from a start."""
    rows = np.where(np.eye(3, dtype=bool), 0.0, -np.inf)
    start = None
    for first, score, _ in lines:
        move = np.array(BETWEEN_ROWS if first else WITHIN_ROW)
        rows = (rows[:, :, None] + move[None]).max(1) + np.array(score)
        start = np.array(START) + np.array(score) if start is None else (start[:, None] + move).max(0) + np.array(score)
    return rows, start


def render(role: str, text: str) -> str:
    """The canonical turn; what looks like its marks within a text is broken up."""
    body = text.replace("<|im_", "< |im_")
    return f"<|im_start|>{role}\n{body}<|im_end|>"


OUT = "conv_id bigint, turn bigint, part int, role string, rendered string"
ARROW = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("part", pa.int32()), ("role", pa.string()), ("rendered", pa.string())])


def parsed(rows: list[tuple], before: list[float] | None = None, after: list[float] | None = None) -> Iterator[tuple]:
    """OUT's rows for rows (conv_id, turn, role, text) of a conversation, or a piece of one, in order."""
    own = [lines_of(turn, role, text) for _, turn, role, text in rows]
    path = iter(viterbi([x for lines in own for x in lines], before, after))
    for (conv, turn, _, _), lines in zip(rows, own):
        told = [(next(path), body) for _, _, body in lines]
        for part, (role, group) in enumerate(groupby(told, key=lambda x: x[0])):
            yield conv, turn, part, ROLES[role], render(ROLES[role], "\n".join(body for _, body in group))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [[]] * len(ARROW), ARROW)], schema=ARROW)


def _decode(batches):
    """Sorted rows to OUT's; rows of a conversation follow each other, a null one is alone."""
    kept: list[tuple] = []
    for batch in batches:
        out = []
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text"))):
            if kept and (row[0] is None or row[0] != kept[-1][0]):
                out += parsed(kept)
                kept = []
            kept.append(row)
        yield _batch(out)
    if kept:
        yield _batch(list(parsed(kept)))


def _long(rows: DataFrame, pieces: int) -> DataFrame:
    """OUT's rows of conversations too long for a task."""
    text_hash = F.xxhash64("text")
    keys = ("conv_id", F.col("turn").asc_nulls_last(), "role", text_hash)
    rows = rows.repartitionByRange(pieces, *keys).withColumn("piece", F.spark_partition_id())
    rows = written(rows, "chat-pieces")
    columns = ("conv_id", "turn", "role", "text")

    def ordered(table: pa.Table) -> list[tuple]:
        found = zip(*(table[c].to_pylist() for c in (*columns, "h")))
        return [x[:4] for x in sorted(found, key=lambda x: (x[1] is None, x[1], x[2] is not None, x[2] or "", x[4], x[3] or ""))]

    def scores(table: pa.Table) -> pa.Table:
        found, start = matrix([x for r in ordered(table) for x in lines_of(r[1], r[2], r[3])])
        return pa.table({
            "conv_id": pa.array(table["conv_id"].to_pylist()[:1], pa.int64()), "piece": pa.array(table["piece"].to_pylist()[:1], pa.int32()),
            "m": pa.array([found.ravel().tolist()], pa.list_(pa.float64())), "start": pa.array([start.tolist()], pa.list_(pa.float64())),
        })

    def borders(table: pa.Table) -> pa.Table:
        order = np.argsort(table["piece"].to_numpy())
        ms = [np.array(table["m"][int(i)].as_py()).reshape(3, 3) for i in order]
        before, after = [None], [[0.0] * 3]
        at = np.array(table["start"][int(order[0])].as_py())
        for m in ms[1:]:
            before.append((at - at.max()).tolist())
            at = (before[-1] + m.T).max(1)
        for m in reversed(ms[1:]):
            tail = (m + np.array(after[-1])[None]).max(1)
            after.append((tail - tail.max()).tolist())
        return pa.table({
            "conv_id": table["conv_id"], "piece": table["piece"].take(pa.array(order)),
            "before": pa.array(before, pa.list_(pa.float64())), "after": pa.array(after[::-1], pa.list_(pa.float64())),
        })

    def decode(table: pa.Table) -> pa.Table:
        before, after = table["before"][0].as_py(), table["after"][0].as_py()
        return pa.Table.from_batches([_batch(list(parsed(ordered(table), before, after)))])

    hashed = rows.withColumn("h", text_hash)
    found = hashed.groupBy("conv_id", "piece").applyInArrow(scores, "conv_id bigint, piece int, m array<double>, start array<double>")
    edges = found.groupBy("conv_id").applyInArrow(borders, "conv_id bigint, piece int, before array<double>, after array<double>")
    joined = hashed.join(written(edges, "chat-borders"), ["conv_id", "piece"])
    return joined.groupBy("conv_id", "piece").applyInArrow(decode, OUT)


def format_chats(df: DataFrame, long: int = LONG) -> DataFrame:
    """conv_id, turn, part, role and rendered: the turns recovered from rows (conv_id, turn, role, text).

    A row is ordered by turn (null last; ties by role, then a hash of the text) and gives a turn for each stretch
    of lines with one role, numbered by part from 0. A null or unknown role is one to recover; a
    null or empty text gives an empty turn. A null conv_id makes a row a conversation of its own.
    Repeated rows repeat turns, an empty table gives an empty one, other columns are ignored.
    """
    rows = df.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), plain_text(F.col("role")).alias("role"), plain_text(F.col("text")).alias("text"))
    sizes = rows.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long)
    sizes = written(sizes, "chat-long")
    n_long, n_rows = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    alone = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "text"))
    short = rows
    if n_long:
        few = sizes.select("conv_id")
        few = F.broadcast(few) if n_long <= 100_000 else few
        short = rows.join(few, "conv_id", "left_anti")
    short = short.repartition(F.col("conv_id"), alone).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_last(), "role", F.xxhash64("text"), "text")
    out = short.mapInArrow(_decode, OUT)
    return out.union(_long(rows.join(few, "conv_id", "left_semi"), -(-n_rows // long))) if n_long else out


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
