"""Exact top-k inner products by columnar branch and bound.

Vectors lie in vertical layout, dimension by dimension, those with most mass first. For a block of
queries, products are accumulated one block of dimensions after another; after each block a
candidate survives only if what it has, plus the largest value that the remaining dimensions can
add (the product of both sides' remaining masses, by Cauchy and Schwarz), can still reach the k-th
best score so far. Survivors are compacted before the next block.

Queries and candidates are dealt out in a grid: every block of queries meets every block of
candidates in one cell, each cell returns k rows for a query at most, and these are ranked once
more. The first block of candidates goes first; its k-th best scores are where the other cells
start from. A cell's components are bounded, so memory is, too.

Products are accumulated in doubles. They are exact while both norms' product is below 2^52; for
larger vectors bounds allow for rounding and survivors are computed once more in whole numbers.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import written

#: Products of norms below this make exact scores in doubles.
EXACT = float(1 << 52)
#: Rows of a block of queries or candidates at most, and components of one, about.
QUERY_ROWS, CANDIDATE_ROWS, COMPONENTS = 8192, 8192, 4 << 20
DIMS, STRIP = 16, 512
#: The range of a long.
LOW, HIGH = -(1 << 63), (1 << 63) - 1
_BIG = 1.7e308


def exact_scores(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Inner products of rows of whole numbers held as doubles, the nearest long if beyond its range."""
    return [min(HIGH, max(LOW, sum(int(x) * int(y) for x, y in zip(u, v)))) for u, v in zip(a.tolist(), b.tolist())]


def search_block(
    queries: np.ndarray, query_rows: np.ndarray, rows: np.ndarray, ids: np.ndarray, numbers: np.ndarray, k: int, floor: np.ndarray | None = None, told: Counter | None = None
) -> tuple[list[int], list[int], list[int]]:
    """(query, id, score) of the k best candidates of each query, ties to the smaller id.

    queries and rows hold whole numbers as doubles, rows sorted by ids; numbers name the rows, and
    a candidate with its query's own number (query_rows) is none. floor: scores that the k-th best
    of other candidates is known to reach. told counts pairs and those left after each block.
    """
    n, dims = rows.shape
    with np.errstate(all="ignore"):
        order = np.argsort(-np.square(rows).sum(0), kind="stable")
        queries, rows = queries[:, order], rows[:, order]
        vertical, cuts = np.ascontiguousarray(rows.T), [*range(0, dims, DIMS), dims]
        rest = lambda x, d: np.sqrt(np.square(x[:, d:]).sum(1))
        q_mass, c_mass = [rest(queries, d) for d in cuts], [rest(rows, d) for d in cuts]
        # Scores are whole numbers, and later candidates have larger ids: they must exceed what this block has.
        least = np.full(len(queries), -np.inf) if floor is None else floor - 0.5
        best: list[list[tuple[int, int]]] = [[] for _ in queries]  # (-score, id), sorted
        # What rounding can add up to, as a part of both norms' product; nothing if sums are exact.
        slack = 0.0 if q_mass[0].max(initial=0.0) * c_mass[0].max(initial=0.0) < EXACT else (dims + 4) * 2.0**-51

        def room(q, c, j):
            """What a pair can gain at most from dimension block j on."""
            return q_mass[j][q] * c_mass[j][c] * (1 + 1e-9) + slack * q_mass[0][q] * c_mass[0][c]

        for low in range(0, n, STRIP):
            high = min(n, low + STRIP)
            score = queries[:, : cuts[1]] @ vertical[: cuts[1], low:high]
            limit = score + room(np.s_[:, None], np.s_[None, low:high], 1)
            q, c = np.nonzero(~(limit < least[:, None]))  # NaN (beyond doubles) stays
            full = len(q) > 0.2 * score.size
            if told is not None:
                told.update({"pairs": score.size, "block 1": len(q)})
            score = score[q, c]
            for j in range(1, len(cuts) - 1):
                if not len(q):
                    break
                a, b = cuts[j], cuts[j + 1]
                if full:
                    score = score + (queries[:, a:b] @ vertical[a:b, low:high])[q, c]
                else:
                    for i in range(0, len(q), 1 << 16):
                        s = slice(i, i + (1 << 16))
                        score[s] += np.einsum("ij,ij->i", queries[q[s], a:b], rows[c[s] + low, a:b])
                keep = ~(score + room(q, c + low, j + 1) < least[q])
                q, c, score = q[keep], c[keep], score[keep]
                full = full and len(q) > 0.2 * len(queries) * (high - low)
                if told is not None:
                    told[f"block {j + 1}"] += len(q)
            keep = numbers[c + low] != query_rows[q]
            q, c, score = q[keep], c[keep], score[keep]
            start = np.searchsorted(q, np.arange(len(queries) + 1))
            for i in np.unique(q).tolist():
                mine = slice(start[i], start[i + 1])
                at, value = c[mine] + low, score[mine]
                if len(at) > k and not slack:
                    keep = np.argsort(-value, kind="stable")[:k]
                    at, value = at[keep], value[keep]
                elif len(at) > k:  # what k others of this strip surely exceed goes
                    err = slack * q_mass[0][i] * c_mass[0][at]
                    sure = np.nan_to_num(value - err, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                    keep = ~(value + err < np.partition(sure, len(at) - k)[len(at) - k])
                    at, value = at[keep], value[keep]
                whole = exact_scores(queries[[i] * len(at)], rows[at]) if slack else value.astype(np.int64).tolist()
                best[i] = sorted([*best[i], *zip([-x for x in whole], ids[at].tolist())])[:k]
                if len(best[i]) == k:
                    worst = float(-best[i][-1][0])
                    least[i] = max(least[i], worst - abs(worst) * 2.0**-52 + 0.5)
    return [i for i, x in enumerate(best) for _ in x], [i for x in best for _, i in x], [-s for x in best for s, _ in x]


def scaled(df: DataFrame, scale: int) -> DataFrame:
    """vec_id and v: floor(scale * x) of each component as doubles, for vectors that take part.

    Those that are null, or hold a null, NaN or infinite component, take no part, nor do rows with
    a null vec_id. A component beyond a double's range once scaled is the largest double.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = df.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("e"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & F.forall("e", finite))
    times = lambda x: F.greatest(F.lit(-_BIG), F.least(F.lit(_BIG), x * scale))
    whole = lambda y: F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)
    return rows.select(F.col("vec_id").cast("bigint"), F.transform("e", lambda x: whole(times(x))).alias("v"))


def top_k(df: DataFrame, k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id and score: the k best rows for each row whose vec_id is divisible by every.

    Scores are inner products of floor(scale * x), the nearest long if beyond its range. A query's
    candidates are all rows but itself with as many components (fewer than k: all); ties go to the
    smaller vec_id. Repeated rows, and rows that share a vec_id, are candidates and queries of
    their own, so a vec_id that k rows share has k times as many results. Vectors without
    components match nothing. An empty table gives an empty one; other columns are ignored.
    """
    spark = df.sparkSession
    rows = written(scaled(df, scale).withColumn("number", F.monotonically_increasing_id()), "topk-rows")
    n_rows, n_asked, dims = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0), F.coalesce(F.max(F.size("v")), F.lit(1))).first()
    most = lambda limit: max(1, min(limit, COMPONENTS // max(1, dims)))
    q_blocks, c_blocks = max(1, -(-n_asked // most(QUERY_ROWS))), max(1, -(-n_rows // most(CANDIDATE_ROWS)))
    block = lambda n, seed: F.pmod(F.xxhash64("number", F.lit(seed)), F.lit(n)).cast("int")
    asked = rows.where(F.col("vec_id") % every == 0).withColumn("qb", block(q_blocks, 0))
    given = rows.withColumn("cb", block(c_blocks, 1))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def cell(table: pa.Table) -> pa.Table:
        query = table["query"].to_numpy()
        length = pa.compute.list_value_length(table["v"]).to_numpy()
        ids, numbers, start = (table[c].to_numpy() for c in ("vec_id", "number", "floor"))
        found: list[list] = [[], [], [], []]
        for size in np.unique(length[query]).tolist():
            own = length == size
            q_at, c_at = np.flatnonzero(own & query), np.flatnonzero(own & ~query)
            c_at = c_at[np.argsort(ids[c_at], kind="stable")]
            if not size or not len(c_at):
                continue
            matrix = lambda at: np.asarray(table["v"].take(pa.array(at)).combine_chunks().flatten()).reshape(-1, size)  # noqa: B023, E731
            q, c, score = search_block(matrix(q_at), numbers[q_at], matrix(c_at), ids[c_at], numbers[c_at], k, start[q_at])
            q = q_at[np.array(q, np.int64)]
            for out, new in zip(found, (numbers[q].tolist(), ids[q].tolist(), c, score)):
                out += new
        return pa.table({name: pa.array(x, pa.int64()) for name, x in zip(("number", "query_id", "vec_id", "score"), found)})

    def searched(left: DataFrame, right: DataFrame) -> DataFrame:
        """The cells of queries (with floor, qb and cb) and candidates (with qb and cb)."""
        columns = ("qb", "cb", "query", "vec_id", "number", "floor", "v")
        left = left.withColumn("query", F.lit(True)).select(*columns)
        right = right.withColumns({"query": F.lit(False), "floor": F.lit(float("-inf"))}).select(*columns)
        cells = left.union(right).repartition(parts, "qb", "cb").groupBy("qb", "cb")
        return cells.applyInArrow(cell, "number bigint, query_id bigint, vec_id bigint, score bigint")

    def ranked(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("number").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    all_of = lambda low, n: F.explode(F.sequence(F.lit(low), F.lit(n - 1)))
    first = searched(asked.withColumns({"floor": F.lit(float("-inf")), "cb": F.lit(0)}), given.where("cb = 0").withColumn("qb", all_of(0, q_blocks)))
    if c_blocks > 1:
        first = written(ranked(first), "topk-first")
        floors = first.where(F.col("rank") == k).select("number", F.col("score").cast("double").alias("floor"))
        started = asked.join(floors, "number", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf")))).withColumn("cb", all_of(1, c_blocks))
        first = first.drop("rank").unionByName(searched(started, given.where("cb > 0").withColumn("qb", all_of(0, q_blocks))))
    return ranked(first).select("query_id", "rank", "vec_id", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS number, CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.number, q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.number <> c.number WHERE q.vec_id % 20 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY number ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT * FROM r WHERE rank <= 20
"""
