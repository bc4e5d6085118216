"""Connected components of a graph by alternating stars, every round a table in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import counted, forget, join_unique, observed, written


def _least(edges: DataFrame) -> DataFrame:
    """For each u its least neighbour or itself (m), and n, the number of its edges."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))


def _round(edges: DataFrame) -> tuple[DataFrame, dict]:
    """Edges (u > v) made distinct and written; their number and what tells them from other edges."""
    return observed(edges.distinct(), "star", F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("mark"))


def components(edges: DataFrame) -> DataFrame:
    """node, root: the smallest node of its component, for each node of edges (u, v; bigint, not null).

    Large-star and small-star rounds until nothing changes; the number of rounds grows with the
    logarithm of the graph's size, and a round's tables go once the next one's are written. Nothing but counts and marks reaches the driver. Repeated edges
    and loops don't matter; no edges give an empty table.
    """
    edges, now = _round(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    while now["n"]:
        # Large star: neighbours above u are tied to u's least neighbour.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(_least(both), "star-least")
        large = join_unique(both, least, ["u"], 2 * now["n"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, n_large = counted(large.where("u <> v"), "star-large")
        # Small star: u and its neighbours below are tied to the least of them.
        fewer = written(_least(large), "star-least")
        small = join_unique(large, fewer, ["u"], n_large)
        ties = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
        done, before = edges, now
        edges, now = _round(ties.select("e.u", "e.v").where("u <> v"))
        forget(done, least, large, fewer)
        if now == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
