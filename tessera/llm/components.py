"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, written


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the least of the node and its neighbours."""
    near = _both(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node, component (its least node) for every node of edges (u, v), long.

    Each round is written to the shared folder (and the one before deleted), and only a count and a sum of hashes come to
    the driver. Loops are ignored; an empty table gives no rows. Rounds grow with the logarithm of the longest path.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003), F.sum(F.xxhash64("v", "u") % 998_244_353)).first())
    before = state(now)
    for _ in range(most_rounds):
        if not before[0]:
            break
        last, now = now, written(small_star(large_star(now)), "edges")
        forget(last)
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no end after {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
