"""Radius joins on a grid, interaction scores, neighbourhoods, nearest neighbours and spatial statistics."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import squared_distance


def radius_pairs(cells: DataFrame, radius: float, keep: tuple[str, ...] = (), by: tuple[str, ...] = ()) -> DataFrame:
    """by, a, b, d2 (and keep as <column>_a, <column>_b): each unordered pair of cells within radius, the bound included.

    by: columns that tell images apart, such as image_id; cells of different images never meet, whatever their places.

    The plane is cut in squares of side radius. One side stands in its own square, the other in that square and the
    four that come after it, so each pair of squares meets once and the join is an equality. Cells without a
    coordinate are in no pair.
    """
    side = cells.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(*by, "cell_id", "x", "y", *keep, F.floor(F.col("x") / radius).cast("long").alias("gx"), F.floor(F.col("y") / radius).cast("long").alias("gy"))
    here = side.select(*by, *[F.col(c).alias(f"{c}_a") for c in ("cell_id", "x", "y", *keep)], "gx", "gy")
    steps = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((0, 0), (1, -1), (1, 0), (1, 1), (0, 1))])
    there = side.select(*by, *[F.col(c).alias(f"{c}_b") for c in ("cell_id", "x", "y", *keep)], "gx", "gy", F.explode(steps).alias("s"))
    there = there.select(*[c for c in there.columns if c not in ("gx", "gy", "s")], (F.col("gx") - F.col("s.dx")).alias("gx"), (F.col("gy") - F.col("s.dy")).alias("gy"), ((F.col("s.dx") == 0) & (F.col("s.dy") == 0)).alias("own"))
    d2 = squared_distance(F.col("x_a"), F.col("y_a"), F.col("x_b"), F.col("y_b"))
    met = here.join(there, [*by, "gx", "gy"]).where(~F.col("own") | (F.col("cell_id_a") < F.col("cell_id_b"))).withColumn("d2", d2).where(F.col("d2") <= radius * radius)
    flip = F.col("cell_id_a") > F.col("cell_id_b")
    cols = [F.when(flip, F.col(f"{c}_b")).otherwise(F.col(f"{c}_a")).alias(a) for c, a in (("cell_id", "a"), *[(k, f"{k}_a") for k in keep])]
    cols += [F.when(flip, F.col(f"{c}_a")).otherwise(F.col(f"{c}_b")).alias(b) for c, b in (("cell_id", "b"), *[(k, f"{k}_b") for k in keep])]
    return met.select(*by, *cols, "d2")


def interaction_scores(cells: DataFrame, radius: float, type_col: str = "cluster", by: tuple[str, ...] = ()) -> DataFrame:
    """by, cell_type_1 <= cell_type_2, pairs, interaction_score = pairs * N / (n1 * n2) within an image, for types that meet."""
    typed = cells.where(F.col(type_col).isNotNull())
    counts = typed.groupBy(*by, type_col).agg(F.count(F.lit(1)).alias("n"))
    met = radius_pairs(typed, radius, (type_col,), by)
    pairs = met.groupBy(*by, F.least(f"{type_col}_a", f"{type_col}_b").alias("cell_type_1"), F.greatest(f"{type_col}_a", f"{type_col}_b").alias("cell_type_2")).agg(F.count(F.lit(1)).alias("pairs"))
    one = counts.select(*by, F.col(type_col).alias("cell_type_1"), F.col("n").alias("n1"))
    two = counts.select(*by, F.col(type_col).alias("cell_type_2"), F.col("n").alias("n2"))
    out = pairs.join(one, [*by, "cell_type_1"]).join(two, [*by, "cell_type_2"])
    if by:
        out, total = out.join(counts.groupBy(*by).agg(F.sum("n").alias("total")), list(by)), F.col("total")
    else:
        total = counts.agg(F.sum("n").alias("n")).select("n").scalar()
    score = F.round(F.col("pairs") * total / (F.col("n1") * F.col("n2")), 6)
    return out.select(*by, "cell_type_1", "cell_type_2", "pairs", score.alias("interaction_score"))


def neighbours(cells: DataFrame, radius: float, keep: tuple[str, ...] = (), by: tuple[str, ...] = ()) -> DataFrame:
    """by, cell_id, other, d2 (and the other's keep): both directions of radius_pairs, from one join."""
    p = radius_pairs(cells, radius, keep, by)
    side = lambda a, b: F.struct(F.col(a).alias("cell_id"), F.col(b).alias("other"), "d2", *[F.col(f"{k}_{b}").alias(k) for k in keep])
    return p.select(*by, F.explode(F.array(side("a", "b"), side("b", "a"))).alias("s")).select(*by, "s.*")


def local_density(cells: DataFrame, radius: float, by: tuple[str, ...] = ()) -> DataFrame:
    """by, cell_id, neighbors (others within radius), local_density (neighbors by area of the circle); 0 without neighbours."""
    key = [*by, "cell_id"]
    n = neighbours(cells, radius, (), by).groupBy(*key).agg(F.count(F.lit(1)).alias("neighbors"))
    out = cells.select(*key).join(n, key, "left").select(*key, F.coalesce("neighbors", F.lit(0).cast("long")).alias("neighbors"))
    return out.withColumn("local_density", F.col("neighbors") / F.lit(math.pi * radius * radius))


def composition(cells: DataFrame, radius: float, types: list, type_col: str = "cluster", by: tuple[str, ...] = ()) -> DataFrame:
    """by, cell_id, total and a share type_<t> of each type among the neighbours; cells without neighbours have none."""
    n = neighbours(cells, radius, (type_col,), by).groupBy(*by, "cell_id").pivot(type_col, types).agg(F.count(F.lit(1)))
    counts = {t: F.coalesce(F.col(f"`{t}`"), F.lit(0)) for t in types}
    total = sum(counts.values(), F.lit(0).cast("long"))
    return n.select(*by, "cell_id", total.alias("total"), *[(c / total).alias(f"type_{t}") for t, c in counts.items()])


def spatial_stats(cells: DataFrame, radii: tuple[float, ...], type_col: str = "cluster", by: tuple[str, ...] = ()) -> DataFrame:
    """by, and by type: cells, mean and least nearest-neighbour distance within the largest radius, pairs of the type by radius.

    One radius join gives both: each cell's nearest neighbour and its neighbours of its own type, which are half a pair.
    """
    top, key = max(radii), [*by, "cell_id"]
    same = F.col("own") == F.col(type_col)
    met = neighbours(cells, top, (type_col,), by).join(cells.select(*key, F.col(type_col).alias("own")), key)
    near = met.groupBy(*key).agg(F.min("d2").alias("d2"), *[F.count(F.when(same & (F.col("d2") <= r * r), 1)).alias(f"n_{r:g}") for r in radii])
    halves = [(F.coalesce(F.sum(f"n_{r:g}"), F.lit(0)) / 2).cast("long").alias(f"pairs_{r:g}") for r in radii]
    return cells.join(near, key, "left").groupBy(*by, type_col).agg(F.count(F.lit(1)).alias("cells"), F.avg(F.sqrt("d2")).alias("mean_nn"), F.min(F.sqrt("d2")).alias("min_nn"), *halves)


def symmetric_scores(rows: DataFrame) -> DataFrame:
    """cell_type_1 <= cell_type_2, interaction_score: of each unordered pair the last row (by row_idx) in either direction."""
    a, b = F.least("cell_type_1", "cell_type_2"), F.greatest("cell_type_1", "cell_type_2")
    both = rows.where(F.col("cell_type_1").isNotNull() & F.col("cell_type_2").isNotNull())
    return both.groupBy(a.alias("cell_type_1"), b.alias("cell_type_2")).agg(F.max_by("interaction_score", "row_idx").alias("interaction_score"))


def interaction_matrix(scores: DataFrame, types: list) -> DataFrame:
    """A square symmetric matrix, one row per type in the order given, missing pairs 0. types bounds its size."""
    mirrored = scores.select(F.col("cell_type_1").alias("cell_type"), F.col("cell_type_2").alias("other"), "interaction_score")
    mirrored = mirrored.union(scores.where("cell_type_1 <> cell_type_2").select("cell_type_2", "cell_type_1", "interaction_score"))
    every = scores.sparkSession.createDataFrame([(t,) for t in types], scores.select(F.col("cell_type_1").alias("cell_type")).schema)
    wide = mirrored.groupBy("cell_type").pivot("other", types).agg(F.first("interaction_score"))
    return every.join(wide, "cell_type", "left").na.fill(0, [str(t) for t in types])


def nearest(cells: DataFrame, columns: list[str], k: int, block: int = 2000, only: DataFrame | None = None) -> DataFrame:
    """cell_id, other, rank, d2: the k nearest others by Euclidean distance over columns; ties by id. only: cell_ids to ask for.

    Exact: cells are dealt into blocks by hash and each pair of blocks is compared by one task with numpy, which gives
    each cell's k best of that block; the best of these are kept. Work is the square of the cells, memory is one pair of
    blocks.
    """
    n = max(1, math.ceil(cells.count() / block))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    vec = cells.select("cell_id", F.array(*[F.col(c).cast("double") for c in columns]).alias("v"), F.pmod(F.xxhash64("cell_id"), F.lit(n)).alias("blk"))
    asked = vec if only is None else vec.join(only.select("cell_id").distinct(), "cell_id", "left_semi")
    asks = asked.select("cell_id", "v", F.col("blk").alias("i"), every.alias("j"), F.lit(True).alias("asks"))
    gives = vec.select("cell_id", "v", every.alias("i"), F.col("blk").alias("j"), F.lit(False).alias("asks"))

    def best(pdf: pd.DataFrame) -> pd.DataFrame:
        q, o = pdf[pdf.asks], pdf[~pdf.asks].sort_values("cell_id")
        if q.empty or o.empty:
            return pd.DataFrame({"cell_id": [], "other": [], "d2": []})
        a, b, ids, cells = np.stack(q.v.to_numpy()), np.stack(o.v.to_numpy()), o.cell_id.to_numpy(), q.cell_id.to_numpy()
        out, squares = [], (b * b).sum(axis=1)
        for at in range(0, len(a), 256):  # rough distances by a matrix product choose a few more than k, exact ones rank them
            part, own = a[at : at + 256], cells[at : at + 256]
            rough = squares[None, :] - 2 * part @ b.T
            rough[own[:, None] == ids[None, :]] = np.inf
            most = min(k, len(b)) - 1
            slack = 1e-9 * (squares.max() + (part * part).sum(axis=1).max() + 1)
            limit = np.partition(rough, most, axis=1)[:, most] + slack
            rows, cols = np.nonzero((rough <= limit[:, None]) & np.isfinite(rough))
            exact = ((part[rows] - b[cols]) ** 2).sum(axis=1)
            order = np.lexsort((ids[cols], exact, rows))
            rows, cols, exact = rows[order], cols[order], exact[order]
            place = np.arange(len(rows)) - np.searchsorted(rows, rows)
            top = place < k
            out.append(pd.DataFrame({"cell_id": own[rows[top]], "other": ids[cols[top]], "d2": exact[top]}))
        return pd.concat(out)

    found = asks.union(gives).groupBy("i", "j").applyInPandas(best, "cell_id long, other long, d2 double")
    w = Window.partitionBy("cell_id").orderBy("d2", "other")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("cell_id", "other", "rank", "d2")
