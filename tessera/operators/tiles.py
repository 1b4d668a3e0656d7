"""Tile planning and stitching: closed-form tiles, core regions, last-tile-wins overlay, global renumbering."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def axis_count(length: int, tile: int, overlap: int) -> int:
    """Tiles along an axis. An overlap of a tile or more has no step."""
    if not 0 <= overlap < tile:
        raise ValueError("the overlap must be less than the tile")
    return 1 if length <= tile else -((tile - length) // (tile - overlap)) + 1


def axis_bounds(i: Column, length: int, tile: int, overlap: int) -> tuple[Column, Column]:
    """Start and end of tile i: a tile that would cross the border is moved back."""
    end = F.least(i * (tile - overlap) + tile, F.lit(length))
    return F.greatest(F.lit(0), end - tile), end


def core(start: Column, end: Column, length: int, overlap: int) -> tuple[Column, Column]:
    """The bounds without half of the overlap at sides that aren't the image's."""
    half = overlap // 2
    return F.when(start > 0, start + half).otherwise(start), F.when(end < length, end - half).otherwise(end)


def plan_tiles(spark: SparkSession, height: int, width: int, tile: tuple[int, int], overlap: int) -> DataFrame:
    """tile_id (row-major), y0, y1, x0, x1 and the core's cy0, cy1, cx0, cx1."""
    ny, nx = axis_count(height, tile[0], overlap), axis_count(width, tile[1], overlap)
    t = spark.range(ny * nx).select(F.col("id").alias("tile_id"), F.floor(F.col("id") / nx).alias("i"), (F.col("id") % nx).alias("j"))
    (y0, y1), (x0, x1) = axis_bounds(F.col("i"), height, tile[0], overlap), axis_bounds(F.col("j"), width, tile[1], overlap)
    t = t.select("tile_id", y0.alias("y0"), y1.alias("y1"), x0.alias("x0"), x1.alias("x1"))
    (a, b), (c, d) = core(F.col("y0"), F.col("y1"), height, overlap), core(F.col("x0"), F.col("x1"), width, overlap)
    return t.select("*", a.alias("cy0"), b.alias("cy1"), c.alias("cx0"), d.alias("cx1"))


def tiles_of(at: Column, length: int, tile: int, overlap: int, only_core: bool = False) -> Column:
    """The tiles along an axis that hold a coordinate, by arithmetic: no join of pixels with tiles."""
    n, step = axis_count(length, tile, overlap), tile - overlap
    low = F.greatest(F.lit(0), F.floor((at - tile) / step)).cast("long")
    high = F.least(F.lit(n - 1), F.floor(at / step) + 1).cast("long")

    def holds(i):
        a, b = axis_bounds(i, length, tile, overlap)
        if only_core:
            a, b = core(a, b, length, overlap)
        return (at >= a) & (at < b)

    return F.filter(F.sequence(F.least(low, F.lit(n - 1)), high), holds)


def on_tiles(pixels: DataFrame, height: int, width: int, tile: tuple[int, int], overlap: int, only_core: bool = False) -> DataFrame:
    """pixels with tile_id: a row for each tile (or core) that holds the pixel."""
    nx = axis_count(width, tile[1], overlap)
    i = pixels.withColumn("i", F.explode(tiles_of(F.col("y"), height, tile[0], overlap, only_core)))
    j = i.withColumn("j", F.explode(tiles_of(F.col("x"), width, tile[1], overlap, only_core)))
    return j.withColumn("tile_id", F.col("i") * nx + F.col("j")).drop("i", "j")


def renumber(labels: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """by, tile_id, label, cell_id: ids from 1 in the order of tiles, then labels, in each image; background isn't numbered.

    by: columns that tell images apart. Labels are counted by tile, offsets are running sums of those counts (a row per
    tile), so no task sees all labels.
    """
    tile = [*by, "tile_id"]
    seen = labels.where("label > 0").select(*tile, "label").distinct()
    counts = seen.groupBy(*tile).agg(F.count(F.lit(1)).alias("n"))
    image = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    before = counts.select(*tile, (F.sum("n").over(image.orderBy("tile_id")) - F.col("n")).alias("before"))
    ranked = seen.withColumn("k", F.row_number().over(Window.partitionBy(*tile).orderBy("label")))
    return ranked.join(before, tile).select(*tile, "label", (F.col("before") + F.col("k")).alias("cell_id"))


def stitch(labels: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """by, y, x, cell_id from (by, tile_id, y, x, label) of the tiles' cores: at each pixel the last tile wins, background too.

    Background is left out only after the choice; ids whose pixels were all overwritten leave gaps.
    """
    pixel = [*by, "y", "x"]
    won = labels.groupBy(*pixel).agg(F.max(F.struct("tile_id", "label")).alias("w")).select(*pixel, "w.tile_id", "w.label").where("label > 0")
    return won.join(renumber(labels, by), [*by, "tile_id", "label"]).select(*pixel, "cell_id")


def merge_seams(stitched: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """by and pairs (u, v) of different ids that touch at an edge: what a merging seam policy would unite."""
    right = stitched.select(*by, "y", (F.col("x") - 1).alias("x"), F.col("cell_id").alias("o"))
    down = stitched.select(*by, (F.col("y") - 1).alias("y"), "x", F.col("cell_id").alias("o"))
    touch = stitched.join(right.union(down), [*by, "y", "x"]).where("cell_id <> o")
    return touch.select(*by, F.least("cell_id", "o").alias("u"), F.greatest("cell_id", "o").alias("v")).distinct()


def cell_count(labels: DataFrame, as_reference: bool = False) -> DataFrame:
    """One row n: distinct ids without background; as_reference: all distinct ids less one, background or not."""
    c = labels.agg(F.count_distinct("cell_id").alias("n")) if as_reference else labels.where("cell_id > 0").agg(F.count_distinct("cell_id").alias("n"))
    return c.select((F.col("n") - 1).alias("n")) if as_reference else c


def mean_diameter(tiles: DataFrame, diameters: str) -> DataFrame:
    """One row: the mean over all values of the tiles' lists; null if there are none."""
    return tiles.select(F.explode(diameters).alias("d")).agg(F.avg("d").alias("mean_diameter"))


def runs(stitched: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Run-length rows by, y, x0, x1 (half-open), cell_id."""
    w = Window.partitionBy(*by, "y", "cell_id").orderBy("x")
    grouped = stitched.withColumn("g", F.col("x") - F.row_number().over(w))
    return grouped.groupBy(*by, "y", "cell_id", "g").agg(F.min("x").alias("x0"), (F.max("x") + 1).alias("x1")).drop("g")


def zonal(stitched: DataFrame, pixels: DataFrame, value: str, by: tuple[str, ...] = (), side: int = 256) -> DataFrame:
    """by, cell_id, mean value, area, centroid x and y, perimeter (edges to another id or none).

    Pixels are gathered in squares of side `side` with the one pixel around them that a border needs, and each square
    gives partial sums by cell in one pass with numpy; only these are added up across squares.
    """
    square = [*by, "gy", "gx"]
    put = lambda df, *cols: df.select(*by, F.floor(F.col("y") / side).alias("gy"), F.floor(F.col("x") / side).alias("gx"), "y", "x", *cols)
    inside = put(stitched.join(pixels.select(*by, "y", "x", F.col(value).cast("double").alias("v")), [*by, "y", "x"], "left"), "cell_id", "v")
    edge = lambda c, d: F.pmod(F.col(c), F.lit(side)) == (0 if d < 0 else side - 1)
    place = lambda dy, dx: F.struct((F.col("gy") + dy).alias("gy"), (F.col("gx") + dx).alias("gx"), F.lit(not (dy or dx)).alias("own"))
    places = [place(0, 0), *[F.when(edge(c, d), place(d if c == "y" else 0, d if c == "x" else 0)) for c in "yx" for d in (-1, 1)]]
    rows = inside.withColumn("s", F.explode(F.filter(F.array(*places), lambda p: p.isNotNull()))).select(*by, "s.gy", "s.gx", "y", "x", "cell_id", "v", "s.own")

    def partial(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        y0, x0 = key[-2] * side - 1, key[-1] * side - 1
        grid = np.zeros((side + 2, side + 2), dtype=np.int64)
        y, x = (pdf.y - y0).to_numpy(), (pdf.x - x0).to_numpy()
        grid[y, x] = pdf.cell_id
        own = pdf.own.to_numpy()
        pdf, y, x = pdf[own], y[own], x[own]
        other = sum((grid[y + dy, x + dx] != grid[y, x]).astype(np.int64) for dy, dx in ((0, 1), (0, -1), (1, 0), (-1, 0)))
        got = pd.DataFrame({"cell_id": pdf.cell_id, "n": 1, "vs": pdf.v.fillna(0.0), "vn": pdf.v.notna().astype("int64"), "xs": pdf.x, "ys": pdf.y, "edges": other}).groupby("cell_id", as_index=False).sum()
        for k, name in enumerate(by):
            got[name] = key[k]
        return got[[*by, "cell_id", "n", "vs", "vn", "xs", "ys", "edges"]]

    kinds = dict(stitched.dtypes)
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in by), "cell_id long, n long, vs double, vn long, xs long, ys long, edges long"])
    parts = rows.groupBy(*square).applyInPandas(partial, schema).groupBy(*by, "cell_id").agg(*[F.sum(c).alias(c) for c in ("n", "vs", "vn", "xs", "ys", "edges")])
    return parts.where("vn > 0").select(*by, "cell_id", (F.col("vs") / F.col("vn")).alias("mean"), F.col("n").alias("area"), (F.col("xs") / F.col("n")).alias("x"), (F.col("ys") / F.col("n")).alias("y"), F.col("edges").alias("perimeter"))
