"""Polygons as arrays of vertices, and points in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _closed(v: Column) -> Column:
    """Vertices with the first at the end; a ring that is closed already has an edge of length 0 more."""
    return F.concat(v, F.slice(v, 1, 1))


def area(v: Column) -> Column:
    """Shoelace area; open and closed rings give the same."""
    ring = _closed(v)
    cross = F.zip_with(ring, F.slice(ring, F.lit(2), F.size(ring)), lambda a, b: F.when(b.isNotNull(), a["x"] * b["y"] - b["x"] * a["y"]).otherwise(0.0))
    return F.abs(F.aggregate(cross, F.lit(0.0), lambda s, c: s + c)) / 2


def perimeter(v: Column) -> Column:
    ring = _closed(v)
    side = F.zip_with(ring, F.slice(ring, F.lit(2), F.size(ring)), lambda a, b: F.when(b.isNotNull(), F.sqrt(F.pow(a["x"] - b["x"], 2.0) + F.pow(a["y"] - b["y"], 2.0))).otherwise(0.0))
    return F.aggregate(side, F.lit(0.0), lambda s, c: s + c)


def bounds(v: Column) -> dict[str, Column]:
    axis = {"x": F.transform(v, lambda p: p["x"]), "y": F.transform(v, lambda p: p["y"])}
    return {f"{k}{c}": f(a) for c, a in axis.items() for k, f in (("min_", F.array_min), ("max_", F.array_max))}


def is_closed(v: Column) -> Column:
    return (F.size(v) > 1) & (F.element_at(v, 1) == F.element_at(v, -1))


def vertex_mean(v: Column, axis: str) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda s, p: s + p[axis]) / F.size(v)


def points_in_polygons(points: DataFrame, regions: DataFrame, cell: float = 512.0, by: tuple[str, ...] = ()) -> DataFrame:
    """by, cell_id, region_id: points inside, by the parity of edges that a ray to the right crosses.

    by: columns of both sides that tell images apart. Edges are laid on squares of side `cell`: on each horizontal
    stripe that an edge touches, in every column from the region's left border to the edge's right end, so a point
    meets only edges of its own square (an equality join) that its ray may cross. An edge counts for y in [low, high),
    so a vertex counts once.
    """
    ring = regions.select(*by, "region_id", _closed(F.col("vertices")).alias("r"), F.array_min(F.transform("vertices", lambda p: p["x"])).alias("left"))
    edges = ring.select(*by, "region_id", "left", F.explode(F.arrays_zip(F.slice("r", F.lit(1), F.size("r") - 1).alias("a"), F.slice("r", F.lit(2), F.size("r")).alias("b"))).alias("e"))
    e = edges.select(*by, "region_id", "left", F.col("e.a.x").alias("ax"), F.col("e.a.y").alias("ay"), F.col("e.b.x").alias("bx"), F.col("e.b.y").alias("by_")).where("ay <> by_")
    at = lambda c: F.floor(c / cell)
    e = e.withColumn("gy", F.explode(F.sequence(at(F.least("ay", "by_")), at(F.greatest("ay", "by_")))))
    e = e.withColumn("gx", F.explode(F.sequence(at(F.col("left")), at(F.greatest("ax", "bx")))))
    p = points.where("x is not null and y is not null").select(*by, "cell_id", F.col("x").cast("double").alias("px"), F.col("y").cast("double").alias("py"))
    p = p.withColumns({"gx": at(F.col("px")), "gy": at(F.col("py"))})
    crosses = ((F.col("ay") > F.col("py")) != (F.col("by_") > F.col("py"))) & (F.col("px") < (F.col("bx") - F.col("ax")) * (F.col("py") - F.col("ay")) / (F.col("by_") - F.col("ay")) + F.col("ax"))
    hit = p.join(e, [*by, "gx", "gy"]).where(crosses).groupBy(*by, "cell_id", "region_id").agg(F.count(F.lit(1)).alias("n"))
    return hit.where("n % 2 = 1").select(*by, "cell_id", "region_id")
