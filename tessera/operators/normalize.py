"""Normalisation of marker values, on the long table (cell_id, marker, raw)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import ranges


def log_norm(long: DataFrame, value: str = "raw", out: str = "norm") -> DataFrame:
    return long.withColumn(out, F.log1p(F.greatest(F.col(value), F.lit(0.0))))


def z_norm(long: DataFrame, value: str = "raw", out: str = "norm", by: str = "marker") -> DataFrame:
    """(value - mean) / population deviation by marker; 0 where it doesn't vary. One aggregate and a broadcast of a row per marker."""
    stats = long.groupBy(by).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    return long.join(F.broadcast(stats), by).withColumn(out, F.when(F.col("_s") > 0, (F.col(value) - F.col("_m")) / F.col("_s")).when(F.col(value).isNotNull(), F.lit(0.0))).drop("_m", "_s")


def clip(long: DataFrame, low: float = 0.01, high: float = 0.99, value: str = "raw", out: str = "norm", by: str = "marker") -> DataFrame:
    """Values moved into the marker's low and high percentiles."""
    bounds = long.groupBy(by).agg(F.expr(f"percentile({value}, {low})").alias("_a"), F.expr(f"percentile({value}, {high})").alias("_b"))
    return long.join(F.broadcast(bounds), by).withColumn(out, F.when(F.col(value).isNotNull(), F.least(F.greatest(F.col(value), F.col("_a")), F.col("_b")))).drop("_a", "_b")


def ranks(long: DataFrame, value: str, key: str, by: str, name: str = "_r") -> DataFrame:
    """Rows with their rank from 1 by value, then key, within `by`.

    Rows are dealt into ranges of (by, value, key); each range is numbered by itself and its offset within `by` is a
    running sum over the ranges' counts (a row per range and `by`), so no task holds all rows of one `by`. Nulls are last.
    """
    ranged = ranges(long, [by, value, key], "_p")
    counts = ranged.groupBy(F.col(by).alias("_by"), F.col("_p").alias("_q")).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_by", "_q", (F.sum("_n").over(Window.partitionBy("_by").orderBy("_q")) - F.col("_n")).alias("_before"))
    numbered = ranged.withColumn("_k", F.row_number().over(Window.partitionBy("_p", by).orderBy(F.col(value).asc_nulls_last(), F.col(key).asc_nulls_last())))
    placed = numbered.join(F.broadcast(before), (F.col("_p") == F.col("_q")) & F.col(by).eqNullSafe(F.col("_by")))
    return placed.withColumn(name, F.col("_before") + F.col("_k")).drop("_p", "_k", "_by", "_q", "_before")


def quantile_norm(long: DataFrame, value: str = "raw", out: str = "norm", by: str = "marker", key: str = "cell_id") -> DataFrame:
    """Each value becomes the mean over markers of the values of its rank; equal values are ranked by cell."""
    same = Window.partitionBy("_r")  # a row per marker
    return ranks(long, value, key, by).withColumn(out, F.avg(value).over(same)).drop("_r")


def balance_tiles(pixels: DataFrame, tile: str, value: str, out: str = "balanced") -> DataFrame:
    """Values times global mean by tile mean; unchanged where the tile's mean is 0."""
    by = pixels.groupBy(tile).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    total = by.agg((F.sum("_s") / F.sum("_n")).alias("m")).select("m").scalar()
    return pixels.join(by, tile).withColumn(out, F.when(F.col("_s") != 0, F.col(value) * total / (F.col("_s") / F.col("_n"))).otherwise(F.col(value))).drop("_s", "_n")
