"""Joins, reshaping, aggregates and order-dependent operators over cell tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Columns that are no markers.
META = ("cell_id", "x", "y", "area", "perimeter", "cluster", "cluster_size", "refined", "neighbors", "local_density", "dim1", "dim2")
#: Ranges for each shuffle partition, and the rows that their bounds are taken from.
RANGES, BOUND_ROWS = 4, 20_000


def marker_columns(df: DataFrame) -> list[str]:
    """Numeric columns that aren't metadata."""
    numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [c for c, t in df.dtypes if c not in META and (t in numeric or t.startswith("decimal"))]


def mean_by_type(df: DataFrame, type_col: str, markers: list[str] | None = None) -> DataFrame:
    """Mean of each marker by type; null types are dropped, nulls and NaN skipped."""
    cols = markers or marker_columns(df)
    kind = dict(df.dtypes)
    value = lambda c: F.nanvl(c, F.lit(None)) if kind[c] in ("double", "float") else F.col(c)
    return df.where(F.col(type_col).isNotNull()).groupBy(type_col).agg(*[F.avg(value(c)).alias(c) for c in cols])


def transposed_means(df: DataFrame, type_col: str, types: list, markers: list[str]) -> DataFrame:
    """marker and one column per type with the marker's mean."""
    long = measurements(df, markers, (type_col,))
    return long.groupBy("marker").pivot(type_col, types).agg(F.avg("raw"))


def measurements(df: DataFrame, markers: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """The long table: cell_id, keep, marker, raw."""
    return df.select("cell_id", *keep, *[F.col(m).cast("double").alias(m) for m in markers]).unpivot(["cell_id", *keep], markers, "marker", "raw")


def ranges(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """Rows with the number of their range, from 0, of ranges of about equal size in the given order, nulls last as in SQL.

    Bounds are taken from some 20,000 rows that are picked by their hash, so a row's range follows from the values alone
    and is the same wherever the plan computes it. Partitions of repartitionByRange aren't: where two branches of a plan
    don't share the exchange, each has its own sample, other bounds and other partitions joined into one.
    """
    n = RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(*[f for k, c in enumerate(order) for f in (F.col(c).isNull().alias(f"n{k}"), F.col(c).alias(f"v{k}"))])
    every = F.greatest(F.floor(df.agg((F.count(F.lit(1)) / BOUND_ROWS).alias("n")).scalar()), F.lit(1).cast("long"))
    picked = df.select(place.alias("k")).where(F.pmod(F.xxhash64("k"), every) == 0).distinct().agg(F.sort_array(F.collect_list("k")).alias("k"))
    bounds = picked.select(F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda i: F.get("k", F.floor(i * F.size("k") / n).cast("int"))).alias("b")).scalar()
    out = df.withColumns({"_place": place, name: F.lit(0)})
    for step in (1 << k for k in reversed(range(n.bit_length()))):  # the number of bounds up to a row's place, by halves; beyond the array's end get gives null
        out = out.withColumn(name, F.col(name) + F.when(F.get(bounds, F.col(name) + (step - 1)) <= F.col("_place"), step).otherwise(0))
    return out.drop("_place")


def with_row_index(df: DataFrame, order: list[str], name: str = "row_idx") -> DataFrame:
    """Number rows from 0 in a total order, nulls last, without one task holding all: ranges are counted, then numbered from offsets."""
    ranged = ranges(df, order, "_p")
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))  # a row per range
    numbered = ranged.withColumn("_k", F.row_number().over(Window.partitionBy("_p").orderBy(*[F.col(c).asc_nulls_last() for c in order])))
    return numbered.join(F.broadcast(offsets), "_p").withColumn(name, F.col("_before") + F.col("_k") - 1).drop("_p", "_k", "_before")


def positional_join(a: DataFrame, b: DataFrame, order_a: list[str], order_b: list[str]) -> DataFrame:
    """Match rows by their place in an explicit order, down to the shorter input; other clashing names get _x and _y."""
    both = {c for c in a.columns if c in b.columns}
    a = with_row_index(a, order_a).withColumnsRenamed({c: f"{c}_x" for c in both})
    b = with_row_index(b, order_b).withColumnsRenamed({c: f"{c}_y" for c in both})
    return a.join(b, "row_idx")


def missing(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    return expected.join(found.select(key).distinct(), key, "left_anti")


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Every row with its cluster's size; sizes are summed first and joined, so a large cluster is no one task."""
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("cluster_size"))
    return df.alias("d").join(sizes.alias("s"), F.col(f"d.{cluster}").eqNullSafe(F.col(f"s.{cluster}"))).select("d.*", "cluster_size")


def proportions(df: DataFrame, type_col: str) -> DataFrame:
    n = df.groupBy(type_col).agg(F.count(F.lit(1)).alias("cells"))
    total = n.agg(F.sum("cells").alias("t")).select("t").scalar()
    return n.withColumn("share", F.col("cells") / total)


def summary(long: DataFrame, by: str = "marker", value: str = "raw") -> DataFrame:
    return long.groupBy(by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("sd"), F.min(value).alias("least"), F.max(value).alias("most"), F.expr(f"percentile({value}, 0.5)").alias("median")
    )


def first_appearance(df: DataFrame, category: str, order: str) -> DataFrame:
    """category, colour_idx: categories in the order in which they first come, from 0; a row per category."""
    seen = df.where(F.col(category).isNotNull()).groupBy(category).agg(F.min(order).alias("first"))
    return seen.select(category, (F.row_number().over(Window.orderBy("first")) - 1).alias("colour_idx"))


def progress(tiles: DataFrame, order: str, seconds: str, run: Column | str | None = None) -> DataFrame:
    """done, mean_s, remaining_s, rate_per_min after each tile of a run, in order: the mean of all so far times what is left."""
    w = Window.partitionBy(run) if run is not None else Window.partitionBy(F.lit(1))
    upto = w.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    mean, done, n = F.avg(seconds).over(upto), F.count(F.lit(1)).over(upto), F.count(F.lit(1)).over(w)
    return tiles.select("*", done.alias("done"), mean.alias("mean_s"), (mean * (n - done)).alias("remaining_s"), F.when(mean > 0, 60 / mean).alias("rate_per_min"))


def category_union(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(F.col(a).alias("category")).union(df.select(b)).distinct()


def quality_control(df: DataFrame, value: str, least: float, most: float) -> DataFrame:
    """One row: rows, nulls, below, above and kept (bounds included)."""
    v = F.col(value)
    flag = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("n"), flag(v.isNull()).alias("nulls"), flag(v < least).alias("below"), flag(v > most).alias("above"), flag((v >= least) & (v <= most)).alias("kept"))


def custom_filter(df: DataFrame, predicate: Column | str | None = None) -> DataFrame:
    return df if predicate is None else df.where(predicate)


def present(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted columns that df has, in the order wanted: a plot or a join goes on without those that are absent."""
    return [c for c in wanted if c in df.columns]


def guarded(df: DataFrame, required: list[str], optional: list[str]) -> DataFrame:
    """required columns and those optional ones that df has; a missing required one is an error that names it."""
    if lost := [c for c in required if c not in df.columns]:
        raise ValueError(f"columns {lost} are missing")
    return df.select(*required, *present(df, [c for c in optional if c not in required]))


def filtered_sum(df: DataFrame, value: str, predicate: Column | str, by: tuple[str, ...] = ()) -> DataFrame:
    """by, total: the sum of the rows that the predicate holds for, 0 where it holds for none."""
    keep = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.groupBy(*by).agg(F.coalesce(F.sum(F.when(keep, F.col(value))), F.sum(F.lit(0))).alias("total"))


def throttled(steps: DataFrame, order: str, seconds: str, run: str, every: int = 5, least_s: float = 30.0) -> DataFrame:
    """The steps that a progress line is written for: each `every`-th of a run, and one that ends a further least_s seconds."""
    upto = Window.partitionBy(run).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    counted = steps.withColumns({"_k": F.count(F.lit(1)).over(upto), "_t": F.sum(seconds).over(upto)})
    spans = F.floor(F.col("_t") / least_s) > F.floor((F.col("_t") - F.col(seconds)) / least_s)
    return counted.where((F.col("_k") % every == 0) | spans).drop("_k", "_t")


def ordered_means(df: DataFrame, type_col: str, markers: list[str]) -> DataFrame:
    """mean_by_type with its rows in the order of the types, as a group-by of data frames gives them."""
    return mean_by_type(df, type_col, markers).orderBy(type_col)


def export_table(cells: DataFrame, clusters: DataFrame, spatial: DataFrame, interactions: DataFrame, type_col: str = "cluster") -> DataFrame:
    """One row per cell: its measurements, cluster and spatial figures by cell_id, and its type's strongest interaction by type.

    Left joins, so a cell without a cluster or neighbours stays. interactions: cell_type_1, cell_type_2, interaction_score.
    """
    both = interactions.select(F.explode(F.array("cell_type_1", "cell_type_2")).alias(type_col), "interaction_score")
    best = both.groupBy(type_col).agg(F.max("interaction_score").alias("top_interaction"))
    return cells.join(clusters, "cell_id", "left").join(spatial, "cell_id", "left").join(best, type_col, "left")
