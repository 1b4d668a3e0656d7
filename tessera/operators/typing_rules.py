"""Rule-based cell typing: marker levels by quantiles, rules as conditions on levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schema import RULES


def marker_levels(long: DataFrame, low: float = 1 / 3, high: float = 2 / 3) -> DataFrame:
    """cell_id, marker, level: high from the upper quantile on, low up to the lower one, else medium."""
    q = long.groupBy("marker").agg(F.expr(f"percentile(raw, {low!r}D)").alias("p_low"), F.expr(f"percentile(raw, {high!r}D)").alias("p_high"))
    level = F.when(F.col("raw") >= F.col("p_high"), "high").when(F.col("raw") <= F.col("p_low"), "low").otherwise("medium")
    return long.where(F.col("raw").isNotNull()).join(F.broadcast(q), "marker").select("cell_id", "marker", level.alias("level"))


def conditions(rules: list[tuple] | None = None, measured: list[str] | None = None) -> list[tuple]:
    """(rule, ref_id, group, type, subtype, rank filter, least confidence, [(marker, level)], evaluable) of each rule."""
    return [(*r, measured is None or all(m in measured for m, _ in r[7])) for r in (RULES if rules is None else rules)]


def assign_types(levels: DataFrame, rules: list[tuple] | None = None, measured: list[str] | None = None) -> DataFrame:
    """cell_id, ref_id, rule, cell_type (subtype), confidence: by layer (ref_id) the most confident rule that applies.

    Confidence is 100 * satisfied / conditions. A rule applies if its confidence reaches the rule's own least, all its
    markers are measured and, with the rank filter positive_only, its first marker is high; of equal confidence the
    first rule wins; else 'unassigned', rule 0. Rules are few and part of the plan: the levels of a cell are gathered
    once and no cell meets a rule in a join.
    """
    rs = [r for r in conditions(rules, measured) if r[-1]]
    layers = sorted({r[1] for r in conditions(rules, measured)})
    wanted = sorted({m for r in rs for m, _ in r[7]})
    wide = levels.where(F.col("marker").isin(wanted)).groupBy("cell_id").agg(*[F.max(F.when(F.col("marker") == m, F.col("level"))).alias(f"m_{m}") for m in wanted])
    cells = levels.select("cell_id").distinct().join(wide, "cell_id", "left")
    out = []
    for layer in layers:
        scored = []
        for row, ref, _, _, sub, rank, least, pairs, _ in rs:
            if ref == layer:
                met = sum((F.when(F.col(f"m_{m}") == level, 1).otherwise(0) for m, level in pairs), F.lit(0))
                confidence = F.round(100.0 * met / len(pairs), 6)
                positive = F.col(f"m_{pairs[0][0]}") == "high" if rank == "positive_only" else F.lit(True)
                scored.append(F.when(positive & (confidence >= least), F.struct(confidence.alias("confidence"), F.lit(-row).alias("order"), F.lit(sub).alias("sub"))))
        best = F.array_max(F.array(*scored)) if scored else F.lit(None).cast("struct<confidence:double,order:int,sub:string>")
        out.append(F.struct(F.lit(layer).alias("ref_id"), best.alias("best")))
    rows = cells.select("cell_id", F.explode(F.array(*out)).alias("o"))
    return rows.select("cell_id", "o.ref_id", F.coalesce(-F.col("o.best.order"), F.lit(0)).alias("rule"), F.coalesce("o.best.sub", F.lit("unassigned")).alias("cell_type"), F.coalesce("o.best.confidence", F.lit(0.0)).alias("confidence"))


def typing_report(typed: DataFrame) -> DataFrame:
    return typed.groupBy("ref_id", "cell_type").agg(F.count(F.lit(1)).alias("cells"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


def first_choice(typed: DataFrame) -> DataFrame:
    """cell_id, refined: the type of the first layer."""
    w = Window.partitionBy("cell_id").orderBy("ref_id")
    return typed.withColumn("k", F.row_number().over(w)).where("k = 1").select("cell_id", F.col("cell_type").alias("refined"))
