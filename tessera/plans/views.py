"""Domain tables as deterministic views over the driver's tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..schema import PANEL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell_id, cluster, x, y and the 23 markers, as integers from the embeddings."""
    q = lambda i: F.floor((F.get("embedding", F.lit(i)).cast("double") + 1.0) * 1000.0).cast("long")
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("cell_id"), F.col("label").alias("cluster"), q(23).alias("x"), q(24).alias("y"), *[q(k).alias(m) for k, m in enumerate(PANEL)])


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """y, x below 512 and v, the greatest whole price there."""
    t = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 512).alias("y"), (F.col("l_partkey") % 512).alias("x"), F.floor("l_extendedprice").cast("long").alias("v"))
    return t.groupBy("y", "x").agg(F.max("v").alias("v"))


def interaction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cell_type_1, cell_type_2 (the type of the next event of the user), interaction_score, row_idx."""
    w = Window.partitionBy("user_id").orderBy("event_id")
    t = table(spark, sf_dir, "events").select(F.col("event_type").alias("cell_type_1"), F.lead("event_type").over(w).alias("cell_type_2"), F.col("value").alias("interaction_score"), F.col("event_id").alias("row_idx"))
    return t.where("cell_type_2 is not null")


def _q(i: int) -> str:
    return f"cast(floor((cast(embedding[{i + 1}] as double) + 1.0) * 1000.0) as bigint)"


CELLS = "cells AS (SELECT vec_id AS cell_id, label AS cluster, " + f"{_q(23)} AS x, {_q(24)} AS y, " + ", ".join(f'{_q(k)} AS "{m}"' for k, m in enumerate(PANEL)) + " FROM embeddings)"
PIXELS = "pixels AS (SELECT l_orderkey % 512 AS y, l_partkey % 512 AS x, max(cast(floor(l_extendedprice) AS bigint)) AS v FROM lineitem GROUP BY 1, 2)"
INTERACTIONS = (
    "inter AS (SELECT * FROM (SELECT event_type AS cell_type_1, lead(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS cell_type_2, value AS interaction_score, event_id AS row_idx FROM events) "
    "WHERE cell_type_2 IS NOT NULL)"
)


def long_sql(markers: list[str]) -> str:
    """long: cell_id, cluster, marker, raw."""
    return "long AS (" + " UNION ALL ".join(f"SELECT cell_id, cluster, '{m}' AS marker, cast(\"{m}\" AS double) AS raw FROM cells" for m in markers) + ")"
