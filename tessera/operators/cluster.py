"""Clustering and embedding: k-means, principal components, communities of a neighbour graph, approximate neighbours."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, BucketedRandomProjectionLSH, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .spatial import nearest


def _vectors(cells: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip").transform(cells.select("cell_id", *[F.col(c).cast("double").alias(c) for c in columns]))


def kmeans(cells: DataFrame, columns: list[str], k: int = 15, seed: int = 1) -> DataFrame:
    v = _vectors(cells, columns)
    return KMeans(k=k, seed=seed).fit(v).transform(v).select("cell_id", F.col("prediction").alias("cluster"))


def embedding(cells: DataFrame, columns: list[str]) -> DataFrame:
    """cell_id, dim1, dim2: two principal components, in place of UMAP, which needs its own library."""
    v = _vectors(cells, columns)
    at = vector_to_array("pca")
    return PCA(k=2, inputCol="features", outputCol="pca").fit(v).transform(v).select("cell_id", at[0].alias("dim1"), at[1].alias("dim2"))


def approximate_nearest(cells: DataFrame, columns: list[str], k: int, reach: float, bucket: float | None = None, tables: int = 6, seed: int = 1) -> DataFrame:
    """cell_id, other, rank, d2: of the others within reach that random projections bring together, the k nearest by exact distance.

    bucket is the width of a projection's slices, twice the reach if not given. A cell that gets fewer than k this way is
    asked for again by the exact way, so every cell has k rows if there are as many others.
    """
    v = _vectors(cells, columns)
    model = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket or 2 * reach, numHashTables=tables, seed=seed).fit(v)
    met = model.approxSimilarityJoin(v, v, reach, "d").where("datasetA.cell_id <> datasetB.cell_id")
    rows = met.select(F.col("datasetA.cell_id").alias("cell_id"), F.col("datasetB.cell_id").alias("other"), (F.col("d") * F.col("d")).alias("d2"))
    found = rows.withColumn("rank", F.row_number().over(Window.partitionBy("cell_id").orderBy("d2", "other"))).where(F.col("rank") <= k).select("cell_id", "other", "rank", "d2")
    short = v.select("cell_id").join(found.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k), "cell_id", "left_anti")
    return found.join(short, "cell_id", "left_anti").union(nearest(cells.join(v.select("cell_id"), "cell_id", "left_semi"), columns, k, only=short))


def modularity(edges: DataFrame, labels: DataFrame, resolution: float = 1.0) -> float:
    """Share of edges inside clusters less the share that chance gives times resolution; edges count once in either direction."""
    both = edges.select("cell_id", "other").union(edges.select(F.col("other"), F.col("cell_id"))).distinct()
    own, far = labels.select("cell_id", F.col("cluster").alias("a")), labels.select(F.col("cell_id").alias("other"), F.col("cluster").alias("b"))
    known = both.join(own, "cell_id").join(far, "other")
    by = known.groupBy("a").agg(F.count(F.lit(1)).alias("ends"), F.count(F.when(F.col("a") == F.col("b"), 1)).alias("inside"))
    total = by.agg(F.sum("ends").alias("m")).select("m").scalar()
    found = by.agg(F.sum(F.col("inside") / total - resolution * F.pow(F.col("ends") / total, 2.0)).alias("q")).first().q
    return 0.0 if found is None else float(found)


def communities(edges: DataFrame, rounds: int = 8) -> DataFrame:
    """cell_id, cluster from neighbour edges (cell_id, other): label propagation in place of Leiden.

    Each round every cell takes the commonest label among its neighbours and itself (ties: the least), for a fixed
    number of rounds; the lineage is cut by a checkpoint in each, where a checkpoint folder is set. modularity() tells
    how good the result is.
    """
    both = edges.select("cell_id", "other").union(edges.select(F.col("other"), F.col("cell_id"))).distinct()
    labels = both.select("cell_id").distinct().withColumn("label", F.col("cell_id"))
    for _ in range(rounds):
        near = both.join(labels.select(F.col("cell_id").alias("other"), "label"), "other").select("cell_id", "label").union(labels.select("cell_id", "label"))
        votes = near.groupBy("cell_id", "label").agg(F.count(F.lit(1)).alias("n"))
        labels = votes.groupBy("cell_id").agg(F.max(F.struct("n", (-F.col("label")).alias("less"))).alias("v")).select("cell_id", (-F.col("v.less")).alias("label"))
        if labels.sparkSession.sparkContext._jsc.sc().getCheckpointDir().isDefined():
            labels = labels.checkpoint()
    return labels.select("cell_id", F.col("label").alias("cluster"))
