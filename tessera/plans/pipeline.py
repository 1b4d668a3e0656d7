"""The stage registry: named lazy tables over one set of inputs, with the edges between them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig
from ..operators import cluster, normalize, spatial, tables, typing_rules
from ..schema import MEASURED


class Pipeline:
    """stage(name) gives a stage's table, built once from those that it needs; nothing runs until an action does."""

    needs = {"cells": (), "normalized": ("cells",), "typed": ("cells",), "kmeans": ("cells",), "embedding": ("cells",), "neighbours": ("cells",), "interactions": ("cells", "typed"), "density": ("cells",), "quality_control": ("cells",), "typing_report": ("typed",), "export": ("cells", "typed", "kmeans", "density")}

    def __init__(self, spark: SparkSession, cells: DataFrame, conf: RunConfig | None = None, markers: list[str] | None = None):
        self.spark, self.cells_in, self.conf, self.markers, self.made = spark, cells, conf or RunConfig(), markers or MEASURED, {}

    def stage(self, name: str) -> DataFrame:
        if name not in self.needs:
            raise KeyError(f"no stage {name}; there are {sorted(self.needs)}")
        if name not in self.made:
            build: Callable[..., DataFrame] = getattr(self, f"_{name}")
            self.made[name] = build(*[self.stage(n) for n in self.needs[name]])
        return self.made[name]

    def lineage(self) -> DataFrame:
        return self.spark.createDataFrame([(n, k) for k, ns in self.needs.items() for n in ns], "source string, stage string")

    def _cells(self):
        c = self.conf
        return self.cells_in.where(F.col("area").between(c.min_cell_area, c.max_cell_area)) if "area" in self.cells_in.columns else self.cells_in

    def _normalized(self, cells):
        long = tables.measurements(cells, self.markers)
        value = "raw"
        if self.conf.log_norm:
            long, value = normalize.log_norm(long), "norm"
        return normalize.z_norm(long, value) if self.conf.z_norm else long

    def _typed(self, cells):
        return typing_rules.assign_types(typing_rules.marker_levels(tables.measurements(cells, self.markers)), measured=self.markers)

    def _kmeans(self, cells):
        return cluster.kmeans(cells, self.markers, self.conf.kmeans_clusters)

    def _embedding(self, cells):
        return cluster.embedding(cells, self.markers)

    def _neighbours(self, cells):
        return spatial.nearest(cells, self.markers, self.conf.umap_n_neighbors)

    def _interactions(self, cells, typed):
        return spatial.interaction_scores(cells.select("cell_id", "x", "y").join(typing_rules.first_choice(typed), "cell_id"), self.conf.interaction_radius, "refined")

    def _density(self, cells):
        return spatial.local_density(cells, self.conf.neighborhood_size)

    def _quality_control(self, cells):
        return tables.quality_control(cells, "area", self.conf.min_cell_area, self.conf.max_cell_area) if "area" in cells.columns else cells.agg(F.count(F.lit(1)).alias("n"))

    def _typing_report(self, typed):
        return typing_rules.typing_report(typed)

    def _export(self, cells, typed, kmeans, density):
        return cells.join(typing_rules.first_choice(typed), "cell_id", "left").join(kmeans.withColumnRenamed("cluster", "kmeans"), "cell_id", "left").join(density, "cell_id", "left")
