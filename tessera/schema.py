"""Canonical column names, spellings that are accepted for them, and the fixed panel and rule tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Accepted spellings of canonical columns.
ALIASES = {
    "cell_id": ("CellID",),
    "x": ("X", "x_centroid"),
    "y": ("Y", "y_centroid"),
    "cluster": ("Cluster",),
    "cluster_size": ("ClusterSize",),
    "refined": ("leiden_refined",),
    "dim1": ("UMAP1", "UMAP_1"),
    "dim2": ("UMAP2", "UMAP_2"),
    "neighbors": ("Neighbors",),
    "local_density": ("LocalDensity",),
}

#: The panel's channels in order, as index, source name, marker, category.
CHANNELS = [
    (0, "DAPI_AF_R01", "DAPI", "nuclear"),
    (1, "CD45-AF488-CST", "CD45", "immune_pan"),
    (2, "CD3E-AF555-CST", "CD3E", "tcell"),
    (3, "Ki67-AF647-CST", "Ki67", "proliferation"),
    (4, "CD8a-AF750-CST", "CD8a", "tcell_cytotoxic"),
    (5, "Vim-AF488-CST", "VIM", "mesenchymal"),
    (6, "CD68-AF555-CST", "CD68", "macrophage"),
    (7, "HLA-DRA-AF4647", "HLADR", "mhc_class2"),
    (8, "CD31-AF750", "CD31", "endothelial"),
    (9, "SMA-AF488", "ACTA2", "smooth_muscle"),
    (10, "CD20-AF555", "CD20", "bcell"),
    (11, "CD163-AF647", "CD163", "macrophage_m2"),
    (12, "CD44-AF750-Nov", "CD44", "adhesion"),
    (13, "PanCK-AF488", "PANCK", "epithelial"),
    (14, "CD38-AF555", "CD38", "plasma_cell"),
    (15, "CD11c-AF647", "CD11c", "dendritic"),
    (16, "PDGFRA-AF488", "PDGFRA", "fibroblast"),
    (17, "COL1A1-AF555", "COL1A1", "collagen"),
    (18, "CD14-AF647", "CD14", "monocyte"),
    (19, "EPCAM-AF488", "EPCAM", "epithelial"),
    (20, "CD56-AF555", "CD56", "nk_cell"),
    (21, "CD45RO-AF647-BioT", "CD45RO", "memory_tcell"),
    (22, "DAPI_R06", "DAPI2", "nuclear"),
]
PANEL = [c[2] for c in CHANNELS]
#: The markers that are measured by default.
MEASURED = ["DAPI", "CD45", "CD3E", "CD8a", "CD20", "CD68", "PANCK", "EPCAM", "VIM", "Ki67"]

#: The cell-type rules, as row, ref_id, group, type, subtype, rank filter, least confidence, conditions (marker, level).
RULES = [
    (1, 1, "epithelial", "tumor", "panck_positive", "positive_only", 30, [("PANCK", "high"), ("EPCAM", "high"), ("CD45", "low")]),
    (2, 1, "epithelial", "tumor", "epcam_positive", "positive_only", 30, [("EPCAM", "high"), ("PANCK", "medium"), ("CD45", "low")]),
    (3, 1, "immune", "tcell", "cd3_positive", "positive_only", 30, [("CD3E", "high"), ("CD45", "high"), ("PANCK", "low")]),
    (4, 1, "immune", "tcell", "cd8_cytotoxic", "positive_only", 30, [("CD8a", "high"), ("CD3E", "high"), ("CD45", "high")]),
    (5, 1, "immune", "tcell", "memory", "positive_only", 30, [("CD45RO", "high"), ("CD3E", "high"), ("CD45", "high")]),
    (6, 1, "immune", "bcell", "cd20_positive", "positive_only", 30, [("CD20", "high"), ("CD45", "high"), ("CD3E", "low")]),
    (7, 1, "immune", "plasma", "cd38_positive", "positive_only", 30, [("CD38", "high"), ("CD45", "high"), ("CD20", "medium")]),
    (8, 1, "immune", "macrophage", "cd68_positive", "positive_only", 30, [("CD68", "high"), ("CD45", "high"), ("CD3E", "low")]),
    (9, 1, "immune", "macrophage", "m2_type", "positive_only", 30, [("CD163", "high"), ("CD68", "high"), ("CD45", "high")]),
    (10, 1, "immune", "monocyte", "cd14_positive", "positive_only", 30, [("CD14", "high"), ("CD45", "high"), ("CD68", "medium")]),
    (11, 1, "immune", "dendritic", "cd11c_positive", "positive_only", 30, [("CD11c", "high"), ("CD45", "high"), ("CD3E", "low")]),
    (12, 1, "immune", "nk_cell", "cd56_positive", "positive_only", 30, [("CD56", "high"), ("CD45", "high"), ("CD3E", "low")]),
    (13, 1, "stromal", "fibroblast", "pdgfra_positive", "positive_only", 30, [("PDGFRA", "high"), ("VIM", "high"), ("CD45", "low")]),
    (14, 1, "stromal", "fibroblast", "collagen_producing", "positive_only", 30, [("COL1A1", "high"), ("VIM", "high"), ("CD45", "low")]),
    (15, 1, "endothelial", "vessel", "cd31_positive", "positive_only", 30, [("CD31", "high"), ("CD45", "low"), ("PANCK", "low")]),
    (16, 1, "smooth_muscle", "vessel", "acta2_positive", "positive_only", 30, [("ACTA2", "high"), ("CD31", "medium"), ("CD45", "low")]),
    (17, 1, "proliferating", "any", "ki67_positive", "positive_only", 20, [("Ki67", "high")]),
    (18, 2, "immune", "activated", "hladr_positive", "positive_only", 20, [("HLADR", "high"), ("CD45", "high")]),
    (19, 2, "adhesion", "high_cd44", "cd44_positive", "positive_only", 20, [("CD44", "high")]),
]
RULE_CSV = "ref_id INT, cell_group STRING, cell_type STRING, cell_subtype STRING, rank_filter STRING, min_confidence INT, marker1 STRING, rule1 STRING, marker2 STRING, rule2 STRING, marker3 STRING, rule3 STRING"


def channels(spark: SparkSession) -> DataFrame:
    """The channel catalogue: channel_idx, source_name, marker, category."""
    return spark.createDataFrame(CHANNELS, "channel_idx int, source_name string, marker string, category string")


def canonical(df: DataFrame) -> DataFrame:
    """Rename accepted spellings to the canonical ones and <marker>_norm to <marker>; others stay."""
    lookup = {a: k for k, names in ALIASES.items() for a in names}
    renamed = {c: lookup[c] for c in df.columns if c in lookup and lookup[c] not in df.columns}
    renamed |= {f"{m}_norm": m for m in PANEL if f"{m}_norm" in df.columns and m not in df.columns}
    return df.withColumnsRenamed(renamed)


def no_nan(df: DataFrame) -> DataFrame:
    """NaN to null in every floating column."""
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c, t in df.dtypes if t in ("double", "float")})
