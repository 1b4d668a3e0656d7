"""Run configuration: flat `key: value` text with defaults."""

from __future__ import annotations

from dataclasses import dataclass, fields


@dataclass(frozen=True)
class RunConfig:
    sample_id: str = "sample"
    nuclei_diameter: int = 20
    nuclei_expansion: int = 10
    membrane_diameter: int = 30
    membrane_compactness: float = 0.5
    log_norm: bool = True
    z_norm: bool = True
    custom_filter: bool = False
    leiden_resolution: float = 0.5
    kmeans_clusters: int = 15
    umap_n_neighbors: int = 15
    umap_min_dist: float = 0.1
    min_cell_area: int = 50
    max_cell_area: int = 5000
    min_nucleus_area: int = 20
    interaction_radius: int = 50
    neighborhood_size: int = 100


def yes(value: str) -> bool:
    v = value.strip().strip("\"'").lower()
    if v in ("yes", "true", "on", "1"):
        return True
    if v in ("no", "false", "off", "0"):
        return False
    raise ValueError(f"not a yes or no: {value!r}")


def parse_config(text: str) -> RunConfig:
    """Read `key: value` lines; comments and unknown keys are ignored, missing keys have their defaults."""
    kinds = {f.name: type(f.default) for f in fields(RunConfig)}
    got = {}
    for line in text.splitlines():
        key, sep, value = line.partition(":")
        value = value.split(" #")[0].strip().strip("\"'")
        if sep and value and not line.lstrip().startswith("#") and (key := key.strip()) in kinds:
            got[key] = yes(value) if kinds[key] is bool else kinds[key](value)
    return RunConfig(**got)
