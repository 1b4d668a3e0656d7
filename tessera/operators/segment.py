"""Segmentation of tiles with a pluggable model, and a baseline model in numpy."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

Segmenter = Callable[[np.ndarray], np.ndarray]
#: A model may give labels alone or a tuple that begins with them, and then flows, styles and diameters.
Masks = np.ndarray | tuple
LABELS = "tile_id long, y long, x0 long, x1 long, label long"


def components(mask: np.ndarray) -> np.ndarray:
    """Labels from 1 of the 4-connected parts of a boolean image, by the order of their first pixel."""
    h, w = mask.shape
    label = np.where(mask, np.arange(1, h * w + 1).reshape(h, w), 0)
    while True:  # the least number spreads until nothing changes
        new = label.copy()
        for a, b in ((np.s_[1:, :], np.s_[:-1, :]), (np.s_[:-1, :], np.s_[1:, :]), (np.s_[:, 1:], np.s_[:, :-1]), (np.s_[:, :-1], np.s_[:, 1:])):
            near = np.where((new[b] > 0) & (new[a] > 0), np.minimum(new[a], new[b]), new[a])
            new[a] = near
        flat = new.ravel()
        jump = np.where(flat > 0, flat[np.maximum(flat, 1) - 1], 0).reshape(h, w)
        if (jump == label).all():
            break
        label = jump
    return np.unique(label, return_inverse=True)[1].reshape(h, w) + (0 if (label == 0).any() else 1)


def expand(label: np.ndarray, steps: int) -> np.ndarray:
    """Labels grown by `steps` pixels into the background; where two meet the lesser stays."""
    out = label.copy()
    for _ in range(steps):
        big = np.where(out > 0, out, np.iinfo(out.dtype).max)
        p = np.pad(big, 1, constant_values=np.iinfo(out.dtype).max)
        near = np.minimum.reduce([p[:-2, 1:-1], p[2:, 1:-1], p[1:-1, :-2], p[1:-1, 2:]])
        out = np.where((out == 0) & (near < np.iinfo(out.dtype).max), near, out)
    return out


def baseline(threshold: float, least_area: int = 1, growth: int = 0) -> Segmenter:
    """Pixels above the threshold, in parts of least_area pixels or more, grown by `growth`."""

    def run(image: np.ndarray) -> np.ndarray:
        label = components(image > threshold).astype(np.int64)
        area = np.bincount(label.ravel())
        keep = np.where(area >= least_area, np.arange(len(area)), 0)
        keep[0] = 0
        return expand(np.unique(keep[label], return_inverse=True)[1].reshape(label.shape).astype(np.int64), growth)

    return run


def segment_tiles(tiles: DataFrame, segmenter: Segmenter) -> DataFrame:
    """Run-length rows (tile_id, y, x0, x1, label) of each tile row of the TIFF source; background is left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                label = segmenter(np.frombuffer(r.data, dtype=np.dtype(r.dtype)).reshape(r.h, r.w))
                rows = []
                for y in range(r.h):
                    line = label[y]
                    cuts = (np.flatnonzero(np.diff(line)) + 1).tolist()
                    rows += [(r.tile_id, r.y0 + y, r.x0 + a, r.x0 + b, int(line[a])) for a, b in zip([0, *cuts], [*cuts, r.w]) if line[a]]
                yield pd.DataFrame(rows, columns=["tile_id", "y", "x0", "x1", "label"])

    return tiles.mapInPandas(run, LABELS)


def as_masks(result: Masks) -> tuple[np.ndarray, object, object, float | None]:
    """labels, flows, styles, diameter of what a model gives: labels, or a tuple of two to four that begins with them."""
    parts = result if isinstance(result, tuple) else (result,)
    if not 1 <= len(parts) <= 4:
        raise ValueError(f"a model gave {len(parts)} parts; labels, flows, styles and diameter are known")
    labels, flows, styles, diameter = (*parts, *[None] * (4 - len(parts)))
    return np.asarray(labels), flows, styles, None if diameter is None else float(np.mean(diameter))


def stack_channels(tiles: DataFrame, channels: list[int]) -> DataFrame:
    """One row per tile with `stack`: the pixels of the given pages in order; tiles that lack one are left out.

    A tile's channels are gathered by path and tile, at most one row each, so a group is a few windows.
    """
    from pyspark.sql import functions as F

    page = F.map_from_entries(F.collect_list(F.struct("page", "data")))
    got = tiles.where(F.col("page").isin(channels)).groupBy("path", "tile_id", "y0", "x0", "h", "w", "dtype").agg(page.alias("by_page"))
    return got.where(F.size("by_page") == len(channels)).select("path", "tile_id", "y0", "x0", "h", "w", "dtype", F.array(*[F.col("by_page")[c] for c in channels]).alias("stack"))


def segment_stacks(stacks: DataFrame, model: Callable[[np.ndarray], Masks]) -> DataFrame:
    """Run-length rows like segment_tiles', from a model that takes an array (channel, y, x)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                image = np.stack([np.frombuffer(x, dtype=np.dtype(r.dtype)).reshape(r.h, r.w) for x in r.stack])
                label, rows = as_masks(model(image))[0], []
                for y in range(r.h):
                    cuts = (np.flatnonzero(np.diff(label[y])) + 1).tolist()
                    rows += [(r.tile_id, r.y0 + y, r.x0 + a, r.x0 + b, int(label[y][a])) for a, b in zip([0, *cuts], [*cuts, r.w]) if label[y][a]]
                yield pd.DataFrame(rows, columns=["tile_id", "y", "x0", "x1", "label"])

    return stacks.mapInPandas(run, LABELS)
