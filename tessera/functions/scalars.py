"""Scalar functions, as columns where they run on data and as Python where they plan."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def tile_size(height: int, width: int, available_gb: float, channels: int = 2, itemsize: int = 2, model_gb: float = 1.0) -> tuple[int, int]:
    """Height and width of a tile that fits: a quarter of the free memory stays free, ten times a pixel's bytes are needed,
    and a tile has at most 1 GiB; multiples of 256, at least 256, at most the image."""
    usable = (available_gb - model_gb) * 0.75 * 1024**3
    if usable <= 0:
        raise ValueError("no memory is left beside the model")
    pixels = min(usable / (channels * itemsize * 10), 1024**3 / (channels * itemsize))
    ratio = width / height
    h = math.floor(math.sqrt(pixels / ratio))
    w = math.floor(h * ratio)
    fit = lambda n, most: min(most, max(256, n // 256 * 256))
    return fit(h, height), fit(w, width)


def overlap(tile: int, diameter: float | None = None, percent: float | None = None) -> int:
    """Overlap of tiles: a share, else twice the diameter, else a tenth; at least 100, but at most half a tile."""
    n = math.floor(tile * percent) if percent else int(2 * diameter) if diameter else math.floor(tile * 0.1)
    return min(max(n, 100), tile // 2)


def manual_overlap(value: float, tile: int) -> int:
    """A share between 0 and 1, else pixels; an overlap of a tile or more is an error."""
    n = math.floor(value * tile) if 0 < value < 1 else int(value)
    if not 0 <= n < tile:
        raise ValueError(f"an overlap of {n} needs a larger tile than {tile}")
    return n


def needs_tiles(height: int, width: int, itemsize: int, limit_gb: float) -> bool:
    """Whether six copies of the image take more than half of the memory."""
    return height * width * itemsize / 1024**3 * 6 > 0.5 * limit_gb


def initial_estimate(pixels: int, gpu: bool = False, tiled: bool = False) -> tuple[float, float]:
    """Least and most seconds at the planned pixel rates."""
    fast, slow = (15e6, 5e6) if gpu else (2e6, 0.5e6)
    return pixels / fast * (1.1 if tiled else 1), pixels / slow * (1.2 if tiled else 1)


def remaining(tiles: Column, seconds: Column, workers: int = 1) -> Column:
    return tiles * seconds if workers <= 1 else tiles * seconds / (0.8 * workers)


def duration(seconds: Column) -> Column:
    """x.x seconds, x.x minutes, or H hours M minutes. Tenths are cut by floor(10 s + 0.5), so engines agree on ties."""
    tenths = lambda c: (F.floor(c * 10 + 0.5) / 10).cast("decimal(20,1)").cast("string")
    hours = F.floor(seconds / 3600)
    return (
        F.when(seconds < 60, F.concat(tenths(seconds), F.lit(" seconds")))
        .when(seconds < 3600, F.concat(tenths(seconds / 60), F.lit(" minutes")))
        .otherwise(F.concat(hours.cast("string"), F.lit(" hours "), F.floor((seconds - hours * 3600) / 60).cast("string"), F.lit(" minutes")))
    )


def gib(value: Column, of: int = 1) -> Column:
    """Bytes (of=1) or MiB (of=1024**2) as GiB."""
    return value * of / (1024**3)


def out_of_memory(message: Column) -> Column:
    return F.contains(F.lower(message), F.lit("out of memory"))


def percent(done: Column, total: Column) -> Column:
    return F.when(total != 0, 100.0 * done / total)


def palette_position(rank: Column, n: Column) -> Column:
    return F.when(n > 1, (rank - 1) / (n - 1)).otherwise(F.lit(0.0))


def squared_distance(ax: Column, ay: Column, bx: Column, by: Column) -> Column:
    return (ax - bx) * (ax - bx) + (ay - by) * (ay - by)


def memory_limit(ram_gb: float, device_gb: float | None = None) -> float:
    """The memory that bounds a run: the least of main and device memory."""
    return ram_gb if device_gb is None else min(ram_gb, device_gb)


def shrunk_tile(tile: int, free_gb: float, need_gb: float, least: int = 256) -> int:
    """A smaller tile after one that didn't fit: its area falls with free by need memory, a fifth kept back; a multiple of 256.

    Always smaller than before, down to `least`.
    """
    side = tile * min(0.5, math.sqrt(max(0.0, free_gb / need_gb * 0.8))) if need_gb > free_gb else tile / 2
    return max(least, math.floor(side) // 256 * 256)


def elapsed(start: Column, end: Column) -> Column:
    """Seconds between two timestamps, with fractions."""
    return (F.unix_micros(end) - F.unix_micros(start)) / 1e6
