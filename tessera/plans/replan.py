"""Replanning: a run that doesn't fit is planned again with smaller tiles."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from ..functions.scalars import needs_tiles, shrunk_tile

T = TypeVar("T")
#: Words of messages that tell of too little memory, on the driver, in a Python worker or on a device.
MEMORY_SIGNS = ("out of memory", "outofmemory", "memoryerror", "cannot allocate", "unable to allocate", "heap space", "exit code: 137")


def lacks_memory(error: BaseException) -> bool:
    """Whether an error, or one that caused it, tells of too little memory."""
    seen = 0
    while error is not None and seen < 20:
        if isinstance(error, MemoryError) or any(s in str(error).lower() for s in MEMORY_SIGNS):
            return True
        error, seen = error.__cause__ or error.__context__, seen + 1
    return False


def run_with_replan(run: Callable[[int], T], tile: int, least: int = 256, attempts: int = 5, free_gb: float = 1.0, need_gb: float = 2.0) -> tuple[T, int]:
    """run(tile), again with a smaller tile after each failure for lack of memory; the result and the tile that it came from.

    run must do its action (write its result), since a plan alone fails nowhere. Other errors, the last attempt's and one
    at the least tile are raised.
    """
    for k in range(attempts):
        try:
            return run(tile), tile
        except Exception as e:
            if not lacks_memory(e) or tile <= least or k == attempts - 1:
                raise
            tile = shrunk_tile(tile, free_gb, need_gb, least)
    raise ValueError("no attempt was asked for")


def whole_or_tiled(whole: Callable[[], T], tiled: Callable[[], T], height: int, width: int, itemsize: int, limit_gb: float) -> T:
    """whole() if the image fits, else or after a lack of memory tiled()."""
    if needs_tiles(height, width, itemsize, limit_gb):
        return tiled()
    try:
        return whole()
    except Exception as e:
        if not lacks_memory(e):
            raise
        return tiled()
