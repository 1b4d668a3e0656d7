"""TIFF and BigTIFF as a Python data source: page metadata, and windows of pixels read by strip or tile.

spark.read.format("tiff_pages") gives a row per page; "tiff_tiles" a row per page and planned tile, with the window's
pixels as bytes. Only the strips or tiles that a window touches are read; a compressed one (Deflate, LZW) is decoded by
itself, so a window never needs the whole page.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: TIFF field types by number, as struct code.
FIELD_TYPES = {1: "B", 2: "c", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
PAGES = "path string, page int, height long, width long, dtype string, samples int, compression int, tiled boolean"
TILES = "path string, page int, tile_id long, y0 long, x0 long, h int, w int, dtype string, data binary"


@dataclass
class Page:
    height: int
    width: int
    dtype: str
    samples: int
    compression: int
    block: tuple[int, int]  # rows and columns of a strip or tile
    tiled: bool
    offsets: list[int]
    sizes: list[int]
    predictor: int = 1


def lzw(data: bytes) -> bytes:
    """What an LZW strip holds: codes of 9 to 12 bits, high bits first, the width growing one code early."""
    out, table, width, last = [], [], 9, b""
    bits = have = 0
    for byte in data:
        bits, have = (bits << 8 | byte) & 0xFFFFFFFF, have + 8
        if have < width:
            continue
        have -= width
        code = bits >> have & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            table, width, last = [], 9, b""
            continue
        known = code < 256 or code - 258 < len(table)
        if not known and (not last or code - 258 != len(table)):
            raise ValueError("a broken LZW strip")
        word = (bytes((code,)) if code < 256 else table[code - 258]) if known else last + last[:1]
        if last:
            table.append(last + word[:1])
        out.append(word)
        last = word
        size = 258 + len(table) + 1  # the next entry
        width = 12 if size >= 2048 else 11 if size >= 1024 else 10 if size >= 512 else 9
    return b"".join(out)


def undo_predictor(rows: np.ndarray, predictor: int) -> np.ndarray:
    """Rows of pixels from the differences between neighbours that were stored."""
    if predictor == 1:
        return rows
    if predictor == 2 and rows.dtype.kind in "ui":
        return np.cumsum(rows, axis=1, dtype=rows.dtype.newbyteorder("="))
    if predictor == 3 and rows.dtype.kind == "f":  # bytes of a row by significance, then differences
        size = rows.dtype.itemsize
        flat = np.cumsum(np.ascontiguousarray(rows).view(np.uint8).reshape(rows.shape[0], -1), axis=1, dtype=np.uint8)
        planes = flat.reshape(rows.shape[0], size, rows.shape[1]).transpose(0, 2, 1)
        return np.ascontiguousarray(planes).view(f">f{size}").reshape(rows.shape)
    raise ValueError(f"predictor {predictor} isn't read for {rows.dtype}")


def pages(path: str) -> list[Page]:
    """The pages' layout, from the headers alone."""
    with open(path, "rb") as f:
        head = f.read(16)
        order = {b"II": "<", b"MM": ">"}.get(head[:2])
        magic = struct.unpack(order + "H", head[2:4])[0] if order else 0
        if magic not in (42, 43):
            raise ValueError(f"{path} is no TIFF file")
        big = magic == 43
        n_code, at_code, entry, inline = ("Q", "Q", 20, 8) if big else ("H", "I", 12, 4)
        at = struct.unpack(order + at_code, head[8:16] if big else head[4:8])[0]
        out, seen = [], set()
        while at and at not in seen:
            seen.add(at)
            f.seek(at)
            n = struct.unpack(order + n_code, f.read(struct.calcsize(n_code)))[0]
            body = f.read(n * entry)
            at = struct.unpack(order + at_code, f.read(struct.calcsize("=" + at_code)))[0]
            tags = {}
            for k in range(n):
                e = body[k * entry : (k + 1) * entry]
                tag, kind = struct.unpack(order + "HH", e[:4])
                count = struct.unpack(order + ("Q" if big else "I"), e[4 : entry - inline])[0]
                code = FIELD_TYPES.get(kind)
                if code is None:
                    continue
                size = struct.calcsize("=" + code) * count
                raw = e[-inline:][:size]
                if size > inline:
                    f.seek(struct.unpack(order + at_code, e[-inline:])[0])
                    raw = f.read(size)
                tags[tag] = struct.unpack(order + code * count, raw)
            one = lambda t, default: tags.get(t, (default,))[0]
            bits, form, tiled = one(258, 8), one(339, 1), 324 in tags
            dtype = np.dtype(f"{order}{ {1: 'u', 2: 'i', 3: 'f'}.get(form, 'u') }{bits // 8}").str
            h, w = one(257, 0), one(256, 0)
            block = (one(323, h), one(322, w)) if tiled else (min(one(278, h), h), w)
            out.append(Page(h, w, dtype, one(277, 1), one(259, 1), block, tiled, list(tags[324 if tiled else 273]), list(tags[325 if tiled else 279]), one(317, 1)))
        return out


def read_window(path: str, page: Page, y0: int, y1: int, x0: int, x1: int) -> np.ndarray:
    """Pixels [y0, y1) x [x0, x1) of a page of one sample."""
    if page.samples != 1:
        raise ValueError("one sample per pixel is read")
    if page.compression not in (1, 5, 8, 32946):
        raise ValueError(f"compression {page.compression} isn't read")
    bh, bw = page.block
    across = -(-page.width // bw)
    dtype = np.dtype(page.dtype)
    out = np.zeros((y1 - y0, x1 - x0), dtype=dtype)
    with open(path, "rb") as f:
        for by in range(y0 // bh, -(-y1 // bh)):
            for bx in range(x0 // bw, -(-x1 // bw)):
                k = by * across + bx
                rows = bh if page.tiled else min(bh, page.height - by * bh)
                top, left = by * bh, bx * bw
                a, b, c, d = max(y0, top), min(y1, top + rows), max(x0, left), min(x1, left + bw)
                if page.compression == 1 and page.predictor == 1:  # only the rows that are needed
                    f.seek(page.offsets[k] + (a - top) * bw * dtype.itemsize)
                    part = np.frombuffer(f.read((b - a) * bw * dtype.itemsize), dtype=dtype).reshape(b - a, bw)
                else:
                    f.seek(page.offsets[k])
                    raw = f.read(page.sizes[k])
                    raw = raw if page.compression == 1 else lzw(raw) if page.compression == 5 else zlib.decompress(raw)
                    part = undo_predictor(np.frombuffer(raw[: rows * bw * dtype.itemsize], dtype=dtype).reshape(rows, bw), page.predictor)[a - top : b - top]
                out[a - y0 : b - y0, c - x0 : d - x0] = part[:, c - left : d - left]
    return out


def write_tiff(path: str, planes: Iterable[np.ndarray], rows_per_strip: int = 256, big: bool | None = None) -> None:
    """An uncompressed little-endian TIFF with a page per plane, written strip by strip; planes may come one by one.

    big: 64-bit offsets (BigTIFF); if not given, chosen for a list of planes of 4 GB or more, and for planes of unknown size.
    """
    if big is None:
        big = not isinstance(planes, (list, tuple)) or sum(p.nbytes for p in planes) + 4096 * len(planes) >= 1 << 32
    at_code, n_code, at_kind = ("Q", "Q", 16) if big else ("I", "H", 4)
    word = struct.calcsize("<" + at_code)
    with open(path, "wb") as f:
        f.write(b"II" + (struct.pack("<HHHQ", 43, 8, 0, 0) if big else struct.pack("<HI", 42, 0)))
        link = f.tell() - word
        for plane in planes:
            p = np.asarray(plane)
            h, w = p.shape
            offsets, sizes = [], []
            for y in range(0, h, rows_per_strip):
                raw = np.ascontiguousarray(p[y : y + rows_per_strip], dtype=p.dtype.newbyteorder("<")).tobytes()
                offsets.append(f.tell())
                sizes.append(f.write(raw))
            lists = []
            for values in (offsets, sizes):
                lists.append(f.tell() if len(values) > 1 else values[0])
                if len(values) > 1:
                    f.write(struct.pack(f"<{len(values)}{at_code}", *values))
            f.write(b"\0" * (f.tell() % 2))
            form = {"u": 1, "i": 2, "f": 3}[p.dtype.kind]
            fields = [(256, 4, 1, w), (257, 4, 1, h), (258, 3, 1, p.dtype.itemsize * 8), (259, 3, 1, 1), (262, 3, 1, 1), (273, at_kind, len(offsets), lists[0]), (277, 3, 1, 1), (278, 4, 1, rows_per_strip), (279, at_kind, len(sizes), lists[1]), (339, 3, 1, form)]
            here = f.tell()
            f.write(struct.pack("<" + n_code, len(fields)) + b"".join(struct.pack(f"<HH{at_code}{at_code}", *x) for x in fields))
            after = f.tell()
            f.write(b"\0" * word)
            f.seek(link)
            f.write(struct.pack("<" + at_code, here))
            f.seek(0, 2)
            link = after


def demux(spark, path: str, folder: str, catalogue: list[tuple[int, str]]) -> DataFrame:
    """Write each page of a multi-page file as <folder>/<name>.tif, a task per page; page, name, error (null if written).

    catalogue: page and name; a page that the file lacks or that can't be read is told by its error and the others go
    on. folder must be one that the executors share. A page is copied window by window, never held whole.
    """

    def one(page: int, name: str) -> str | None:
        try:
            layout = pages(path)
            if page >= len(layout):
                raise ValueError(f"the file has {len(layout)} pages")
            p = layout[page]

            size, target = 256, Path(folder) / f"{name}.tif"
            part = target.with_suffix(f".part{page}")
            lines = (read_window(path, p, y, min(y + size, p.height), 0, p.width) for y in range(0, p.height, size))
            write_rows(str(part), lines, (p.height, p.width), np.dtype(p.dtype), size)
            part.replace(target)
            return None
        except Exception as e:  # told by row, the other pages go on
            return f"{type(e).__name__}: {e}"

    def run(batches):
        for b in batches:
            rows = [(r["page"], r["name"], one(r["page"], r["name"])) for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())], names=["page", "name", "error"])

    wanted = spark.createDataFrame(catalogue, "page int, name string").repartition(max(1, len(catalogue)), "page")
    return wanted.mapInArrow(run, "page int, name string, error string")


def write_rows(path: str, blocks: Iterable[np.ndarray], shape: tuple[int, int], dtype: np.dtype, rows_per_strip: int) -> None:
    """A BigTIFF of one page from blocks of rows_per_strip rows in order, one block in memory at a time."""
    (h, w), offsets, sizes = shape, [], []
    with open(path, "wb") as f:
        f.write(b"II" + struct.pack("<HHHQ", 43, 8, 0, 0))
        for block in blocks:
            offsets.append(f.tell())
            sizes.append(f.write(np.ascontiguousarray(block, dtype=dtype.newbyteorder("<")).tobytes()))
        lists = []
        for values in (offsets, sizes):
            lists.append(f.tell() if len(values) > 1 else values[0])
            if len(values) > 1:
                f.write(struct.pack(f"<{len(values)}Q", *values))
        form = {"u": 1, "i": 2, "f": 3}[dtype.kind]
        fields = [(256, 4, 1, w), (257, 4, 1, h), (258, 3, 1, dtype.itemsize * 8), (259, 3, 1, 1), (262, 3, 1, 1), (273, 16, len(offsets), lists[0]), (277, 3, 1, 1), (278, 4, 1, rows_per_strip), (279, 16, len(sizes), lists[1]), (339, 3, 1, form)]
        here = f.tell()
        f.write(struct.pack("<Q", len(fields)) + b"".join(struct.pack("<HHQQ", *x) for x in fields) + b"\0" * 8)
        f.seek(8)
        f.write(struct.pack("<Q", here))


@dataclass
class Part(InputPartition):
    path: str
    page: int
    rows: tuple


class _Reader(DataSourceReader):
    def __init__(self, options: dict, tiles: bool):
        self.options, self.tiles = options, tiles

    def partitions(self):
        paths = [p for p in self.options["path"].split(",") if p]
        only = self.options.get("page")
        parts = []
        for path in paths:
            for k, page in enumerate(pages(path)):
                if only is not None and int(only) != k:
                    continue
                if not self.tiles:
                    parts.append(Part(path, k, ()))
                    continue
                t, o = int(self.options.get("tile", 1024)), int(self.options.get("overlap", 0))
                window = [int(self.options.get(n, d)) for n, d in (("y0", 0), ("y1", page.height), ("x0", 0), ("x1", page.width))]
                if not 0 <= o < t:
                    raise ValueError("the overlap must be less than the tile")
                ends = lambda n: [min(i * (t - o) + t, n) for i in range(1 if n <= t else -((t - n) // (t - o)) + 1)]
                across = ends(page.width)
                for i, y1 in enumerate(ends(page.height)):
                    for j, x1 in enumerate(across):
                        y0, x0 = max(0, y1 - t), max(0, x1 - t)
                        if y0 < window[1] and y1 > window[0] and x0 < window[3] and x1 > window[2]:
                            parts.append(Part(path, k, (i * len(across) + j, y0, y1, x0, x1)))
        return parts

    def read(self, part):
        page = pages(part.path)[part.page]
        if not self.tiles:
            yield part.path, part.page, page.height, page.width, page.dtype, page.samples, page.compression, page.tiled
            return
        tile, y0, y1, x0, x1 = part.rows
        yield part.path, part.page, tile, y0, x0, y1 - y0, x1 - x0, page.dtype, read_window(part.path, page, y0, y1, x0, x1).tobytes()


class TiffPages(DataSource):
    """Options: path (comma-separated), page."""

    @classmethod
    def name(cls):
        return "tiff_pages"

    def schema(self):
        return PAGES

    def reader(self, schema):
        return _Reader(self.options, False)


class TiffTiles(DataSource):
    """Options: path, page, tile, overlap, and a window y0, y1, x0, x1 that tiles must touch. A partition per tile."""

    @classmethod
    def name(cls):
        return "tiff_tiles"

    def schema(self):
        return TILES

    def reader(self, schema):
        return _Reader(self.options, True)


def register(spark) -> None:
    for kind in (TiffPages, TiffTiles):
        spark.dataSource.register(kind)
