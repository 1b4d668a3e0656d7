"""Images told apart, files of more kinds, replanning, guards, neighbours and clusters by invariants."""

import math
import zlib
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import scalars
from tessera.operators import cluster, geometry, segment, spatial, tables, tiles
from tessera.plans import replan
from tessera.schema import channels
from tessera.sinks import exports
from tessera.sources import files, tiff
from tessera.streaming import ingest


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


# --- images ---------------------------------------------------------------------------------------------------------


def test_two_slides_at_the_same_places(spark):
    one = [(k, 7 * k % 90, 11 * k % 80, k % 3) for k in range(60)]
    both = spark.createDataFrame([(i, *r) for i in ("a", "b") for r in one], "image_id string, cell_id long, x int, y int, cluster int")
    alone = both.where("image_id = 'a'").drop("image_id")
    by = ("image_id",)
    for f in (
        lambda c, by=(): spatial.radius_pairs(c, 20, by=by),
        lambda c, by=(): spatial.local_density(c, 20, by),
        lambda c, by=(): spatial.interaction_scores(c, 20, by=by),
        lambda c, by=(): spatial.composition(c, 20, [0, 1, 2], by=by),
        lambda c, by=(): spatial.spatial_stats(c, (10, 20), by=by),
    ):
        want, got = rows(f(alone)), f(both, by)
        a, b = (rows(got.where(F.col("image_id") == i).drop("image_id")) for i in "ab")
        assert want and a == b == want
    square = lambda i, x: (i, 1, [(x, 0.0), (x + 40, 0.0), (x + 40, 40.0), (x, 40.0)])
    regions = spark.createDataFrame([square("a", 0.0), square("b", 40.0)], "image_id string, region_id int, vertices array<struct<x:double,y:double>>")
    got = rows(geometry.points_in_polygons(both, regions, cell=16.0, by=by))
    assert got == sorted(((i, k, 1) for i, low in (("a", 0), ("b", 40)) for k, x, y, _ in one if low <= x < low + 40 and y < 40), key=repr)


def test_stitching_and_zones_by_slide(spark):
    r = np.random.default_rng(3)
    image = r.integers(0, 4, (40, 50))
    flat = [(i, int(y // 20), int(y), int(x), int(image[y, x])) for i in (1, 2) for y in range(40) for x in range(50)]
    labels = spark.createDataFrame(flat, "image_id int, tile_id long, y long, x long, label long")
    pixels = labels.select("image_id", "y", "x", (F.col("x") + F.col("y")).alias("v"))
    by = ("image_id",)
    stitched = tiles.stitch(labels, by)
    ids = {(t, k): n for n, (t, k) in enumerate(sorted({(t, k) for i, t, _, _, k in flat if k and i == 1}), 1)}
    want = np.array([[ids.get((y // 20, int(image[y, x])), 0) for x in range(50)] for y in range(40)])
    for i in (1, 2):
        got = np.zeros_like(want)
        for _, y, x, c in rows(stitched.where(F.col("image_id") == i)):
            got[y, x] = c
        assert (got == want).all()
    zones = {(r.image_id, r.cell_id): r for r in tiles.zonal(stitched, pixels, "v", by, side=16).collect()}
    pad = np.pad(want, 1)
    for n in ids.values():
        at = np.argwhere(want == n)
        edges = sum(int((pad[1 + dy : 41 + dy, 1 + dx : 51 + dx][want == n] != n).sum()) for dy, dx in ((0, 1), (0, -1), (1, 0), (-1, 0)))
        for i in (1, 2):
            z = zones[i, n]
            assert (z.area, z.perimeter) == (len(at), edges) and math.isclose(z.mean, at.sum(axis=1).mean()) and math.isclose(z.y, at[:, 0].mean())
    assert tiles.merge_seams(stitched, by).where("image_id = 1").count() == tiles.merge_seams(stitched.where("image_id = 1").drop("image_id")).count() > 0
    assert tiles.runs(stitched, by).agg(F.sum(F.col("x1") - F.col("x0"))).first()[0] == stitched.count()


# --- TIFF -----------------------------------------------------------------------------------------------------------


def lzw_encode(data):
    """The encoder of the format's description, to test the decoder with."""
    out, bits, have, table, width, w = bytearray(), 0, 0, {bytes((k,)): k for k in range(256)}, 9, b""

    def put(code):
        nonlocal bits, have
        bits, have = bits << width | code, have + width
        while have >= 8:
            have -= 8
            out.append(bits >> have & 255)
        bits &= (1 << have) - 1

    put(256)
    free = 258
    for b in data:
        c = bytes((b,))
        if w + c in table:
            w += c
            continue
        put(table[w])
        table[w + c] = free
        free += 1
        if free == 4095:
            put(256)
            table, width, free = {bytes((k,)): k for k in range(256)}, 9, 258
        elif free in (512, 1024, 2048):
            width += 1
        w = c
    if w:
        put(table[w])
        free += 1
        if free in (512, 1024, 2048):
            width += 1
    put(257)
    if have:
        out.append(bits << (8 - have) & 255)
    return bytes(out)


def test_lzw():
    r = np.random.default_rng(0)
    for data in (b"", b"a", b"aaaaaaaaaaaa", bytes(r.integers(0, 256, 30_000, dtype=np.uint8)), bytes(r.integers(0, 3, 60_000, dtype=np.uint8)), b"abcabcabd" * 3000):
        assert tiff.lzw(lzw_encode(data)) == data


@pytest.mark.parametrize("compression,predictor", [(1, 2), (8, 1), (8, 2), (5, 1), (5, 2)])
def test_predictor_and_compression(tmp_path, compression, predictor):
    image = np.random.default_rng(1).integers(0, 60_000, (11, 9)).astype("<u2")
    stored = image.copy()
    if predictor == 2:
        stored[:, 1:] = image[:, 1:] - image[:, :-1]
    path = str(tmp_path / "a.tif")
    tiff.write_tiff(path, [stored], rows_per_strip=4)
    page = tiff.pages(path)[0]
    raw = open(path, "rb").read()
    parts = [raw[o : o + n] for o, n in zip(page.offsets, page.sizes)]
    parts = [zlib.compress(x) if compression == 8 else lzw_encode(x) if compression == 5 else x for x in parts]
    page.offsets, page.sizes = [sum(map(len, parts[:k])) for k in range(len(parts))], [len(x) for x in parts]
    page.compression, page.predictor = compression, predictor
    (tmp_path / "b.bin").write_bytes(b"".join(parts))
    assert (tiff.read_window(str(tmp_path / "b.bin"), page, 2, 10, 1, 8) == image[2:10, 1:8]).all()


def test_big_files_and_demux(spark, tmp_path):
    planes = [np.random.default_rng(k).integers(0, 99, (300, 20)).astype(np.uint16) for k in range(3)]
    for big in (False, True):
        path = str(tmp_path / f"{big}.tif")
        tiff.write_tiff(path, (p for p in planes), big=big)
        assert all((tiff.read_window(path, page, 0, 300, 0, 20) == p).all() for page, p in zip(tiff.pages(path), planes, strict=True))
    got = {r.name: r.error for r in tiff.demux(spark, path, str(tmp_path), [(0, "DAPI"), (2, "CD45"), (7, "CD8a")]).collect()}
    assert got["DAPI"] is None and got["CD45"] is None and "3 pages" in got["CD8a"]
    out = str(tmp_path / "CD45.tif")
    assert (tiff.read_window(out, tiff.pages(out)[0], 0, 300, 0, 20) == planes[2]).all()
    tiff.register(spark)
    tiled = spark.read.format("tiff_tiles").option("path", path).option("tile", 64).load()
    stacks = segment.stack_channels(tiled, [0, 2])
    got = segment.segment_stacks(stacks, lambda im: ((im[0].astype(int) + im[1]) % 7, None, None, 30.0))
    whole = (planes[0].astype(int) + planes[2]) % 7
    seen = np.zeros_like(whole)
    for r in got.collect():
        seen[r.y, r.x0 : r.x1] = r.label
    assert stacks.count() == 5 and (seen == whole).all()


def test_model_results():
    labels = np.ones((2, 2), dtype=int)
    assert segment.as_masks(labels)[1:] == (None, None, None)
    assert segment.as_masks((labels, "f", "s"))[1:] == ("f", "s", None) and segment.as_masks((labels, "f", "s", [2, 4]))[3] == 3.0
    with pytest.raises(ValueError):
        segment.as_masks((labels,) * 5)


# --- planning, guards, files ------------------------------------------------------------------------------------------


def test_replanning():
    asked = []

    def run(tile):
        asked.append(tile)
        if tile > 600:
            raise RuntimeError("CUDA out of memory")
        return "done"

    assert replan.run_with_replan(run, 4096) == ("done", asked[-1]) and asked == sorted(asked, reverse=True) and len(set(asked)) == len(asked)
    with pytest.raises(KeyError):
        replan.run_with_replan(lambda t: {}[t], 4096)
    with pytest.raises(MemoryError):
        replan.run_with_replan(lambda t: (_ for _ in ()).throw(MemoryError()), 256)
    fails = lambda: (_ for _ in ()).throw(RuntimeError("Java heap space"))
    assert replan.whole_or_tiled(fails, lambda: 2, 10, 10, 2, 1.0) == 2 and replan.whole_or_tiled(lambda: 1, fails, 10, 10, 2, 1.0) == 1
    assert replan.whole_or_tiled(fails, lambda: 2, 10**5, 10**5, 2, 16.0) == 2


def test_plan_scalars(spark):
    assert scalars.memory_limit(64, 16) == 16 and scalars.memory_limit(64) == 64
    assert scalars.needs_tiles(10**5, 10**5, 2, 64) and not scalars.needs_tiles(1000, 1000, 2, 64)
    assert scalars.initial_estimate(10**6) == (0.5, 2.0) and scalars.initial_estimate(15 * 10**6, gpu=True, tiled=True) == (1.1, pytest.approx(3.6))
    for tile in (4096, 1000, 300):
        assert 256 <= scalars.shrunk_tile(tile, 1.0, 3.0) < tile
    row = spark.sql("SELECT timestamp '2024-01-01 00:00:01.5' AS a, timestamp '2024-01-01 00:01:00' AS b, 10 AS n, 2.0 AS s, 3 * bigint(1073741824) AS v")
    got = row.select(scalars.elapsed(F.col("a"), F.col("b")), scalars.remaining(F.col("n"), F.col("s")), scalars.remaining(F.col("n"), F.col("s"), 4), scalars.gib(F.col("v"))).first()
    assert [float(x) for x in got] == [58.5, 20.0, 6.25, 3.0]


def test_guards_sums_and_order(spark):
    df = spark.createDataFrame([(1, "b", 2.0), (2, "a", 3.0), (3, "b", None)], "cell_id long, kind string, CD45 double")
    assert tables.guarded(df, ["cell_id"], ["CD45", "CD8a"]).columns == ["cell_id", "CD45"]
    with pytest.raises(ValueError, match="CD8a"):
        tables.guarded(df, ["CD8a"], [])
    assert rows(tables.filtered_sum(df, "CD45", "cell_id > 1", ("kind",))) == [("a", 3.0), ("b", 0.0)]
    assert [r.kind for r in tables.ordered_means(df, "kind", ["CD45"]).collect()] == ["a", "b"]
    v = spark.sql("SELECT array(named_struct('x', 0D, 'y', 0D), named_struct('x', 2D, 'y', 4D)) AS v")
    assert v.select(geometry.vertex_mean(F.col("v"), "x"), geometry.vertex_mean(F.col("v"), "y")).first()[:] == (1.0, 2.0)


def test_inputs_and_outputs(spark, tmp_path):
    markers = [r.marker for r in channels(spark).orderBy("channel_idx").collect()]
    for m in markers[:10]:
        (tmp_path / f"{m}.tif").write_text("x")
    lost, more = files.missing_inputs(spark, str(tmp_path))
    assert lost == markers[10:15] and more == 8
    assert files.first_existing([str(tmp_path / "no"), str(tmp_path)]) == str(tmp_path)
    with pytest.raises(FileNotFoundError):
        files.first_existing(["/no/such"])
    names = {m: f"{m}.tif" for m in markers}
    with pytest.raises(FileNotFoundError, match="and 8 more"):
        files.staged(names, [str(tmp_path)])
    assert files.staged({"DAPI": "DAPI.tif"}, ["/no", str(tmp_path)]) == {"DAPI": str(tmp_path / "DAPI.tif")}
    lines = spark.createDataFrame([("0, 11.5, card",), ("x, , ",), ("7",)], "value string")
    assert [tuple(r) for r in files.parse_lines(lines, "index int, used double, name string").collect()] == [(0, 11.5, "card"), (None, None, ""), (7, None, None)]
    df = spark.createDataFrame([(1, "a")], "cell_id long, kind string")
    out = str(tmp_path / "out")
    paths = exports.write_outputs({"cells.csv": df, "report.json": df, "leiden": df}, out)
    assert spark.read.option("header", True).csv(paths["cells.csv"]).first()[:] == ("1", "a") and spark.read.json(paths["report.json"]).count() == spark.read.parquet(paths["leiden"]).count() == 1
    assert exports.clean(spark, out, ["leiden", "nothing"]) == ["leiden"] and (tmp_path / "out" / "cells.csv").exists()
    with pytest.raises(ValueError):
        exports.clean(spark, out, ["../x"])
    assert exports.text_summary({"Cells": 12345, "Mean": 2.5, "Model": "a"}) == "Cells: 12,345\nMean: 2.50\nModel: a\n"


def test_late_rows_are_dropped_from_a_stream(spark, tmp_path):
    start = datetime(2024, 1, 1)
    row = lambda k, key: (start + timedelta(minutes=k), key)
    for n, batch in enumerate([[row(1, "a"), row(2, "a")], [row(60, "a")], [row(61, "a")], [row(1, "late"), row(62, "a")], [row(90, "a")], [row(91, "a")]]):
        spark.createDataFrame(batch, "ts timestamp, kind string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / str(n)))
    stream = spark.readStream.schema("ts timestamp, kind string").option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(str(tmp_path / "in" / "*"))
    query = ingest.windowed_counts(stream, "ts", "kind").writeStream.format("memory").queryName("counted").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = {(r.start, r.kind): r.n for r in spark.table("counted").collect()}
    assert got[start, "a"] == 2 and not any(k == "late" for _, k in got)


# --- neighbours and clusters ------------------------------------------------------------------------------------------


def test_neighbours_and_clusters_by_invariants(spark):
    r = np.random.default_rng(4)
    points = np.concatenate([r.normal(c, 5, (60, 3)) for c in ((0, 0, 0), (100, 0, 0), (0, 100, 100))] + [np.array([[900.0, 900, 900]])])
    cells = spark.createDataFrame([(k, *map(float, p)) for k, p in enumerate(points)], "cell_id long, a double, b double, c double")
    d = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    want = {k: set(np.argsort(d[k], kind="stable")[:5].tolist()) for k in range(len(points))}
    exact, near = {}, {}
    edges = spatial.nearest(cells, ["a", "b", "c"], 5, block=50)
    for out, df in ((exact, edges), (near, cluster.approximate_nearest(cells, ["a", "b", "c"], 5, reach=15.0))):
        for x in df.collect():
            out.setdefault(x.cell_id, set()).add(x.other)
    assert exact == want and all(len(near[k]) == 5 for k in want)
    assert sum(len(near[k] & want[k]) for k in want) >= 0.9 * 5 * len(want)
    found = cluster.communities(edges.where("cell_id < 180 and other < 180"))
    labels = {x.cell_id: x.cluster for x in found.collect()}
    assert all(len({labels[k] for k in range(60 * g, 60 * g + 60)} & {labels[k] for k in range(180) if k // 60 != g}) == 0 for g in range(3))
    assert cluster.modularity(edges, found) > 0.5
    k = {x.cell_id: x.cluster for x in cluster.kmeans(cells.where("cell_id < 180"), ["a", "b", "c"], 3).collect()}
    assert len(set(k.values())) == 3 and all(len({k[i] for i in range(60 * g, 60 * g + 60)}) == 1 for g in range(3))
    flat = np.array([(x.dim1, x.dim2) for x in cluster.embedding(cells, ["a", "b", "c"]).orderBy("cell_id").collect()])
    values = np.sort(np.linalg.eigvalsh(np.cov(points.T)))[::-1]
    assert np.allclose(flat.var(axis=0, ddof=1), values[:2])
