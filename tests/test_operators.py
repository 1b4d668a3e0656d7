"""Operators on small frames: hand-computed results, nulls, ties, empty tables, and properties."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera import config
from tessera.functions import scalars
from tessera.operators import geometry, normalize, segment, spatial, tables, tiles, typing_rules
from tessera.plans.pipeline import Pipeline
from tessera.schema import CHANNELS, PANEL, RULES, canonical, no_nan
from tessera.sinks import exports
from tessera.sources import files, tiff
from tessera.streaming import ingest


def sweep(length, tile, overlap):
    """Tiles of one axis, placed one after another."""
    out, start = [], 0
    while True:
        end = min(start + tile, length)
        out.append((max(0, end - tile), end))
        if end == length:
            return out
        start += tile - overlap


def test_golden_tables():
    assert len(CHANNELS) == 23 and len(set(PANEL)) == 23 and len(RULES) == 19
    evaluable = [c[0] for c in typing_rules.conditions(measured=["DAPI", "CD45", "CD3E", "CD8a", "CD20", "CD68", "PANCK", "EPCAM", "VIM", "Ki67"]) if c[-1]]
    assert evaluable == [1, 2, 3, 4, 6, 8, 17]


@pytest.mark.parametrize("length,tile,overlap", [(512, 200, 51), (100, 200, 10), (200, 200, 0), (1000, 256, 100), (997, 100, 99)])
def test_tiles_equal_a_sweep(spark, length, tile, overlap):
    want = sweep(length, tile, overlap)
    got = tiles.plan_tiles(spark, length, 50, (tile, 50), overlap if overlap < 50 else 0) if overlap < 50 else None
    assert tiles.axis_count(length, tile, overlap) == len(want)
    if got is not None:
        assert [(r.y0, r.y1) for r in got.orderBy("tile_id").collect()] == want
        cores = [(r.cy0, r.cy1) for r in got.orderBy("tile_id").collect()]
        assert cores[0][0] == 0 and cores[-1][1] == length and all(b >= c for (_, b), (c, _) in zip(cores, cores[1:]))


def test_overlap_of_a_tile_is_rejected():
    for call in (lambda: tiles.axis_count(500, 100, 100), lambda: scalars.manual_overlap(300, 256), lambda: scalars.tile_size(10, 10, 1.0, model_gb=2)):
        with pytest.raises(ValueError):
            call()
    assert scalars.overlap(256) == 100 and scalars.overlap(150) == 75 and scalars.overlap(4096, diameter=80) == 160 and scalars.manual_overlap(0.5, 200) == 100


def test_last_tile_wins_with_background(spark):
    labels = spark.createDataFrame([(0, 0, 0, 5), (1, 0, 0, 0), (0, 0, 1, 5), (0, 0, 2, 3), (1, 0, 2, 3)], "tile_id long, y long, x long, label long")
    got = {(r.y, r.x): r.cell_id for r in tiles.stitch(labels).collect()}
    assert got == {(0, 1): 2, (0, 2): 3}  # tile 0: 3 -> 1, 5 -> 2; tile 1: 3 -> 3
    assert tiles.cell_count(tiles.stitch(labels)).first().n == 2
    assert tiles.merge_seams(tiles.stitch(labels)).collect()[0] == (2, 3)
    empty = labels.limit(0)
    assert tiles.stitch(empty).count() == 0 and tiles.cell_count(empty.withColumn("cell_id", F.col("label"))).first().n == 0


def test_radius_join_equals_nested_loop(spark):
    random.seed(3)
    pts = [(k, random.randint(-300, 300), random.randint(-300, 300)) for k in range(300)] + [(900, 0, 0), (901, 50, 0), (902, 0, 51), (903, None, 5)]
    df = spark.createDataFrame(pts, "cell_id long, x long, y long")
    want = {(a[0], b[0]) for a in pts[:-1] for b in pts[:-1] if a[0] < b[0] and (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 <= 2500}
    assert {(r.a, r.b) for r in spatial.radius_pairs(df, 50).collect()} == want
    assert (900, 901) in want and (900, 902) not in want
    assert spatial.radius_pairs(df.limit(0), 50).count() == 0


def test_documented_cells_are_25_apart(spark):
    df = spark.createDataFrame([(1, 1000, 2000), (2, 1020, 2015)], "cell_id long, x long, y long")
    assert spatial.radius_pairs(df, 25).first().d2 == 625 and spatial.radius_pairs(df, 24).count() == 0


def test_last_write_wins_both_ways(spark):
    rows = spark.createDataFrame([("a", "b", 1.0, 0), ("b", "a", 2.0, 1), ("a", "a", 3.0, 2), ("c", None, 9.0, 3)], "cell_type_1 string, cell_type_2 string, interaction_score double, row_idx long")
    scores = spatial.symmetric_scores(rows)
    m = {r.cell_type: r for r in spatial.interaction_matrix(scores, ["a", "b", "c"]).collect()}
    assert (m["a"]["a"], m["a"]["b"], m["b"]["a"], m["c"]["a"]) == (3.0, 2.0, 2.0, 0.0)


def test_means_drop_null_types_and_nan(spark):
    df = spark.createDataFrame([(1, "t", 1.0), (2, "t", float("nan")), (3, None, 5.0), (4, "t", None)], "cell_id long, refined string, CD45 double")
    assert [tuple(r) for r in tables.mean_by_type(df, "refined").collect()] == [("t", 1.0)]
    assert no_nan(df).where("CD45 is null").count() == 2
    assert canonical(df.withColumnsRenamed({"cell_id": "CellID", "refined": "leiden_refined"})).columns == ["cell_id", "refined", "CD45"]


def test_z_norm_of_a_constant_is_zero(spark):
    df = spark.createDataFrame([(1, "m", 2.0), (2, "m", 2.0), (3, "n", 1.0), (4, "n", 3.0), (5, "n", None)], "cell_id long, marker string, raw double")
    got = {r.cell_id: r.norm for r in normalize.z_norm(df).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: -1.0, 4: 1.0, 5: None}


def test_positional_join_truncates(spark):
    a = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(10, "x"), (20, "y")], "k int, w string")
    got = tables.positional_join(a, b, ["k"], ["k"]).orderBy("row_idx").select("k_x", "v", "k_y", "w").collect()
    assert [tuple(r) for r in got] == [(1, "a", 10, "x"), (2, "b", 20, "y")]


def test_polygons(spark):
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    rings = [(1, square), (2, square + square[:1]), (3, square[2:] + square[:2])]
    df = spark.createDataFrame([(k, [{"x": x, "y": y} for x, y in v]) for k, v in rings], "region_id int, vertices array<struct<x:double,y:double>>")
    assert {(r.a, r.p) for r in df.select(geometry.area(F.col("vertices")).alias("a"), geometry.perimeter(F.col("vertices")).alias("p")).collect()} == {(100.0, 40.0)}
    pts = spark.createDataFrame([(1, 5.0, 5.0), (2, 10.5, 5.0), (3, 0.0, 0.0), (4, None, 1.0)], "cell_id long, x double, y double")
    assert sorted((r.cell_id, r.region_id) for r in geometry.points_in_polygons(pts, df, 4.0).collect()) == [(c, r) for c in (1, 3) for r in (1, 2, 3)]
    f = json.loads(exports.region_features(df).where("region_id = 1").first().feature)
    assert f["geometry"]["coordinates"][0][0] == f["geometry"]["coordinates"][0][-1]


def test_typing_by_hand(spark):
    levels = spark.createDataFrame([(1, "PANCK", "high"), (1, "EPCAM", "high"), (1, "CD45", "low"), (2, "Ki67", "high"), (2, "PANCK", "low"), (3, "CD45", "medium")], "cell_id long, marker string, level string")
    got = {r.cell_id: (r.rule, r.cell_type, r.confidence) for r in typing_rules.assign_types(levels).where("ref_id = 1").collect()}
    assert got == {1: (1, "panck_positive", 100.0), 2: (17, "ki67_positive", 100.0), 3: (0, "unassigned", 0.0)}


def test_nearest_in_blocks_equals_one_block(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(k, *map(int, rng.integers(0, 20, 3))) for k in range(120)], "cell_id long, a long, b long, c long")
    one, many = (sorted(map(tuple, spatial.nearest(df, ["a", "b", "c"], 4, n).collect())) for n in (1000, 17))
    assert one == many and len(one) == 480


def test_durations_and_config(spark):
    got = [r.d for r in spark.createDataFrame([(5.25,), (90.0,), (7325.0,)], "s double").select(scalars.duration(F.col("s")).alias("d")).collect()]
    assert got == ["5.3 seconds", "1.5 minutes", "2 hours 2 minutes"]
    c = config.parse_config("# x\nlog_norm: 'no'\ninteraction_radius: 40  # px\nother: 1\n")
    assert (c.log_norm, c.interaction_radius, c.max_cell_area) == (False, 40, 5000)


def test_ragged_rules_markers_and_regions(spark, tmp_path):
    (tmp_path / "r.csv").write_text("ref_ID,cell_group,cell_type,cell_subtype,rank_filter,min_confidence,marker1,rule1,marker2,rule2,marker3,rule3\n1,p,any,ki,positive_only,20,Ki67,high\n2,i,a,h,positive_only,20,HLADR,high,CD45,high")
    assert [len(r.conditions) for r in files.read_rules(spark, str(tmp_path / "r.csv")).orderBy("ref_id").collect()] == [1, 2]
    (tmp_path / "m.txt").write_text("DAPI\\nCD45\nKi67\n")
    assert [r.marker for r in files.read_markers(spark, str(tmp_path / "m.txt")).collect()] == ["DAPI", "CD45", "Ki67"]
    script = "// Region 7 (area: 100)\npoints = [new Point2(0, 0), new Point2(10,0), new Point2(10, 10), new Point2(0, 10)]\na.setName('Region_7')\n"
    (tmp_path / "a.groovy").write_text(script + script)
    r = files.read_regions(spark, str(tmp_path / "a.groovy")).select("region_id", "declared_area", geometry.area(F.col("vertices")).alias("a")).collect()
    assert [tuple(x) for x in r] == [(7, 100.0, 100.0)]
    (tmp_path / "x.xml").write_text("<Annotations><Region Id='3' Area='50'><Vertices><Vertex X='0' Y='0'/><Vertex X='10' Y='0'/><Vertex X='0' Y='10'/></Vertices></Region></Annotations>")
    assert files.read_annotations(spark, str(tmp_path / "x.xml")).select(geometry.area(F.col("vertices")).alias("a")).first().a == 50.0


def test_tiff_windows_segmentation_and_stitching(spark, tmp_path):
    image = np.zeros((300, 260), dtype=np.uint16)
    image[10:20, 10:30] = 500
    image[140:160, 120:150] = 700
    image[290:300, 250:260] = 900
    path = str(tmp_path / "a.tif")
    tiff.write_tiff(path, [image, image + 1], rows_per_strip=64)
    tiff.register(spark)
    assert [(r.height, r.width, r.dtype) for r in spark.read.format("tiff_pages").load(path).collect()] == [(300, 260, "<u2")] * 2
    t = spark.read.format("tiff_tiles").option("page", 0).option("tile", 128).option("overlap", 20).load(path)
    for r in t.collect():
        assert (np.frombuffer(r.data, dtype=r.dtype).reshape(r.h, r.w) == image[r.y0 : r.y0 + r.h, r.x0 : r.x0 + r.w]).all()
    runs = segment.segment_tiles(t, segment.baseline(100))
    labels = runs.select("tile_id", "y", F.explode(F.sequence("x0", F.col("x1") - 1)).alias("x"), "label")
    full = tiles.on_tiles(spark.range(300).crossJoin(spark.range(260).withColumnRenamed("id", "x")).withColumnRenamed("id", "y"), 300, 260, (128, 128), 20, only_core=True)
    cores = full.join(labels, ["tile_id", "y", "x"], "left").na.fill(0, ["label"])
    st = tiles.stitch(cores)
    assert st.count() == int((image > 0).sum())
    assert tiles.zonal(st, st.select("y", "x", F.lit(1).alias("v")), "v").agg(F.sum("area")).first()[0] == int((image > 0).sum())


def test_components_and_npy(spark, tmp_path):
    m = np.array([[1, 1, 0, 1], [0, 1, 0, 1], [1, 0, 0, 1]], dtype=bool)
    assert segment.components(m).tolist() == [[1, 1, 0, 2], [0, 1, 0, 2], [3, 0, 0, 2]]
    np.save(tmp_path / "m.npy", np.array([[0, 1, 1], [2, 2, 2]], dtype=np.uint32))
    spark.dataSource.register(files.NpyMask)
    runs = spark.read.format("npy_mask").option("rows", 1).load(str(tmp_path / "m.npy"))
    assert sorted(map(tuple, runs.collect())) == [(0, 1, 3, 1), (1, 0, 3, 2)]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0, 3.0, 7), (2, 4.0, 5.0, None)], "cell_id long, x double, y double, CD45 int")
    exports.write_fcs(df, ["x", "y", "CD45"], str(tmp_path / "a.fcs"))
    raw = (tmp_path / "a.fcs").read_bytes()
    begin, end = int(raw[26:34]), int(raw[34:42])
    assert raw[:6] == b"FCS3.1" and np.frombuffer(raw[begin : end + 1], "<f4").tolist() == [2.0, 3.0, 7.0, 4.0, 5.0, 0.0]
    assert "<td>7</td>" in exports.report("r", {"cells": df})
    exports.write_annotated(df, ["CD45"], str(tmp_path / "ann"))
    assert spark.read.parquet(str(tmp_path / "ann" / "X")).count() == 2


def test_ingest_takes_new_files_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("CellID,X,Y\n1,2,3\n")
    args = (str(tmp_path / "out"), str(tmp_path / "cp"))
    stream = lambda: ingest.cell_stream(spark, str(src), "CellID long, X double, Y double")
    ingest.ingest(stream(), *args)
    (src / "b.csv").write_text("CellID,X,Y\n2,2,3\n")
    ingest.ingest(stream(), *args)
    assert sorted(r.cell_id for r in spark.read.parquet(args[0]).collect()) == [1, 2]


def test_pipeline_stages(spark):
    rng = np.random.default_rng(1)
    rows = [(k, int(rng.integers(0, 200)), int(rng.integers(0, 200)), *map(int, rng.integers(0, 1000, 10))) for k in range(60)]
    from tessera.schema import MEASURED

    cells = spark.createDataFrame(rows, "cell_id long, x long, y long, " + ", ".join(f"{m} long" for m in MEASURED))
    p = Pipeline(spark, cells, config.RunConfig(kmeans_clusters=3))
    assert p.stage("export").count() == 60 and p.stage("interactions").count() > 0 and p.lineage().count() > 5
    assert p.stage("normalized").where("marker = 'DAPI'").agg(F.abs(F.avg("norm"))).first()[0] < 1e-9
    with pytest.raises(KeyError):
        p.stage("nothing")
