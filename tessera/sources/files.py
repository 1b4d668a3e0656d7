"""Cell tables, rule and marker files, region polygons, annotations, label masks and input checks."""

from __future__ import annotations

import re
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..schema import RULE_CSV, canonical, channels

REGION_SCHEMA = "region_id int, name string, path_class string, declared_area double, vertices array<struct<x:double,y:double>>"


def read_cells(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV cell table with a header, under canonical names; malformed fields are null."""
    return canonical(spark.read.schema(schema).option("header", True).csv(path))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Cell-type rules; rows with fewer fields than the header keep the conditions that they have."""
    rows = spark.read.schema(RULE_CSV).option("header", True).option("mode", "PERMISSIVE").csv(path)
    pairs = F.array(*[F.struct(F.col(f"marker{k}").alias("marker"), F.col(f"rule{k}").alias("level")) for k in (1, 2, 3)])
    return rows.select("ref_id", "cell_group", "cell_type", "cell_subtype", "rank_filter", "min_confidence", F.filter(pairs, lambda c: c["marker"].isNotNull()).alias("conditions"))


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    """marker: a name per line, also where lines are separated by a written-out backslash and n."""
    return spark.read.text(path).select(F.explode(F.split("value", r"\\n|\n")).alias("marker")).select(F.trim("marker").alias("marker")).where("marker <> ''")


def missing_inputs(spark: SparkSession, folder: str, suffix: str = ".tif", most: int = 5) -> tuple[list[str], int]:
    """The first `most` channels without a file, and how many more there are."""
    found = spark.createDataFrame([(p.stem,) for p in Path(folder).glob(f"*{suffix}")], "marker string")
    lost = [r.marker for r in channels(spark).join(found, "marker", "left_anti").orderBy("channel_idx").select("marker").collect()]
    return lost[:most], max(0, len(lost) - most)


def first_existing(candidates: list[str]) -> str:
    for p in candidates:
        if Path(p).exists():
            return p
    raise FileNotFoundError(f"none of {candidates}")


def staged(expected: dict[str, str], folders: list[str]) -> dict[str, str]:
    """Where each expected input (name -> file name) stands: the first of the folders that holds it. Nothing is copied or linked.

    Missing ones are an error that names the first five and how many more there are.
    """
    found = {}
    for n, f in expected.items():
        places = [Path(d) / f for d in folders]
        if at := next((p for p in places if p.exists()), None):
            found[n] = str(at)
    if lost := [n for n in expected if n not in found]:
        raise FileNotFoundError(", ".join(lost[:5]) + (f" and {len(lost) - 5} more" if len(lost) > 5 else ""))
    return found


def parse_lines(lines: DataFrame, schema: str, column: str = "value", sep: str = ", ") -> DataFrame:
    """Fields of separated lines, such as a tool's report, under a schema `name type, ...`; what can't be read is null."""
    fields = [f.split(None, 1) for f in schema.split(",")]
    parts = F.split(column, re.escape(sep))
    return lines.select(*[F.get(parts, F.lit(k)).alias(f"_{k}") for k in range(len(fields))]).select(*[F.expr(f"try_cast(trim(_{k}) as {kind.strip()})").alias(name) for k, (name, kind) in enumerate(fields)])


POINT = re.compile(r"new\s+Point2\(\s*([-\d.eE]+)\s*,\s*([-\d.eE]+)\s*\)")
HEADING = re.compile(r"//\s*Region\s+(\d+)[^\n]*?\barea\b\D*([\d.,]+)", re.I)
NAMED = re.compile(r"Region_(\d+)")


def parse_regions(text: str) -> list[tuple]:
    """Polygons of a viewer script: each run of point literals, with the region's number and area from the comment before."""
    out, start = [], 0
    for m in NAMED.finditer(text):
        part = text[start : m.start()]
        points = [(float(a), float(b)) for a, b in POINT.findall(part)]
        if points:
            heads = HEADING.findall(part)
            area = float(heads[-1][1].replace(",", "")) if heads else None
            out.append((int(m[1]), f"Region_{m[1]}", "Region", area, points))
            start = m.end()
    return out


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Regions of all scripts of a folder or glob; a region that comes twice is kept once."""
    rows = spark.read.text(path, wholetext=True).select("value")

    kind = pa.schema([("region_id", pa.int32()), ("name", pa.string()), ("path_class", pa.string()), ("declared_area", pa.float64()), ("vertices", pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))])

    def run(batches):
        for b in batches:
            got = [r for t in b.column(0).to_pylist() for r in parse_regions(t)]
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, (*r[:4], [{"x": x, "y": y} for x, y in r[4]]))) for r in got], schema=kind)

    return rows.mapInArrow(run, REGION_SCHEMA).dropDuplicates(["region_id"])


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """Regions of an annotation XML file: Region elements with Id, Area and Vertices/Vertex X and Y."""
    schema = "_Id int, _Area double, Vertices struct<Vertex:array<struct<_X:double,_Y:double>>>"
    rows = spark.read.format("xml").option("rowTag", "Region").schema(schema).load(path)
    return rows.select(F.col("_Id").alias("region_id"), F.concat(F.lit("Region_"), F.col("_Id").cast("string")).alias("name"), F.lit("Region").alias("path_class"), F.col("_Area").alias("declared_area"), F.transform("Vertices.Vertex", lambda v: F.struct(v["_X"].alias("x"), v["_Y"].alias("y"))).alias("vertices"))


@dataclass
class Rows(InputPartition):
    first: int
    last: int


class NpyReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.rows = options["path"], int(options.get("rows", 1024))

    def partitions(self):
        n = np.load(self.path, mmap_mode="r").shape[0]
        return [Rows(y, min(n, y + self.rows)) for y in range(0, n, self.rows)]

    def read(self, part):
        mask = np.load(self.path, mmap_mode="r")
        for y in range(part.first, part.last):
            row = np.asarray(mask[y])
            cuts = np.flatnonzero(np.diff(row)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(row)]):
                if b > a and row[a]:
                    yield y, a, b, int(row[a])


class NpyMask(DataSource):
    """A label mask as run-length rows; options path and rows (of a partition)."""

    @classmethod
    def name(cls):
        return "npy_mask"

    def schema(self):
        return "y int, x0 int, x1 int, cell_id long"

    def reader(self, schema):
        return NpyReader(self.options)
