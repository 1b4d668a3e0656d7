"""Exports: GeoJSON, tab-separated measurements, JSON, HTML reports, FCS and a table layout of annotated data."""

from __future__ import annotations

import html
import struct
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def feature_lines(cells: DataFrame, properties: list[str]) -> DataFrame:
    """cell_id, feature: a GeoJSON point of each cell, one per line."""
    point = F.struct(F.lit("Point").alias("type"), F.array(F.col("x").cast("double"), F.col("y").cast("double")).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.col("cell_id").alias("id"), point.alias("geometry"), F.struct(*properties).alias("properties"))
    return cells.select("cell_id", F.to_json(feature).alias("feature"))


def region_features(regions: DataFrame) -> DataFrame:
    """region_id, feature: a GeoJSON polygon of each region, its ring closed."""
    v = F.col("vertices")
    ring: Column = F.when(F.element_at(v, 1) == F.element_at(v, -1), v).otherwise(F.concat(v, F.slice(v, 1, 1)))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(F.transform(ring, lambda p: F.array(p["x"], p["y"]))).alias("coordinates"))
    return regions.select("region_id", F.to_json(F.struct(F.lit("Feature").alias("type"), F.col("region_id").alias("id"), geometry.alias("geometry"))).alias("feature"))


def write_geojson(features: DataFrame, path: str) -> None:
    """A folder of text files with a feature per line."""
    features.select("feature").write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def write_annotated(cells: DataFrame, markers: list[str], path: str) -> None:
    """obs (per cell), var (per marker) and X (long values by marker) as Parquet."""
    spark = cells.sparkSession
    cells.drop(*markers).write.mode("overwrite").parquet(f"{path}/obs")
    spark.createDataFrame([(k, m) for k, m in enumerate(markers)], "var_idx int, marker string").write.mode("overwrite").parquet(f"{path}/var")
    cells.select("cell_id", *[F.col(m).cast("double").alias(m) for m in markers]).unpivot("cell_id", markers, "marker", "value").write.mode("overwrite").partitionBy("marker").parquet(f"{path}/X")


def report(title: str, tables: dict[str, DataFrame], most_rows: int = 200) -> str:
    """An HTML page of small tables; only the first most_rows of each are shown, which the page says."""
    out = [f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        rows = df.limit(most_rows + 1).collect()
        cell = lambda tag, v: f"<{tag}>{html.escape('' if v is None else str(v))}</{tag}>"
        out.append(f"<h2>{html.escape(name)}</h2><table><tr>{''.join(cell('th', c) for c in df.columns)}</tr>")
        out += [f"<tr>{''.join(cell('td', v) for v in r)}</tr>" for r in rows[:most_rows]]
        out.append("</table>" + ("<p>More rows follow.</p>" if len(rows) > most_rows else ""))
    return "".join([*out, "</body></html>"])


def fcs_bytes(names: list[str], rows: Iterator[tuple[float, ...]]) -> bytes:
    """An FCS 3.1 file of 32-bit floats, little-endian."""
    data, n, top = bytearray(), 0, [0.0] * len(names)
    for r in rows:
        data += struct.pack(f"<{len(names)}f", *r)
        n += 1
        top = [max(a, b) for a, b in zip(top, r)]
    pairs = {"$BEGINANALYSIS": "0", "$ENDANALYSIS": "0", "$BEGINSTEXT": "0", "$ENDSTEXT": "0", "$BYTEORD": "1,2,3,4", "$DATATYPE": "F", "$MODE": "L", "$NEXTDATA": "0", "$PAR": str(len(names)), "$TOT": str(n)}
    for k, name in enumerate(names, 1):
        pairs |= {f"$P{k}N": name.replace("|", "||"), f"$P{k}B": "32", f"$P{k}E": "0,0", f"$P{k}R": str(max(1, int(top[k - 1]) + 1))}
    text = lambda first, last: ("|" + "".join(f"{a}|{b}|" for a, b in (pairs | {"$BEGINDATA": f"{first:>12}", "$ENDDATA": f"{last:>12}"}).items())).encode()
    begin = 58 + len(text(0, 0))
    end = begin + max(len(data), 1) - 1
    body = text(begin, end)
    fits = end < 10**8
    header = "FCS3.1    " + "".join(f"{v:>8}" for v in (58, 58 + len(body) - 1, begin if fits else 0, end if fits else 0, 0, 0))
    return header.encode() + body + bytes(data)


def write_fcs(df: DataFrame, columns: list[str], path: str) -> None:
    """One file on the driver; rows stream through it by partition."""
    rows = (tuple(float(v) if v is not None else 0.0 for v in r) for r in df.select(*columns).toLocalIterator())
    with open(path, "wb") as f:
        f.write(fcs_bytes(columns, rows))


def text_summary(values: dict[str, object]) -> str:
    """Lines `name: value` of a run's summary, figures with thousands separators."""
    shown = lambda v: f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else f"{v:,.2f}" if isinstance(v, float) else str(v)
    return "\n".join(f"{k}: {shown(v)}" for k, v in values.items()) + "\n"


def write_outputs(outputs: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Each table as <folder>/<name>: CSV folders for .csv names, JSON lines for .json, Parquet for all others; where each is."""
    paths = {}
    for name, df in outputs.items():
        path = f"{folder.rstrip('/')}/{name}"
        if name.endswith(".csv"):
            write_csv(df, path)
        elif name.endswith(".json"):
            df.write.mode("overwrite").json(path)
        else:
            df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def clean(spark, folder: str, names: list[str]) -> list[str]:
    """Delete the named outputs of a folder and nothing else; those that were there. Names that lead out of it are an error."""
    gone = []
    for name in names:
        if not name or name.startswith("/") or ".." in name.split("/"):
            raise ValueError(f"{name!r} isn't a name inside the folder")
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
        if path.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(path, True):
            gone.append(name)
    return gone
