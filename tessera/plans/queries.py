"""The queries over the driver's tables, and the SQL that each must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import cluster, geometry, normalize, spatial, tables, tiles, typing_rules
from ..schema import CHANNELS, MEASURED, PANEL, channels
from ..sinks.exports import feature_lines
from ..streaming import ingest
from . import views
from .pipeline import Pipeline
from .views import CELLS, INTERACTIONS, PIXELS, long_sql

QUERIES: dict = {}
ORACLES: dict = {}
TYPES = list(range(10))
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c, t in df.dtypes if t == "double"})


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "


# --- aggregates and reshaping -------------------------------------------------------------------------------------


@query("a01_mean_by_type", with_(CELLS) + "SELECT cluster, " + ", ".join(f'round(avg("{m}"), 6) AS "{m}"' for m in MEASURED) + " FROM cells GROUP BY cluster")
def _(s, d):
    return rounded(tables.mean_by_type(views.cells(s, d).select("cell_id", "cluster", *MEASURED), "cluster"))


@query("v02_p14_marker_heatmap", with_(CELLS, long_sql(MEASURED)) + "SELECT marker, " + ", ".join(f'round(avg(raw) FILTER (cluster = {t}), 6) AS "{t}"' for t in TYPES) + " FROM long GROUP BY marker")
def _(s, d):
    return rounded(tables.transposed_means(views.cells(s, d), "cluster", TYPES, MEASURED))


@query("p08_measurements", with_(CELLS, long_sql(MEASURED)) + "SELECT cell_id, marker, raw FROM long")
def _(s, d):
    return tables.measurements(views.cells(s, d), MEASURED)


@query("a09_cluster_size", with_(CELLS) + "SELECT cell_id, cluster, count(*) OVER (PARTITION BY cluster) AS cluster_size FROM cells")
def _(s, d):
    return tables.cluster_sizes(views.cells(s, d).select("cell_id", "cluster"))


@query("a14_proportions", with_(CELLS) + "SELECT cluster, count(*) AS cells, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM cells GROUP BY cluster")
def _(s, d):
    return rounded(tables.proportions(views.cells(s, d), "cluster"))


@query("a15_summary_statistics", with_(CELLS, long_sql(MEASURED)) + "SELECT marker, count(raw) AS n, round(avg(raw), 6) AS mean, round(stddev_pop(raw), 6) AS sd, min(raw) AS least, max(raw) AS most, round(quantile_cont(raw, 0.5), 6) AS median FROM long GROUP BY marker")
def _(s, d):
    return rounded(tables.summary(tables.measurements(views.cells(s, d), MEASURED)))


@query("p13_j04_catalogue", with_(CELLS, long_sql(MEASURED), "cat(channel_idx, source_name, marker, category) AS (VALUES " + ", ".join(str(c) for c in CHANNELS) + ")") + "SELECT source_name, category, count(*) AS n, cast(sum(raw) AS bigint) AS total FROM long JOIN cat USING (marker) GROUP BY source_name, category")
def _(s, d):
    long = tables.measurements(views.cells(s, d), MEASURED)
    return long.join(F.broadcast(channels(s)), "marker").groupBy("source_name", "category").agg(F.count(F.lit(1)).alias("n"), F.sum("raw").cast("long").alias("total"))


@query("j11_l01_missing_inputs", "WITH cat(channel_idx, source_name, marker, category) AS (VALUES " + ", ".join(str(c) for c in CHANNELS) + ") SELECT channel_idx, marker FROM cat WHERE marker NOT IN (" + ", ".join(f"'{m}'" for m in MEASURED) + ") ORDER BY channel_idx LIMIT 5")
def _(s, d):
    found = s.createDataFrame([(m,) for m in MEASURED], "marker string")
    return tables.missing(channels(s), found, "marker").select("channel_idx", "marker").orderBy("channel_idx").limit(5)


# --- joins --------------------------------------------------------------------------------------------------------


@query(
    "j01_positional_join",
    "WITH a AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) - 1 AS row_idx FROM events), b AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx FROM orders) "
    "SELECT row_idx, event_id, value, o_orderkey, o_totalprice FROM a JOIN b USING (row_idx)",
)
def _(s, d):
    return tables.positional_join(views.table(s, d, "events").select("event_id", "value"), views.table(s, d, "orders").select("o_orderkey", "o_totalprice"), ["event_id"], ["o_orderkey"])


@query("j03_v01_umap_plot", with_(CELLS) + 'SELECT cell_id, x AS dim1, y AS dim2, cluster, "CD45", "PANCK", "Ki67" FROM cells')
def _(s, d):
    c = views.cells(s, d)
    umap = c.select("cell_id", F.col("x").alias("dim1"), F.col("y").alias("dim2"))
    return c.select("cell_id", "CD45", "PANCK", "Ki67").join(umap, "cell_id").join(c.select("cell_id", "cluster"), "cell_id")


# --- space --------------------------------------------------------------------------------------------------------

PAIRS = "pairs AS (SELECT a.cell_id AS a, b.cell_id AS b, a.cluster AS ca, b.cluster AS cb, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2 FROM cells a JOIN cells b ON a.cell_id < b.cell_id AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {r2})"
BOTH = "met AS (SELECT a AS cell_id, b AS other, cb AS cluster, d2 FROM pairs UNION ALL SELECT b, a, ca, d2 FROM pairs)"


@query("j06_radius_pairs", with_(CELLS, PAIRS.format(r2=2500)) + "SELECT a, b, d2 FROM pairs")
def _(s, d):
    return spatial.radius_pairs(views.cells(s, d), 50)


@query(
    "a11_interaction_score",
    with_(CELLS, PAIRS.format(r2=2500), "n AS (SELECT cluster, count(*) AS n FROM cells GROUP BY 1)")
    + "SELECT least(ca, cb) AS cell_type_1, greatest(ca, cb) AS cell_type_2, count(*) AS pairs, round(count(*) * (SELECT count(*) FROM cells) / (any_value(n1.n) * any_value(n2.n)), 6) AS interaction_score "
    "FROM pairs JOIN n n1 ON n1.cluster = least(ca, cb) JOIN n n2 ON n2.cluster = greatest(ca, cb) GROUP BY 1, 2",
)
def _(s, d):
    return spatial.interaction_scores(views.cells(s, d).select("cell_id", "x", "y", "cluster"), 50)


@query("a10_local_density", with_(CELLS, PAIRS.format(r2=10000), BOTH) + "SELECT cells.cell_id, count(other) AS neighbors, round(count(other) / (pi() * 10000), 9) AS local_density FROM cells LEFT JOIN met USING (cell_id) GROUP BY 1")
def _(s, d):
    return rounded(spatial.local_density(views.cells(s, d), 100), 9)


@query(
    "a12_neighbourhood_composition",
    with_(CELLS, PAIRS.format(r2=10000), BOTH) + "SELECT cell_id, count(*) AS total, " + ", ".join(f"round(count(*) FILTER (cluster = {t}) / count(*), 6) AS type_{t}" for t in TYPES) + " FROM met GROUP BY cell_id",
)
def _(s, d):
    return rounded(spatial.composition(views.cells(s, d), 100, TYPES))


@query(
    "a13_spatial_statistics",
    with_(CELLS, PAIRS.format(r2=10000), BOTH, "nn AS (SELECT cell_id, min(d2) AS d2 FROM met GROUP BY 1)")
    + "SELECT cluster, count(*) AS cells, round(avg(sqrt(d2)), 6) AS mean_nn, round(min(sqrt(d2)), 6) AS min_nn, "
    + ", ".join(f"(SELECT count(*) FROM pairs WHERE ca = cells.cluster AND cb = cells.cluster AND d2 <= {r * r}) AS pairs_{r}" for r in (25, 50, 100))
    + " FROM cells LEFT JOIN nn USING (cell_id) GROUP BY cluster",
)
def _(s, d):
    return rounded(spatial.spatial_stats(views.cells(s, d), (25, 50, 100)))


KNN = 'power(a."DAPI" - b."DAPI", 2)' + "".join(f' + power(a."{m}" - b."{m}", 2)' for m in MEASURED[1:])


@query(
    "j08_nearest_neighbours",
    with_(CELLS) + f"SELECT cell_id, other, rank, d2 FROM (SELECT a.cell_id, b.cell_id AS other, {KNN} AS d2, row_number() OVER (PARTITION BY a.cell_id ORDER BY {KNN}, b.cell_id) AS rank FROM cells a JOIN cells b ON a.cell_id <> b.cell_id) WHERE rank <= 15",
)
def _(s, d):
    return spatial.nearest(views.cells(s, d), MEASURED, 15)


SYMMETRIC = "sym AS (SELECT least(cell_type_1, cell_type_2) AS cell_type_1, greatest(cell_type_1, cell_type_2) AS cell_type_2, arg_max(interaction_score, row_idx) AS interaction_score FROM inter GROUP BY 1, 2)"


@query("w03_symmetric_scores", with_(INTERACTIONS, SYMMETRIC) + "SELECT * FROM sym")
def _(s, d):
    return spatial.symmetric_scores(views.interaction_rows(s, d))


@query(
    "a18_v03_interaction_matrix",
    with_(INTERACTIONS, SYMMETRIC, "m AS (SELECT cell_type_1 AS a, cell_type_2 AS b, interaction_score AS s FROM sym UNION SELECT cell_type_2, cell_type_1, interaction_score FROM sym)", "t(a) AS (VALUES " + ", ".join(f"('{e}')" for e in EVENT_TYPES) + ")")
    + "SELECT t.a AS cell_type, "
    + ", ".join(f"coalesce(max(s) FILTER (b = '{e}'), 0) AS \"{e}\"" for e in EVENT_TYPES)
    + " FROM t LEFT JOIN m ON t.a = m.a GROUP BY t.a",
)
def _(s, d):
    return spatial.interaction_matrix(spatial.symmetric_scores(views.interaction_rows(s, d)), EVENT_TYPES)


@query("u01_category_union", with_(INTERACTIONS) + "SELECT cell_type_1 AS category FROM inter UNION SELECT cell_type_2 FROM inter")
def _(s, d):
    return tables.category_union(views.interaction_rows(s, d), "cell_type_1", "cell_type_2")


# --- geometry -----------------------------------------------------------------------------------------------------

POLYGONS = {1: [(100, 100), (900, 150), (850, 1200), (500, 700), (120, 1000)], 2: [(800, 800), (1500, 850), (1450, 1500), (820, 1420), (800, 800)], 3: [(0, 1400), (700, 1300), (400, 1990)]}


def regions(s):
    return s.createDataFrame([(k, [(float(x), float(y)) for x, y in v]) for k, v in POLYGONS.items()], "region_id int, vertices array<struct<x:double,y:double>>")


EDGES = "edges(region_id, k, ax, ay, bx, bt) AS (VALUES " + ", ".join(f"({r}, {k}, {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for r, v in POLYGONS.items() for k, (a, b) in enumerate(zip(v, v[1:] + v[:1]))) + ")"


@query("f18_f19_polygon_measures", with_(EDGES) + "SELECT region_id, abs(sum(ax * bt - bx * ay)) / 2 AS area, round(sum(sqrt((ax - bx) * (ax - bx) + (ay - bt) * (ay - bt))), 6) AS perimeter, min(ax) AS min_x, max(ax) AS max_x, min(ay) AS min_y, max(ay) AS max_y, bool_or(ax = bx AND ay = bt) AS closed FROM edges GROUP BY region_id")
def _(s, d):
    v = F.col("vertices")
    b = geometry.bounds(v)
    return regions(s).select("region_id", geometry.area(v).alias("area"), F.round(geometry.perimeter(v), 6).alias("perimeter"), *[c.alias(n) for n, c in b.items()], geometry.is_closed(v).alias("closed"))


@query(
    "j09_point_in_polygon",
    with_(CELLS, EDGES) + "SELECT cell_id, region_id FROM cells JOIN edges ON (ay > y) <> (bt > y) AND x < (bx - ax) * (y - ay) / (bt - ay) + ax GROUP BY 1, 2 HAVING count(*) % 2 = 1",
)
def _(s, d):
    return geometry.points_in_polygons(views.cells(s, d), regions(s))


# --- normalisation ------------------------------------------------------------------------------------------------


@query("f15_f16_w05_log_z_norm", with_(CELLS, long_sql(MEASURED), "l AS (SELECT *, ln(1 + greatest(raw, 0)) AS v FROM long)") + "SELECT cell_id, marker, round((v - avg(v) OVER (PARTITION BY marker)) / stddev_pop(v) OVER (PARTITION BY marker), 5) AS norm FROM l")
def _(s, d):
    return rounded(normalize.z_norm(normalize.log_norm(tables.measurements(views.cells(s, d), MEASURED), out="v"), "v").select("cell_id", "marker", "norm"), 5)


@query(
    "p11_percentile_clip",
    with_(CELLS, long_sql(MEASURED), "q AS (SELECT marker, quantile_cont(raw, 0.01) AS a, quantile_cont(raw, 0.99) AS b FROM long GROUP BY 1)") + "SELECT cell_id, marker, round(least(greatest(raw, a), b), 6) AS norm FROM long JOIN q USING (marker)",
)
def _(s, d):
    return rounded(normalize.clip(tables.measurements(views.cells(s, d), MEASURED)).select("cell_id", "marker", "norm"))


@query(
    "a19_quantile_norm",
    with_(CELLS, long_sql(MEASURED), "r AS (SELECT *, row_number() OVER (PARTITION BY marker ORDER BY raw, cell_id) AS k FROM long)", "m AS (SELECT k, avg(raw) AS norm FROM r GROUP BY 1)") + "SELECT cell_id, marker, round(norm, 6) AS norm FROM r JOIN m USING (k)",
)
def _(s, d):
    return rounded(normalize.quantile_norm(tables.measurements(views.cells(s, d), MEASURED)).select("cell_id", "marker", "norm"))


@query("p12_balance_tiles", with_(PIXELS) + "SELECT y, x, round(v * (SELECT avg(v) FROM pixels) / avg(v) OVER (PARTITION BY (y // 64) * 8 + x // 64), 4) AS balanced FROM pixels")
def _(s, d):
    p = views.pixels(s, d).withColumn("tile", F.floor(F.col("y") / 64) * 8 + F.floor(F.col("x") / 64))
    return rounded(normalize.balance_tiles(p, "tile", "v").select("y", "x", "balanced"), 4)


# --- typing -------------------------------------------------------------------------------------------------------


def _typing_sql(markers: list[str] = MEASURED) -> str:
    rules = typing_rules.conditions(measured=markers)
    level = lambda m: f"max(level) FILTER (marker = '{m}')"
    wanted = sorted({m for r in rules if r[-1] for m, _ in r[7]})
    rows = []
    for row, ref, _, _, sub, _, least, pairs, ok in rules:
        if ok:
            met = " + ".join(f"CASE WHEN m_{m} = '{v}' THEN 1 ELSE 0 END" for m, v in pairs)
            rows.append(f"SELECT cell_id, {ref} AS ref_id, {row} AS rule, '{sub}' AS cell_type, round(100.0 * ({met}) / {len(pairs)}, 6)::DOUBLE AS confidence FROM w WHERE m_{pairs[0][0]} = 'high' AND round(100.0 * ({met}) / {len(pairs)}, 6) >= {least}")
    return with_(
        CELLS,
        long_sql(markers),
        "q AS (SELECT marker, quantile_cont(raw, 1.0::DOUBLE / 3) AS a, quantile_cont(raw, 2.0::DOUBLE / 3) AS b FROM long GROUP BY 1)",
        "lv AS (SELECT cell_id, marker, CASE WHEN raw >= b THEN 'high' WHEN raw <= a THEN 'low' ELSE 'medium' END AS level FROM long JOIN q USING (marker))",
        "w AS (SELECT cell_id, " + ", ".join(f"{level(m)} AS m_{m}" for m in wanted) + " FROM lv GROUP BY 1)",
        "c AS (" + " UNION ALL ".join(rows) + ")",
        "best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cell_id, ref_id ORDER BY confidence DESC, rule) AS k FROM c) WHERE k = 1)",
        "typed AS (SELECT l.cell_id, l.ref_id, coalesce(rule, 0) AS rule, coalesce(cell_type, 'unassigned') AS cell_type, coalesce(confidence, 0) AS confidence FROM (SELECT cell_id, unnest([1, 2]) AS ref_id FROM cells) l LEFT JOIN best USING (cell_id, ref_id))",
    )


def typed(s, d, markers=MEASURED):
    return typing_rules.assign_types(typing_rules.marker_levels(tables.measurements(views.cells(s, d), markers)), measured=markers)


@query("ml04_j12_cell_types", _typing_sql() + "SELECT cell_id, ref_id, rule, cell_type, confidence FROM typed")
def _(s, d):
    return typed(s, d)


@query("a16_typing_report", _typing_sql() + "SELECT ref_id, cell_type, count(*) AS cells, round(avg(confidence), 6) AS mean_confidence FROM typed GROUP BY 1, 2")
def _(s, d):
    return typing_rules.typing_report(typed(s, d))


# --- tiles --------------------------------------------------------------------------------------------------------

H = W = 512
TILE, OVERLAP = 200, 51
N = tiles.axis_count(H, TILE, OVERLAP)
AXIS = f"ax AS (SELECT i, greatest(0, least(i * {TILE - OVERLAP} + {TILE}, {H}) - {TILE}) AS a, least(i * {TILE - OVERLAP} + {TILE}, {H}) AS b FROM range({N}) r(i)), axis AS (SELECT *, CASE WHEN a > 0 THEN a + {OVERLAP // 2} ELSE a END AS ca, CASE WHEN b < {H} THEN b - {OVERLAP // 2} ELSE b END AS cb FROM ax)"
LABELS = f"labels AS (SELECT p.y, p.x, u.i * {N} + t.i AS tile_id, (p.v + u.i) % 9 AS label FROM pixels p JOIN axis u ON p.y >= u.ca AND p.y < u.cb JOIN axis t ON p.x >= t.ca AND p.x < t.cb)"
STITCH = (
    "ren AS (SELECT tile_id, label, row_number() OVER (ORDER BY tile_id, label) AS cell_id FROM (SELECT DISTINCT tile_id, label FROM labels WHERE label > 0)), "
    "won AS (SELECT y, x, max(tile_id) AS tile_id, arg_max(label, tile_id) AS label FROM labels GROUP BY 1, 2), st AS (SELECT y, x, cell_id FROM won JOIN ren USING (tile_id, label))"
)


@query("t01_tiles", with_(AXIS) + f"SELECT u.i * {N} + t.i AS tile_id, u.a AS y0, u.b AS y1, t.a AS x0, t.b AS x1, u.ca AS cy0, u.cb AS cy1, t.ca AS cx0, t.cb AS cx1 FROM axis u, axis t")
def _(s, d):
    return tiles.plan_tiles(s, H, W, (TILE, TILE), OVERLAP)


@query("p06_j14_pixels_on_tiles", with_(PIXELS, AXIS) + f"SELECT u.i * {N} + t.i AS tile_id, count(*) AS n, cast(sum(v) AS bigint) AS total FROM pixels p JOIN axis u ON p.y >= u.a AND p.y < u.b JOIN axis t ON p.x >= t.a AND p.x < t.b GROUP BY 1")
def _(s, d):
    return tiles.on_tiles(views.pixels(s, d), H, W, (TILE, TILE), OVERLAP).groupBy("tile_id").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))


def labels(s, d):
    on = tiles.on_tiles(views.pixels(s, d), H, W, (TILE, TILE), OVERLAP, only_core=True)
    return on.select("y", "x", "tile_id", ((F.col("v") + F.floor(F.col("tile_id") / N)) % 9).alias("label"))


@query("w01_w02_stitch", with_(PIXELS, AXIS, LABELS, STITCH) + "SELECT y, x, cell_id FROM st")
def _(s, d):
    return tiles.stitch(labels(s, d))


@query("w01_renumber", with_(PIXELS, AXIS, LABELS, STITCH) + "SELECT tile_id, label, cell_id FROM ren")
def _(s, d):
    return tiles.renumber(labels(s, d))


@query("a04_labels_per_tile", with_(PIXELS, AXIS, LABELS) + "SELECT tile_id, count(DISTINCT label) AS labels FROM labels WHERE label > 0 GROUP BY 1")
def _(s, d):
    return labels(s, d).where("label > 0").groupBy("tile_id").agg(F.count_distinct("label").alias("labels"))


@query("a02_cell_count", with_(PIXELS, AXIS, LABELS, STITCH) + "SELECT count(DISTINCT cell_id) AS n FROM st")
def _(s, d):
    return tiles.cell_count(tiles.stitch(labels(s, d)))


@query(
    "a07_a08_zonal",
    with_(PIXELS, AXIS, LABELS, STITCH, "o AS (SELECT y, x, cell_id AS oid FROM st)", "nb(dy, dx) AS (VALUES (0, 1), (0, -1), (1, 0), (-1, 0))")
    + "SELECT cell_id, round(avg(v), 6) AS mean, count(*) AS area, round(avg(x), 6) AS x, round(avg(y), 6) AS y, any_value(p) AS perimeter FROM st JOIN pixels USING (y, x) "
    "JOIN (SELECT st.cell_id, count(*) FILTER (oid IS NULL OR oid <> st.cell_id) AS p FROM st CROSS JOIN nb LEFT JOIN o ON o.y = st.y + dy AND o.x = st.x + dx GROUP BY 1) USING (cell_id) GROUP BY cell_id",
)
def _(s, d):
    return rounded(tiles.zonal(tiles.stitch(labels(s, d)), views.pixels(s, d), "v"))


@query("m06_mask_runs", with_(PIXELS, AXIS, LABELS, STITCH, "g AS (SELECT *, x - row_number() OVER (PARTITION BY y, cell_id ORDER BY x) AS k FROM st)") + "SELECT y, cell_id, min(x) AS x0, max(x) + 1 AS x1 FROM g GROUP BY y, cell_id, k")
def _(s, d):
    return tiles.runs(tiles.stitch(labels(s, d)))


@query("a03_mean_diameter", "SELECT avg(l_quantity) AS mean_diameter FROM lineitem")
def _(s, d):
    return tiles.mean_diameter(views.table(s, d, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_quantity").alias("diams")), "diams")


# --- order, text, quality ------------------------------------------------------------------------------------------


@query(
    "w04_progress",
    "WITH e AS (SELECT event_id, user_id, cast(round(value * 100) AS bigint) AS cs FROM events) SELECT event_id, user_id, count(*) OVER w AS done, avg(cs) OVER w AS mean_s, avg(cs) OVER w * (count(*) OVER (PARTITION BY user_id) - count(*) OVER w) AS remaining_s FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)",
)
def _(s, d):
    e = views.table(s, d, "events").select("event_id", "user_id", F.round(F.col("value") * 100).cast("long").alias("cs"))  # whole numbers, so that sums are exact
    return tables.progress(e, "event_id", "cs", "user_id").select("event_id", "user_id", "done", "mean_s", "remaining_s")


@query(
    "f06_durations",
    "WITH t AS (SELECT o_orderkey, floor(o_totalprice) / 20 AS s FROM orders) SELECT o_orderkey, CASE WHEN s < 60 THEN cast(cast(floor(s * 10 + 0.5) / 10 AS decimal(20,1)) AS varchar) || ' seconds' WHEN s < 3600 THEN cast(cast(floor(s / 60 * 10 + 0.5) / 10 AS decimal(20,1)) AS varchar) || ' minutes' "
    "ELSE cast(cast(floor(s / 3600) AS bigint) AS varchar) || ' hours ' || cast(cast(floor((s - floor(s / 3600) * 3600) / 60) AS bigint) AS varchar) || ' minutes' END AS took FROM t",
)
def _(s, d):
    return views.table(s, d, "orders").select("o_orderkey", scalars.duration(F.floor("o_totalprice") / 20).alias("took"))


@query("w07_first_appearance", "SELECT event_type, row_number() OVER (ORDER BY min(event_id)) - 1 AS colour_idx FROM events GROUP BY event_type")
def _(s, d):
    return tables.first_appearance(views.table(s, d, "events"), "event_type", "event_id").withColumn("colour_idx", F.col("colour_idx").cast("long"))


@query("v04_spatial_plot", with_(CELLS, "k AS (SELECT cluster, row_number() OVER (ORDER BY min(cell_id)) - 1 AS colour_idx FROM cells GROUP BY 1)") + "SELECT cell_id, x, -y AS y, cluster, colour_idx FROM cells JOIN k USING (cluster)")
def _(s, d):
    c = views.cells(s, d)
    order = tables.first_appearance(c, "cluster", "cell_id").withColumn("colour_idx", F.col("colour_idx").cast("long"))
    return c.select("cell_id", "x", (-F.col("y")).alias("y"), "cluster").join(F.broadcast(order), "cluster")


@query("p09_a17_quality_control", "SELECT count(*) AS n, 0::BIGINT AS nulls, count(*) FILTER (p_size < 5) AS below, count(*) FILTER (p_size > 45) AS above, count(*) FILTER (p_size BETWEEN 5 AND 45) AS kept FROM part")
def _(s, d):
    return tables.quality_control(views.table(s, d, "part"), "p_size", 5, 45)


@query("f11_f13_text_parts", "SELECT p_partkey, string_split(p_type, ' ')[1] AS first, upper(trim(p_brand)) || '/' || p_size AS path, contains(lower(p_name), 'out of memory') AS oom FROM part")
def _(s, d):
    return views.table(s, d, "part").select("p_partkey", F.split("p_type", " ")[0].alias("first"), F.concat_ws("/", F.upper(F.trim("p_brand")), F.col("p_size").cast("string")).alias("path"), scalars.out_of_memory(F.col("p_name")).alias("oom"))


@query("f14_f17_percent_palette", "SELECT n_nationkey, 100.0::DOUBLE * n_nationkey / 25 AS done, (row_number() OVER (ORDER BY n_nationkey) - 1) / 24 AS hue FROM nation")
def _(s, d):
    ranked = tables.with_row_index(views.table(s, d, "nation").select("n_nationkey"), ["n_nationkey"])
    return ranked.select("n_nationkey", scalars.percent(F.col("n_nationkey"), F.lit(25)).alias("done"), scalars.palette_position(F.col("row_idx") + 1, F.lit(25)).alias("hue"))


@query("p03_p10_custom_filter", with_(CELLS) + 'SELECT cell_id, "CD45" FROM cells WHERE cluster = 3 AND "CD45" > 900')
def _(s, d):
    return tables.custom_filter(views.cells(s, d), "cluster = 3 and CD45 > 900").select("cell_id", "CD45")


# --- without SQL: models and documents -----------------------------------------------------------------------------


@query("ml05_kmeans")
def _(s, d):
    return cluster.kmeans(views.cells(s, d), MEASURED, 15)


@query("ml06_embedding")
def _(s, d):
    return cluster.embedding(views.cells(s, d), MEASURED)


@query("ml03_communities")
def _(s, d):
    return cluster.communities(spatial.nearest(views.cells(s, d), MEASURED, 15))


@query("k07_geojson", with_(CELLS) + """SELECT cell_id, '{"type":"Feature","id":' || cell_id || ',"geometry":{"type":"Point","coordinates":[' || x || '.0,' || y || '.0]},"properties":{"cluster":' || cluster || ',"CD45":' || "CD45" || '}}' AS feature FROM cells""")
def _(s, d):
    return feature_lines(views.cells(s, d).select("cell_id", "x", "y", "cluster", "CD45"), ["cluster", "CD45"])


# --- questions put together from the operators ----------------------------------------------------------------------


@query(
    "j02_three_way_positional_join",
    "WITH a AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS row_idx FROM events), b AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx FROM orders), "
    "c AS (SELECT p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS row_idx FROM part) SELECT row_idx, event_id, o_orderkey, p_partkey FROM a JOIN b USING (row_idx) JOIN c USING (row_idx)",
)
def _(s, d):
    two = tables.positional_join(views.table(s, d, "events").select("event_id"), views.table(s, d, "orders").select("o_orderkey"), ["event_id"], ["o_orderkey"])
    return two.join(tables.with_row_index(views.table(s, d, "part").select("p_partkey"), ["p_partkey"]), "row_idx")


@query("u02_append_once", "SELECT DISTINCT c_custkey, c_nationkey FROM (SELECT * FROM customer WHERE c_nationkey < 15 UNION ALL SELECT * FROM customer WHERE c_nationkey > 10)")
def _(s, d):
    c = views.table(s, d, "customer").select("c_custkey", "c_nationkey")
    return c.where("c_nationkey < 15").unionByName(c.where("c_nationkey > 10")).dropDuplicates(["c_custkey"])


@query("a05_categories", "SELECT DISTINCT event_type FROM events")
def _(s, d):
    return views.table(s, d, "events").select("event_type").distinct()


INSIDE = "ins AS (SELECT cell_id, region_id FROM cells JOIN edges ON (ay > y) <> (bt > y) AND x < (bx - ax) * (y - ay) / (bt - ay) + ax GROUP BY 1, 2 HAVING count(*) % 2 = 1)"


@query(
    "d01_inside_and_outside_regions",
    with_(CELLS, EDGES, INSIDE, "c AS (SELECT coalesce(region_id, 0) AS region_id, cluster FROM cells LEFT JOIN ins USING (cell_id))")
    + "SELECT region_id, cluster, count(*) AS cells, round(count(*) / sum(count(*)) OVER (PARTITION BY region_id), 6) AS share FROM c GROUP BY 1, 2",
)
def _(s, d):
    c = views.cells(s, d).select("cell_id", "x", "y", "cluster")
    at = c.join(geometry.points_in_polygons(c, regions(s)), "cell_id", "left").select(F.coalesce("region_id", F.lit(0)).alias("region_id"), "cluster")
    n = at.groupBy("region_id", "cluster").agg(F.count(F.lit(1)).alias("cells"))
    total = n.groupBy("region_id").agg(F.sum("cells").alias("t"))
    return rounded(n.join(total, "region_id").select("region_id", "cluster", "cells", (F.col("cells") / F.col("t")).alias("share")))


@query(
    "d02_states_by_type",
    _typing_sql() + "SELECT a.cell_type, count(*) FILTER (k.level = 'high') AS high, count(*) FILTER (k.level = 'medium') AS medium, count(*) FILTER (k.level = 'low') AS low FROM typed a JOIN (SELECT * FROM lv WHERE marker = 'Ki67') k USING (cell_id) WHERE ref_id = 1 GROUP BY 1",
)
def _(s, d):
    levels = typing_rules.marker_levels(tables.measurements(views.cells(s, d), MEASURED))
    types = typing_rules.assign_types(levels, measured=MEASURED).where("ref_id = 1").select("cell_id", "cell_type")
    wide = types.join(levels.where("marker = 'Ki67'"), "cell_id").groupBy("cell_type").pivot("level", ["high", "medium", "low"]).agg(F.count(F.lit(1)))
    return wide.na.fill(0, ["high", "medium", "low"])


@query(
    "d03_group_interface",
    with_(CELLS, PAIRS.format(r2=2500)) + "SELECT CASE WHEN ca < 5 THEN 'immune' ELSE 'tumour' END AS group_a, CASE WHEN cb < 5 THEN 'immune' ELSE 'tumour' END AS group_b, count(*) AS pairs, min(d2) AS nearest FROM pairs GROUP BY 1, 2",
)
def _(s, d):
    group = lambda c: F.when(F.col(c) < 5, "immune").otherwise("tumour")
    p = spatial.radius_pairs(views.cells(s, d), 50, ("cluster",))
    return p.groupBy(group("cluster_a").alias("group_a"), group("cluster_b").alias("group_b")).agg(F.count(F.lit(1)).alias("pairs"), F.min("d2").alias("nearest"))


@query("k08_measurement_lines", with_(CELLS) + "SELECT cell_id, concat_ws(chr(9), cell_id, x, y, cluster, \"CD45\") AS line FROM cells")
def _(s, d):
    c = views.cells(s, d)
    return c.select("cell_id", F.concat_ws("\t", *[F.col(n).cast("string") for n in ("cell_id", "x", "y", "cluster", "CD45")]).alias("line"))


PLANS = [(4000, 6000, 8.0), (512, 512, 4.0), (90_000, 50_000, 64.0), (3000, 3000, 1.5)]


@query(
    "f01_f02_tile_plan",
    "WITH p(h, w, gb) AS (VALUES " + ", ".join(f"({h}::DOUBLE, {w}::DOUBLE, {gb}::DOUBLE)" for h, w, gb in PLANS) + "), "
    "q AS (SELECT *, least((gb - 1) * 0.75 * power(1024, 3) / 40, power(1024, 3) / 4) AS px FROM p), r AS (SELECT *, floor(sqrt(px / (w / h))) AS th FROM q), "
    "t AS (SELECT h, w, least(h, greatest(256, floor(th / 256) * 256)) AS tile_h, least(w, greatest(256, floor(floor(th * (w / h)) / 256) * 256)) AS tile_w FROM r) "
    "SELECT h::BIGINT AS h, w::BIGINT AS w, tile_h::BIGINT AS tile_h, tile_w::BIGINT AS tile_w, least(greatest(floor(tile_h * 0.1), 100), floor(tile_h / 2))::BIGINT AS overlap FROM t",
)
def _(s, d):
    rows = []
    for h, w, gb in PLANS:
        th, tw = scalars.tile_size(h, w, gb)
        rows.append((h, w, th, tw, scalars.overlap(th)))
    return s.createDataFrame(rows, "h long, w long, tile_h long, tile_w long, overlap long")


@query("st01_windowed_counts", "SELECT strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(s, d):
    n = ingest.windowed_counts(views.table(s, d, "events"), "ts", "event_type")
    return n.withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query("c01_stage_lineage", "SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{k}')" for k, ns in Pipeline.needs.items() for n in ns) + ") t(source, stage)")
def _(s, d):
    return Pipeline(s, views.cells(s, d)).lineage()


SCORES = "SELECT {by}least(ca, cb) AS cell_type_1, greatest(ca, cb) AS cell_type_2, count(*) AS pairs FROM pairs GROUP BY ALL"


@query(
    "ml07_typed_interactions",
    _typing_sql() + ", refined AS (SELECT c.cell_id, c.x, c.y, t.cell_type AS cluster FROM cells c JOIN typed t USING (cell_id) WHERE t.ref_id = 1), " + PAIRS.format(r2=2500).replace("cells a", "refined a").replace("cells b", "refined b")
    + ", n AS (SELECT cluster, count(*) AS n FROM refined GROUP BY 1), sc AS (" + SCORES.format(by="") + ") "
    "SELECT cell_type_1, cell_type_2, pairs, round(pairs * (SELECT count(*) FROM refined) / (n1.n * n2.n), 6) AS interaction_score FROM sc JOIN n n1 ON n1.cluster = cell_type_1 JOIN n n2 ON n2.cluster = cell_type_2",
)
def _(s, d):
    return Pipeline(s, views.cells(s, d)).stage("interactions")


# --- several images in one table --------------------------------------------------------------------------------------


def slides(s, d):
    return views.cells(s, d).withColumn("image_id", F.col("cell_id") % 3)


SLIDES = "cells0 AS (SELECT *, cell_id % 3 AS image_id FROM cells)"
SLIDE_PAIRS = "pairs AS (SELECT a.image_id, a.cell_id AS a, b.cell_id AS b, a.cluster AS ca, b.cluster AS cb, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) AS d2 FROM cells0 a JOIN cells0 b ON a.image_id = b.image_id AND a.cell_id < b.cell_id AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 10000)"


@query(
    "a11_interactions_by_image",
    with_(CELLS, SLIDES, SLIDE_PAIRS, "n AS (SELECT image_id, cluster, count(*) AS n FROM cells0 GROUP BY ALL)", "t AS (SELECT image_id, sum(n) AS total FROM n GROUP BY 1)", "sc AS (" + SCORES.format(by="image_id, ") + ")")
    + "SELECT image_id, cell_type_1, cell_type_2, pairs, round(pairs * total / (n1.n * n2.n), 6) AS interaction_score FROM sc JOIN t USING (image_id) JOIN n n1 ON n1.image_id = sc.image_id AND n1.cluster = cell_type_1 JOIN n n2 ON n2.image_id = sc.image_id AND n2.cluster = cell_type_2",
)
def _(s, d):
    return spatial.interaction_scores(slides(s, d), 100, by=("image_id",))


@query(
    "a10_density_by_image",
    with_(CELLS, SLIDES, SLIDE_PAIRS, "met AS (SELECT image_id, a AS cell_id FROM pairs UNION ALL SELECT image_id, b FROM pairs)")
    + "SELECT image_id, cell_id, count(met.cell_id) AS neighbors, round(count(met.cell_id) / (pi() * 10000), 9) AS local_density FROM cells0 LEFT JOIN met USING (image_id, cell_id) GROUP BY ALL",
)
def _(s, d):
    return rounded(spatial.local_density(slides(s, d), 100, ("image_id",)), 9)


# --- joined exports, guards, progress ---------------------------------------------------------------------------------


@query(
    "j10_label_cluster_measurement",
    with_(CELLS, PIXELS, AXIS, LABELS, STITCH, "areas AS (SELECT cell_id, count(*) AS area FROM st GROUP BY 1)") + 'SELECT cell_id, cluster, area, "CD45", "PANCK" FROM areas JOIN cells USING (cell_id)',
)
def _(s, d):
    areas = tiles.stitch(labels(s, d)).groupBy("cell_id").agg(F.count(F.lit(1)).alias("area"))
    c = views.cells(s, d)
    return areas.join(c.select("cell_id", "cluster"), "cell_id").join(c.select("cell_id", "CD45", "PANCK"), "cell_id")


@query(
    "j13_k13_export_table",
    with_(CELLS, PAIRS.format(r2=10000), BOTH, "n AS (SELECT cluster, count(*) AS cluster_size FROM cells GROUP BY 1)", "sc AS (" + SCORES.format(by="") + ")", "p AS (SELECT cell_type_1, cell_type_2, round(pairs * (SELECT count(*) FROM cells) / (n1.cluster_size * n2.cluster_size), 6) AS sc FROM sc JOIN n n1 ON n1.cluster = cell_type_1 JOIN n n2 ON n2.cluster = cell_type_2)", "top AS (SELECT t AS cluster, max(sc) AS top_interaction FROM (SELECT cell_type_1 AS t, sc FROM p UNION ALL SELECT cell_type_2, sc FROM p) GROUP BY 1)", "nb AS (SELECT cell_id, count(*) AS k FROM met GROUP BY 1)")
    + 'SELECT cell_id, x, y, cluster, cluster_size, "CD45", coalesce(k, 0) AS neighbors, top_interaction FROM cells JOIN n USING (cluster) LEFT JOIN nb USING (cell_id) LEFT JOIN top USING (cluster)',
)
def _(s, d):
    c = views.cells(s, d)
    clusters = tables.cluster_sizes(c.select("cell_id", "cluster"))
    density = spatial.local_density(c, 100).drop("local_density")
    return tables.export_table(c.select("cell_id", "x", "y", "CD45"), clusters, density, spatial.interaction_scores(c, 100))


@query("p02_optional_columns", with_(CELLS) + 'SELECT cell_id, x, y, "CD45" FROM cells')
def _(s, d):
    return tables.guarded(views.cells(s, d), ["cell_id", "x", "y"], ["CD45", "no_such_marker"])


@query("a06_filtered_sum", "SELECT l_returnflag, coalesce(sum(l_quantity) FILTER (l_linenumber <> 1), 0) AS total FROM lineitem GROUP BY 1")
def _(s, d):
    return tables.filtered_sum(views.table(s, d, "lineitem"), "l_quantity", "l_linenumber <> 1", ("l_returnflag",))


@query(
    "w06_throttled_progress",
    "WITH e AS (SELECT event_id, user_id, cast(round(value) AS bigint) AS s FROM events), k AS (SELECT *, count(*) OVER w AS k, sum(s) OVER w AS t FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)) SELECT event_id, user_id, s FROM k WHERE k % 5 = 0 OR floor(t / 30.0) > floor((t - s) / 30.0)",
)
def _(s, d):
    e = views.table(s, d, "events").select("event_id", "user_id", F.round("value").cast("long").alias("s"))
    return tables.throttled(e, "event_id", "s", "user_id")


RARE = ("memory", "m2_type", "cd31_positive", "acta2_positive", "pdgfra_positive", "collagen_producing")


@query(
    "d03_d06_vessels_fibroblasts_memory_m2",
    _typing_sql(PANEL) + "SELECT cell_type, cluster, count(*) AS cells, round(avg(confidence), 6) AS mean_confidence FROM typed JOIN cells USING (cell_id) WHERE ref_id = 1 AND cell_type IN (" + ", ".join(f"'{t}'" for t in RARE) + ") GROUP BY 1, 2",
)
def _(s, d):
    rare = typed(s, d, PANEL).where(F.col("ref_id") == 1).where(F.col("cell_type").isin(*RARE))
    return rounded(rare.join(views.cells(s, d).select("cell_id", "cluster"), "cell_id").groupBy("cell_type", "cluster").agg(F.count(F.lit(1)).alias("cells"), F.avg("confidence").alias("mean_confidence")))
