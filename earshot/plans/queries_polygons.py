"""Polygons with parts and holes: the geometry operators on shapes that no box describes."""

from __future__ import annotations

from pyspark.sql import functions as F

from earshot.functions import geo
from earshot.operators import grid as G
from earshot.operators import polygons as P
from earshot.plans import queries_exposure as E
from earshot.plans.queries_coverage import COVER, COVER_FIXTURES, _floor, covered_stage
from earshot.plans.queries_exposure import AF, GAPS
from earshot.plans.registry import query

c = F.col

EDGES = """ed AS (SELECT * FROM (SELECT shape_id, part, ring, pos, x::DOUBLE AS ax, y::DOUBLE AS ay, coalesce(lead(x) OVER w, first_value(x) OVER w)::DOUBLE AS ex, coalesce(lead(y) OVER w, first_value(y) OVER w)::DOUBLE AS ey
  FROM fx_corners WINDOW w AS (PARTITION BY shape_id, ring ORDER BY pos)) WHERE ax <> ex OR ay <> ey),
bb AS (SELECT shape_id, min(ax) AS x0, max(ax) AS x1, min(ay) AS y0, max(ay) AS y1 FROM ed GROUP BY shape_id)"""
#: All cells of the box round each shape.
_GRID = f"""gx AS (SELECT shape_id, cy, unnest(range({_floor('x0', 100)}, {_floor('x1', 100)} + 1)) AS cx FROM (SELECT *, unnest(range({_floor('y0', 100)}, {_floor('y1', 100)} + 1)) AS cy FROM bb))"""
INSIDE = EDGES + ", " + _GRID + """, ic AS (SELECT shape_id, cx, cy FROM gx JOIN ed USING (shape_id) WHERE (ay > cy * 100 + 50) <> (ey > cy * 100 + 50) AND (ex - ax) * (cy * 100 + 50 - ay) / (ey - ay) + ax > cx * 100 + 50
  GROUP BY ALL HAVING count(*) % 2 = 1)"""
_CROSS = "(ex - ax) * ({1} - ay) - (ey - ay) * ({0} - ax)"
_CORNERS = ", ".join(_CROSS.format(f"(cx + {i}) * 100", f"(cy + {j}) * 100") for i in (0, 1) for j in (0, 1))
TOUCHED = INSIDE + f""", tc AS (SELECT * FROM ic UNION SELECT DISTINCT shape_id, cx, cy FROM gx JOIN ed USING (shape_id)
  WHERE least(ax, ex) <= (cx + 1) * 100 AND greatest(ax, ex) >= cx * 100 AND least(ay, ey) <= (cy + 1) * 100 AND greatest(ay, ey) >= cy * 100 AND least({_CORNERS}) <= 0 AND greatest({_CORNERS}) >= 0)"""


def shapes(t):
    return P.from_vertices(t.fx_corners, "shape_id")


@query("g09_polygon_cells", INSIDE + " SELECT * FROM ic", "fx_corners")
def g09(t):
    return P.fill_cells(shapes(t), "shape_id")


@query("g10_polygon_cells_touched", TOUCHED + " SELECT * FROM tc", "fx_corners")
def g10(t):
    return P.fill_cells(shapes(t), "shape_id", touched=True)


def _held(points: str, key: str) -> str:
    """Points with every shape that holds them: inside by all edges of the shape, or on one of them."""
    return f"""pr AS (SELECT {key}, x, y, shape_id FROM {points} JOIN bb ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1),
    ht AS (SELECT {key}, shape_id, count(*) FILTER ((ay > y) <> (ey > y) AND ({_CROSS.format('x', 'y')} > 0) = (ey > ay) AND {_CROSS.format('x', 'y')} <> 0) % 2 = 1 AS odd,
      bool_or({_CROSS.format('x', 'y')} = 0 AND x BETWEEN least(ax, ex) AND greatest(ax, ex) AND y BETWEEN least(ay, ey) AND greatest(ay, ey)) AS edge FROM pr JOIN ed USING (shape_id) GROUP BY ALL),
    hd AS (SELECT {key}, shape_id, NOT edge AS inside FROM ht WHERE odd OR edge)"""


@query(
    "j02_point_in_polygon",
    EDGES + ", " + _held("fx_buildings", "bldg_id") + " SELECT b.bldg_id, max_by(shape_id, (inside, shape_id)) AS shape_id FROM fx_buildings b LEFT JOIN hd USING (bldg_id) GROUP BY b.bldg_id",
    "fx_corners", "fx_buildings",
)
def j02(t):
    return P.assign(t.fx_buildings, shapes(t), "shape_id").select("bldg_id", "shape_id")


@query("src06_polygon_mask", EDGES + ", " + _held("fx_buildings", "bldg_id") + " SELECT DISTINCT bldg_id FROM hd", "fx_corners", "fx_buildings")
def src06(t):
    return P.mask(t.fx_buildings.select("bldg_id", "x", "y"), shapes(t), "shape_id").select("bldg_id")


BORDERS = """ri AS (SELECT shape_id, part, ring, '(' || string_agg(x::BIGINT || ' ' || y::BIGINT, ', ' ORDER BY pos) || CASE WHEN count(*) > 1 THEN ', ' || arg_min(x, pos)::BIGINT || ' ' || arg_min(y, pos)::BIGINT ELSE '' END || ')' AS w FROM fx_corners GROUP BY ALL),
bd AS (SELECT shape_id, count(DISTINCT part) AS parts, count(*) AS rings, string_agg(w, ', ' ORDER BY part, ring) AS wkt FROM ri GROUP BY shape_id)"""


def borders(t):
    """Units with their boundary: code, parent, name, rings."""
    name = F.coalesce(F.nullif("name", F.lit("")), "gmi")
    units = t.fx_admin.select(c("unit_no").alias("shape_id"), F.lpad("gmi", 7, "0").alias("code"), F.substring("gmi", 1, 2).alias("parent"), name.alias("name"))
    return units.join(shapes(t), "shape_id")


@query("d02_boundary_geometry", BORDERS + " SELECT lpad(gmi, 7, '0') AS code, substr(gmi, 1, 2) AS parent, coalesce(nullif(name, ''), gmi) AS name, parts, rings, wkt FROM fx_admin JOIN bd ON shape_id = unit_no", "fx_corners", "fx_admin")
def d02(t):
    whole = lambda v: v.cast("bigint").cast("string")
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r["points"], lambda p: F.concat_ws(" ", whole(p["x"]), whole(p["y"]))), ", "), F.lit(")"))
    parts = F.size(F.array_distinct("rings.part")).cast("bigint")
    return borders(t).select("code", "parent", "name", parts.alias("parts"), F.size("rings").cast("bigint").alias("rings"), F.array_join(F.transform("rings", ring), ", ").alias("wkt"))


@query(
    "j02_point_in_boundary",
    EDGES + ", " + _held("fx_sites", "nr_ref") + " SELECT nr_ref, max_by(code, (inside, code)) AS code FROM fx_sites LEFT JOIN (SELECT nr_ref, inside, lpad(gmi, 7, '0') AS code FROM hd JOIN fx_admin ON unit_no = shape_id) USING (nr_ref) GROUP BY nr_ref",
    "fx_corners", "fx_sites", "fx_admin",
)
def j02_units(t):
    return P.assign(t.fx_sites.select("nr_ref", "x", "y"), borders(t), "code").select("nr_ref", "code")


RISK = INSIDE + ", rk AS (SELECT cx, cy, max(1 + shape_id % 2) AS risk FROM ic GROUP BY ALL)"


def risk_cells(t):
    return P.fill_cells(shapes(t), "shape_id").groupBy("cx", "cy").agg(F.max(1 + c("shape_id") % 2).alias("risk"))


@query("d04_polygon_risk_cells", RISK + " SELECT * FROM rk", "fx_corners")
def d04(t):
    return risk_cells(t)


def _outline_sql(cells: str, key: str) -> str:
    """Area, corners, sides and outer rings less holes of the cells of each key, without tracing: corners by the four
    cells round each lattice point (one or three make one, two that lie across make two); outer rings less
    holes is a quarter of (ones - threes + 2 x across), where pieces hang together over sides."""
    return f"""qd AS (SELECT {key}, vx, vy, count(*) AS n, bool_or(d = 0) AND bool_or(d = 3) AND count(*) = 2 OR bool_or(d = 1) AND bool_or(d = 2) AND count(*) = 2 AS across
      FROM (SELECT {key}, cx + d % 2 AS vx, cy + d // 2 AS vy, d FROM {cells}, (SELECT unnest(range(4)) AS d)) GROUP BY ALL),
    cn AS (SELECT {key}, (sum(CASE WHEN n IN (1, 3) THEN 1 WHEN across THEN 2 ELSE 0 END))::BIGINT AS corners, (sum(CASE WHEN n = 1 THEN 1 WHEN n = 3 THEN -1 WHEN across THEN 2 ELSE 0 END))::BIGINT // 4 AS euler FROM qd GROUP BY {key}),
    ar AS (SELECT {key}, count(*) * 10000::DOUBLE AS area FROM {cells} GROUP BY {key}),
    pe AS (SELECT a.{key}, (count(*) FILTER (b.{key} IS DISTINCT FROM a.{key}))::BIGINT AS sides FROM (SELECT {key}, cx + dx AS cx, cy + dy AS cy FROM {cells}, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) v(dx, dy)) a
      LEFT JOIN {cells} b USING (cx, cy) GROUP BY a.{key})
    SELECT {key}, area, corners, euler, sides FROM cn JOIN ar USING ({key}) JOIN pe USING ({key})"""


def _outlines(cells, key: str):
    """The outlines of each key's cells, summed up: area, corners, sides, outer rings less holes."""
    n = F.size("points")
    pairs = F.zip_with(F.slice("points", F.lit(1), n - 1), F.slice("points", F.lit(2), n - 1), lambda a, b: F.abs(b["x"] - a["x"]) + F.abs(b["y"] - a["y"]))
    length = F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v) / 100
    sign = F.when(c("hole"), -1).otherwise(1)
    return P.trace(cells, key).groupBy(key).agg(
        F.sum(sign * c("area")).alias("area"), F.sum(n - 1).alias("corners"), F.sum(sign).alias("euler"), F.sum(length).cast("bigint").alias("sides")
    )


@query("g11_polygons", RISK + ", " + _outline_sql("rk", "risk"), "fx_corners")
def g11(t):
    return _outlines(risk_cells(t), "risk")


@query("d21_gap_outlines", GAPS + ", lo AS (SELECT gap_id, cx, cy FROM lb), " + _outline_sql("lo", "gap_id"), *AF)
def d21(t):
    """The gaps as polygons."""
    return _outlines(E.gap_labels(t).select("gap_id", "cx", "cy"), "gap_id")


@query("a11_range_outlines", COVER + ", lo AS (SELECT site_uid * 1000 + db AS code, cx, cy FROM co), " + _outline_sql("lo", "code"), *COVER_FIXTURES)
def a11(t):
    """The ranges as polygons: one outline for each site and class."""
    return _outlines(covered_stage(t).select("code", "cx", "cy"), "code")


INNER = EDGES + """, md AS (SELECT shape_id, part, (min(least(ay, ey)) + max(greatest(ay, ey))) / 2 AS mid FROM ed GROUP BY ALL),
ln AS (SELECT shape_id, part, (max(ay) FILTER (ay <= mid) + min(ay) FILTER (ay > mid)) / 2 AS y FROM ed JOIN md USING (shape_id, part) GROUP BY ALL),
xs AS (SELECT shape_id, part, y, (ex - ax) * (y - ay) / (ey - ay) + ax AS x, row_number() OVER (PARTITION BY shape_id, part ORDER BY (ex - ax) * (y - ay) / (ey - ay) + ax) AS k FROM ed JOIN ln USING (shape_id, part) WHERE (ay > y) <> (ey > y)),
wd AS (SELECT a.shape_id, a.part, a.y, a.x AS a, b.x AS b, row_number() OVER (PARTITION BY a.shape_id ORDER BY a.x - b.x, a.part, a.x) AS k FROM xs a JOIN xs b ON a.shape_id = b.shape_id AND a.part = b.part AND b.k = a.k + 1 WHERE a.k % 2 = 1),
rp AS (SELECT shape_id, (a + b) / 2 AS x, y FROM wd WHERE k = 1)"""


@query("g13_polygon_points", INNER + " SELECT shape_id, round(x, 6) AS x, y FROM rp", "fx_corners")
def g13(t):
    return P.representative_points(shapes(t), "shape_id").select("shape_id", F.round("x", 6).alias("x"), "y")


@query("p03_footprint_cells", INNER + f" SELECT shape_id, 'CRS3035RES500mN' || ({_floor('y', 500)} * 500)::VARCHAR || 'E' || ({_floor('x', 500)} * 500)::VARCHAR AS code FROM rp", "fx_corners")
def p03(t):
    """The census cell of a footprint is that of its inner point."""
    return P.representative_points(shapes(t), "shape_id").select("shape_id", G.census_code(c("x"), c("y")).alias("code"))


@query("a07_footprint_cells", TOUCHED + " SELECT DISTINCT cx, cy FROM tc", "fx_corners")
def a07(t):
    """Every cell that a footprint covers or touches."""
    return P.touched_cells(shapes(t), "shape_id")


@query(
    "g17_boundary_buffer",
    EDGES + ", " + _held("fx_sites", "nr_ref") + """, nr AS (SELECT nr_ref, shape_id, (x - ax) * (ex - ax) + (y - ay) * (ey - ay) AS dot, (ex - ax) ** 2 + (ey - ay) ** 2 AS len, x, y, ax, ay, ex, ey
      FROM fx_sites JOIN bb ON x BETWEEN x0 - 800 AND x1 + 800 AND y BETWEEN y0 - 800 AND y1 + 800 JOIN ed USING (shape_id)),
    ds AS (SELECT nr_ref, shape_id, min(sqrt((x - ax - least(1, greatest(0, dot / len)) * (ex - ax)) ** 2 + (y - ay - least(1, greatest(0, dot / len)) * (ey - ay)) ** 2)) AS d FROM nr GROUP BY ALL)
    SELECT nr_ref, shape_id, round(min(d), 6) AS distance FROM (SELECT * FROM ds WHERE d <= 800 UNION ALL SELECT nr_ref, shape_id, 0 FROM hd) GROUP BY ALL""",
    "fx_corners", "fx_sites",
)
def g17(t):
    near = P.within_distance(t.fx_sites.select("nr_ref", "x", "y"), "nr_ref", shapes(t), "shape_id", 800.0)
    return near.select("nr_ref", "shape_id", F.round("distance", 6).alias("distance"))


@query(
    "g15_ring_checks",
    EDGES + """, rg AS (SELECT shape_id, ring, count(*) AS n, count(DISTINCT (x, y)) AS corners, arg_min(x, pos) = arg_max(x, pos) AND arg_min(y, pos) = arg_max(y, pos) AS closed FROM fx_corners GROUP BY ALL),
    sa AS (SELECT shape_id, ring, abs(sum(ax * ey - ex * ay)) / 2 AS area FROM ed GROUP BY ALL)
    SELECT count(*) AS rings, count(*) FILTER (NOT closed) AS open_rings, count(*) FILTER (corners < 3) AS short_rings, count(*) FILTER (coalesce(area, 0) = 0) AS zero_area, round(sum(coalesce(area, 0)), 3) AS area FROM rg LEFT JOIN sa USING (shape_id, ring)""",
    "fx_corners",
)
def g15(t):
    """Rings as they were given (not closed yet) and their areas once closed."""
    raw = t.fx_corners.groupBy("shape_id", "ring").agg(F.sort_array(F.collect_list(F.struct("pos", "x", "y"))).alias("r"))
    first, last = F.element_at("r", 1), F.element_at("r", -1)
    corners = F.size(F.array_distinct(F.transform("r", lambda p: F.struct(p["x"], p["y"]))))
    points = F.transform(F.concat("r", F.slice("r", 1, 1)), lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    rows = raw.select(((first["x"] == last["x"]) & (first["y"] == last["y"])).alias("closed"), corners.alias("corners"), geo.ring_area(points).alias("area"))
    return rows.agg(
        F.count(F.lit(1)).alias("rings"), F.count_if(~c("closed")).alias("open_rings"), F.count_if(c("corners") < 3).alias("short_rings"), F.count_if(c("area") == 0).alias("zero_area"), F.round(F.sum("area"), 3).alias("area")
    )
