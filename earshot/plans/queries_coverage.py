"""SRC, G, J and A: grid primitives, joins and coverage.

The fixtures' 300 sites a square are so strong that 65 dB would cover all of it;
the queries use 80, 85 and 90 dB through the same parameters.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from earshot.functions import geo
from earshot.operators import coverage as V
from earshot.operators import grid as G
from earshot.operators import polygons as PG
from earshot.operators import spatial_join as J
from earshot.operators import voronoi
from earshot.plans.registry import query
from earshot.sources import spatial
from earshot.sources.storage import shared_path

DB = (80, 85, 90)
c = F.col


def _floor(e: str, n) -> str:
    return f"floor(({e}) / {n}e0)::BIGINT"


SITES = f"""s0 AS (SELECT *, CASE WHEN moc_w <= 450 THEN 300 WHEN moc_w <= 750 THEN 600 WHEN moc_w <= 1050 THEN 900 ELSE 1200 END AS prof_w,
  CASE WHEN moc_w <= 450 THEN 103 WHEN moc_w <= 750 THEN 109 WHEN moc_w <= 1050 THEN 112 ELSE 115 END AS spl30, count(*) OVER (PARTITION BY x, y) AS site_cnt FROM fx_sites),
s1 AS (SELECT *, {", ".join(f"30 * pow(10::DOUBLE, (spl30 - {t}) / 20e0) AS r_{t}" for t in DB)} FROM s0),
sd AS (SELECT *, dense_rank() OVER (ORDER BY lp0) AS site_uid FROM (SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY moc_w DESC, nr_ref) AS k, min(lp) OVER (PARTITION BY x, y) AS lp0 FROM s1) WHERE k = 1)"""
WINDOW = f"""wn AS (SELECT site_uid, spl30, r_80, r_85, r_90, cx, cy, sqrt(((cx + 0.5e0) * 100 - x) ** 2 + ((cy + 0.5e0) * 100 - y) ** 2) AS dist
  FROM (SELECT *, unnest(range({_floor("x - r_80", 100)}, {_floor("x + r_80", 100)} + 1)) AS cx FROM (SELECT *, unnest(range({_floor("y - r_80", 100)}, {_floor("y + r_80", 100)} + 1)) AS cy FROM sd)))"""
BEST = """be AS (SELECT cx, cy, max(struct_pack(level := l, neg := -site_uid)) AS b FROM (SELECT cx, cy, site_uid, round(spl30 - 20 * log10(greatest(dist, 30) / 30), 6) AS l FROM wn WHERE dist <= r_80) GROUP BY cx, cy)"""


def _box(low: str, size: str, touched: bool) -> str:
    if touched:
        return f"range({_floor(low, 100)}, ceil(({low} + {size}) / 100e0)::BIGINT)"
    return f"range(ceil({low} / 100e0 - 0.5)::BIGINT, ceil(({low} + {size}) / 100e0 - 0.5)::BIGINT)"


def _box_cells(source: str, touched: bool) -> str:
    return f"(SELECT *, unnest({_box('xmin', 'w', touched)}) AS cx FROM (SELECT *, unnest({_box('ymin', 'h', touched)}) AS cy FROM {source}))"


ATT = f"""cl AS (SELECT cx, cy, arg_max(att_db, zone_id) AS att_db FROM {_box_cells("(SELECT *, (zone_id % 5 * 2)::DOUBLE AS att_db FROM fx_risk)", True)} WHERE att_db > 0 GROUP BY cx, cy),
bc AS (SELECT DISTINCT cx, cy FROM {_box_cells("(SELECT x AS xmin, y AS ymin, 20 AS w, 20 AS h FROM fx_buildings)", True)}),
atn AS (SELECT be.cx, be.cy, round(b.level - coalesce(att_db, 0) - CASE WHEN bc.cx IS NULL THEN 0 ELSE 10 END, 6) AS level, -b.neg AS site_uid
  FROM be LEFT JOIN cl USING (cx, cy) LEFT JOIN bc ON bc.cx = be.cx AND bc.cy = be.cy),
co AS (SELECT *, CASE WHEN level >= 90 THEN 90 WHEN level >= 85 THEN 85 ELSE 80 END AS db FROM atn WHERE level >= 80)"""
COVER = ", ".join([SITES, WINDOW, BEST, ATT])
COVER_FIXTURES = ("fx_sites", "fx_risk", "fx_buildings")


def profiled(t):
    return V.with_profiles(t.fx_sites, DB)


def sites(t):
    return V.dedup_sites(profiled(t))


def zones(t):
    return t.fx_risk.withColumns({"att_db": (c("zone_id") % 5 * 2).cast("double"), "seq": c("zone_id")})


def footprints(t):
    return t.fx_buildings.select(c("x").alias("xmin"), c("y").alias("ymin"), F.lit(20).alias("w"), F.lit(20).alias("h"))


def clutter(t):
    return V.clutter_cells(G.box_cells(G.deal(zones(t)), touched=True))


def built(t):
    return G.box_cells(footprints(t), touched=True).select("cx", "cy").distinct()


def levels(t, asked=None, keep="all"):
    return V.attenuated_levels(sites(t), zones(t), footprints(t), DB, asked, keep)


def covered(t):
    return levels(t, keep="heard").withColumn("code", c("site_uid") * 1000 + c("db"))


def covered_stage(t):
    return t.stage("covered", lambda: covered(t))


# sources

@query("src04_bbox_scan", "SELECT zone_id, risk FROM fx_risk WHERE xmin <= 430000 AND xmin + w >= 410000 AND ymin <= 530000 AND ymin + h >= 510000", "fx_risk")
def src04(t):
    z = t.fx_risk
    return z.where((z.xmin <= 430000) & (z.xmin + z.w >= 410000) & (z.ymin <= 530000) & (z.ymin + z.h >= 510000)).select("zone_id", "risk")


def risk_layer(t, file_rows: int = 2_000) -> str:
    """The zones, written in spatial order; the folder."""

    def make():
        path = shared_path(t.spark, "risk-layer")
        z = t.fx_risk
        spatial.write_layer(z, path, [z.xmin, z.ymin, z.xmin + z.w, z.ymin + z.h], file_rows)
        return t.spark.range(1).select(F.lit(path).alias("path"))

    return t.stage("risk-layer", make).first()["path"]


@query("src04_pruned_scan", "SELECT zone_id, risk FROM fx_risk WHERE xmin <= 430000 AND xmin + w >= 410000 AND ymin <= 530000 AND ymin + h >= 510000", "fx_risk")
def src04_pruned(t):
    """The same window over a layer in spatial order: only files whose box meets it are opened."""
    return spatial.read_layer(t.spark, risk_layer(t), (410000, 510000, 430000, 530000)).select("zone_id", "risk")


@query("src14_spatial_layer", "SELECT risk, count(*) AS n, min(xmin) AS xmin, max(ymin + h) AS ymax FROM fx_risk GROUP BY risk", "fx_risk")
def src14_spatial(t):
    """All rows of the layer as they were written."""
    rows = t.spark.read.parquet(risk_layer(t))
    return rows.groupBy("risk").agg(F.count(F.lit(1)).alias("n"), F.min("xmin").alias("xmin"), F.max(c("ymin") + c("h")).alias("ymax"))


@query("src05_attribute_scan", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('ECONOMY', 'PROMO')")
def src05(t):
    return t.part.where(c("p_type").isin("ECONOMY", "PROMO")).select("p_partkey", "p_type")


@query("src06_masked_scan", f"SELECT bldg_id FROM fx_buildings WHERE ({_floor('x', 100)}, {_floor('y', 100)}) IN (SELECT (cx, cy) FROM {_box_cells('fx_risk', False)})", "fx_buildings", "fx_risk")
def src06(t):
    mask = G.box_cells(G.deal(t.fx_risk)).select("cx", "cy")
    at = t.fx_buildings.select("bldg_id", G.cell_of(c("x")).alias("cx"), G.cell_of(c("y")).alias("cy"))
    return G.on_cells(at, mask, ["cx", "cy"], "left_semi").select("bldg_id")


@query("src08_raster_window", f"cl AS (SELECT cx, cy, max(risk) AS risk FROM {_box_cells('fx_risk', False)} GROUP BY ALL) SELECT * FROM cl WHERE cx BETWEEN 4100 AND 4300 AND cy BETWEEN 5050 AND 5250", "fx_risk")
def src08(t):
    z = t.fx_risk
    near = z.where((z.xmin < 430_100) & (z.xmin + z.w >= 410_000) & (z.ymin < 525_100) & (z.ymin + z.h >= 505_000))
    cells = G.box_cells(near).groupBy("cx", "cy").agg(F.max("risk").alias("risk"))
    return cells.where("cx between 4100 and 4300 and cy between 5050 and 5250")


@query("src08_tile_scan", f"cl AS (SELECT cx, cy, max(risk) AS risk FROM {_box_cells('fx_risk', False)} GROUP BY ALL) SELECT * FROM cl WHERE cx BETWEEN 4100 AND 4300 AND cy BETWEEN 5050 AND 5250", "fx_risk")
def src08_tiles(t):
    """The window of a cell table that is written by tiles: folders of other tiles are not listed for reading."""

    def make():
        path = shared_path(t.spark, "risk-cells")
        spatial.write_cells(risk_cells(t), path)
        return t.spark.range(1).select(F.lit(path).alias("path"))

    path = t.stage("risk-cells-by-tile", make).first()["path"]
    return spatial.read_cells(t.spark, path, (4100, 5050, 4300, 5250))


@query("src09_census_summary", "SELECT count(*) AS cells, sum(tot)::BIGINT AS people, count(*) FILTER (tot > 0) AS populated FROM fx_popgrid", "fx_popgrid")
def src09(t):
    return t.fx_popgrid.agg(F.count(F.lit(1)).alias("cells"), F.sum("tot").alias("people"), F.count_if(c("tot") > 0).alias("populated"))


@query("src16_site_limit", "SELECT nr_ref, moc_w FROM fx_sites ORDER BY moc_w DESC, nr_ref LIMIT 100", "fx_sites")
def src16(t):
    """The limit is the feature: the strongest hundred sites for a smoke run."""
    return t.fx_sites.select("nr_ref", "moc_w").orderBy(F.desc("moc_w"), "nr_ref").limit(100)


@query("src17_zone_attributes", "SELECT substr(p_name, 1, 6) AS name, coalesce(p_brand, '') AS brand, count(*) AS n FROM part GROUP BY ALL")
def src17(t):
    return t.part.groupBy(F.substring("p_name", 1, 6).alias("name"), F.coalesce("p_brand", F.lit("")).alias("brand")).agg(F.count(F.lit(1)).alias("n"))


# projections: the oracle repeats Krüger's series and the equal-area formulas in SQL

_LAT, _LON = "(49 + doc_id % 600 / 1e2)", "(14 + doc_id % 997 / 1e2)"


def _sum(weights, one: str) -> str:
    return "(" + " + ".join(f"{w!r} * {one.replace('@', str(2 * j))}" for j, w in enumerate(weights, 1)) + ")"


def _metric_sql(lat: str, lon: str, source: str, keep: str) -> str:
    k, a = geo.K0 * geo.RADIUS, geo.E1
    return f"""(SELECT {keep}, 500000 + {k!r} * (eta + {_sum(geo.ALPHA, "cos(@ * xi) * sinh(@ * eta)")}) AS east, -5300000 + {k!r} * (xi + {_sum(geo.ALPHA, "sin(@ * xi) * cosh(@ * eta)")}) AS north
    FROM (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM (SELECT *, sinh(atanh(sin(phi)) - {a!r} * atanh({a!r} * sin(phi))) AS t
    FROM (SELECT *, radians({lat}) AS phi, radians({lon} - 19) AS lam FROM {source}))))"""


def _degrees_sql(east: str, north: str, source: str, keep: str) -> str:
    k = geo.K0 * geo.RADIUS
    return f"""(SELECT {keep}, degrees(chi + {_sum(geo.DELTA, "sin(@ * chi)")}) AS lat, 19 + degrees(lam) AS lon FROM (SELECT *, asin(sin(x1) / cosh(e1)) AS chi, atan2(sinh(e1), cos(x1)) AS lam
    FROM (SELECT *, u - {_sum(geo.BETA, "sin(@ * u) * cosh(@ * v)")} AS x1, v - {_sum(geo.BETA, "cos(@ * u) * sinh(@ * v)")} AS e1
    FROM (SELECT *, ({north} + 5300000) / {k!r} AS u, ({east} - 500000) / {k!r} AS v FROM {source}))))"""


@query("g01_to_metric", f"SELECT doc_id, round(east, 3) AS east, round(north, 3) AS north FROM {_metric_sql(_LAT, _LON, 'documents', 'doc_id')}")
def g01(t):
    e, n = geo.to_metric(49 + c("doc_id") % 600 / 1e2, 14 + c("doc_id") % 997 / 1e2)
    return t.documents.select("doc_id", F.round(e, 3).alias("east"), F.round(n, 3).alias("north"))


@query("g02_to_degrees", f"SELECT nr_ref, round(lat, 7) AS lat, round(lon, 7) AS lon FROM {_degrees_sql('x', 'y', 'fx_sites', 'nr_ref')}", "fx_sites")
def g02(t):
    lat, lon = geo.to_degrees(c("x"), c("y"))
    return t.fx_sites.select("nr_ref", F.round(lat, 7).alias("lat"), F.round(lon, 7).alias("lon"))


def _q(s: str) -> str:
    return f"({(1 - geo.E2)!r} * (({s}) / (1 - {geo.E2!r} * ({s}) * ({s})) - ln((1 - {geo.E1!r} * ({s})) / (1 + {geo.E1!r} * ({s}))) / {2 * geo.E1!r}))"


_s1, _c1 = f"sin({geo.BETA1!r}::DOUBLE)", f"cos({geo.BETA1!r}::DOUBLE)"


@query(
    "g03_metric_to_equal_area",
    f"""d AS (SELECT * FROM {_degrees_sql("x", "y", "fx_sites", "nr_ref")}),
    b AS (SELECT nr_ref, asin({_q("sin(radians(lat))")} / {geo.QP!r}) AS beta, radians(lon - 10) AS lam FROM d),
    r AS (SELECT *, {geo.RQ!r} * sqrt(2 / (1 + {_s1} * sin(beta) + {_c1} * cos(beta) * cos(lam))) AS k FROM b)
    SELECT nr_ref, round(4321000 + k * {geo.D1!r} * cos(beta) * sin(lam), 3) AS x, round(3210000 + k / {geo.D1!r} * ({_c1} * sin(beta) - {_s1} * cos(beta) * cos(lam)), 3) AS y FROM r""",
    "fx_sites",
)
def g03(t):
    x, y = geo.metric_to_equal_area(c("x"), c("y"))
    return t.fx_sites.select("nr_ref", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


_WX, _WY = "(1600000 + doc_id * 37 % 900000)", "(6300000 + doc_id * 91 % 900000)"


@query(
    "g04_web_to_metric",
    "w AS (SELECT doc_id, degrees(2 * atan(exp(" + _WY + " / 6378137e0)) - pi() / 2) AS la, degrees(" + _WX + " / 6378137e0) AS lo FROM documents) "
    f"SELECT doc_id, round(east, 3) AS east, round(north, 3) AS north FROM {_metric_sql('la', 'lo', 'w', 'doc_id')}",
)
def g04(t):
    e, n = geo.web_to_metric(1600000 + c("doc_id") * 37 % 900000, 6300000 + c("doc_id") * 91 % 900000)
    return t.documents.select("doc_id", F.round(e, 3).alias("east"), F.round(n, 3).alias("north"))


@query(
    "g05_grid_frame",
    SITES + """, b AS (SELECT floor((min(x) - max(r_80)) / 100)::BIGINT * 100 AS minx, ceil((max(x) + max(r_80)) / 100)::BIGINT * 100 AS maxx, floor((min(y) - max(r_80)) / 100)::BIGINT * 100 AS miny,
      ceil((max(y) + max(r_80)) / 100)::BIGINT * 100 AS maxy FROM s1) SELECT minx, maxy, (maxx - minx) // 100 AS width, (maxy - miny) // 100 AS height FROM b""",
    "fx_sites",
)
def g05(t):
    return G.grid_frame(profiled(t), c("r_80"))


@query("g06_sample_raster", f"cl AS (SELECT cx, cy, max(risk) AS risk FROM {_box_cells('fx_risk', False)} GROUP BY ALL) SELECT nr_ref, coalesce(risk, 0)::BIGINT AS risk, risk IS NOT NULL AS valid FROM fx_sites LEFT JOIN cl ON cx = {_floor('x', 100)} AND cy = {_floor('y', 100)}", "fx_sites", "fx_risk")
def g06(t):
    return G.sample(t.fx_sites, risk_cells(t), {"risk": 0}).select("nr_ref", c("risk").cast("bigint").alias("risk"), "valid")


@query("g07_census_code", f"SELECT bldg_id, 'CRS3035RES500mN' || ({_floor('y', 500)} * 500)::VARCHAR || 'E' || ({_floor('x', 500)} * 500)::VARCHAR AS code FROM fx_buildings", "fx_buildings")
def g07(t):
    return t.fx_buildings.select("bldg_id", G.census_code(c("x"), c("y")).alias("code"))


@query("g08_window_cells", SITES + ", " + WINDOW + " SELECT site_uid, cx, cy, round(dist, 6) AS dist FROM wn WHERE dist <= r_90", "fx_sites")
def g08(t):
    return G.window_cells(sites(t).select("site_uid", "x", "y", "r_90"), "r_90").select("site_uid", "cx", "cy", F.round("dist", 6).alias("dist"))


@query("g09_centre_cells", f"SELECT zone_id, cx, cy FROM {_box_cells('fx_risk', False)}", "fx_risk")
def g09(t):
    return G.box_cells(t.fx_risk).select("zone_id", "cx", "cy")


@query("g10_touched_cells", f"SELECT zone_id, cx, cy FROM {_box_cells('fx_risk', True)}", "fx_risk")
def g10(t):
    return G.box_cells(t.fx_risk, touched=True).select("zone_id", "cx", "cy")


def diamonds(t):
    """Zones as closed four-cornered rings."""
    w, h, x, y = c("w") / 2, c("h") / 2, c("xmin").cast("double"), c("ymin").cast("double")
    at = lambda px, py: F.struct(px.alias("x"), py.alias("y"))
    return t.fx_risk.withColumn("ring", F.array(at(x, y + h), at(x + w, y), at(x + 2 * w, y + h), at(x + w, y + 2 * h), at(x, y + h)))


def ringed(t):
    return diamonds(t).select("zone_id", F.array(F.struct(F.lit(0).alias("part"), c("ring").alias("points"))).alias("rings"))


def _diamond_cells(x: str, y: str, test: str) -> str:
    """Cells of each zone's box whose point (x, y) passes ``test`` on d, the sum of its distances from the middle in halves of width and height; 1 is the edge."""
    return f"""bx AS (SELECT zone_id, xmin, ymin, w, h, cy, unnest(range({_floor('xmin', 100)}, {_floor('xmin + w', 100)} + 1)) AS cx
      FROM (SELECT *, unnest(range({_floor('ymin', 100)}, {_floor('ymin + h', 100)} + 1)) AS cy FROM fx_risk)),
    dx AS (SELECT *, abs(2 * ({x}) - 2 * xmin - w) * h + abs(2 * ({y}) - 2 * ymin - h) * w - w * h AS d FROM bx)
    SELECT zone_id, cx, cy FROM dx WHERE {test}"""


# a centre on the left edges counts as inside, on the right edges not; a cell that the edge only touches counts as touched
@query("g09_ring_cells", _diamond_cells("cx * 100 + 50", "cy * 100 + 50", "d < 0 OR d = 0 AND 2 * (cx * 100 + 50) < 2 * xmin + w"), "fx_risk")
def g09_rings(t):
    return PG.fill_cells(ringed(t), "zone_id")


@query("g10_ring_cells_touched", _diamond_cells("least(greatest(xmin + w / 2e0, cx * 100), cx * 100 + 100)", "least(greatest(ymin + h / 2e0, cy * 100), cy * 100 + 100)", "d <= 0"), "fx_risk")
def g10_rings(t):
    return PG.fill_cells(ringed(t), "zone_id", touched=True)


_RISK = f"rc AS (SELECT cx, cy, max(risk) AS risk FROM {_box_cells('fx_risk', False)} GROUP BY ALL)"
_RUNS = _RISK + """, ru AS (SELECT risk, cy, min(cx) AS start, count(*) AS n FROM (SELECT *, cx - row_number() OVER (PARTITION BY risk, cy ORDER BY cx) AS g FROM rc) GROUP BY risk, cy, g)"""


def risk_cells(t):
    return G.box_cells(G.deal(t.fx_risk)).groupBy("cx", "cy").agg(F.max("risk").alias("risk"))


@query("g11_rectangles", _RUNS + " SELECT risk, start * 100 AS xmin, cy * 100 AS ymin, n * 100 AS w, 100::BIGINT AS h FROM ru", "fx_risk")
def g11(t):
    return G.rectangles(risk_cells(t), "risk")


@query("g12_areas", _RISK + " SELECT risk, (count(*) * 10000)::DOUBLE AS area_m2, count(*)::DOUBLE AS area_ha FROM rc GROUP BY risk", "fx_risk")
def g12(t):
    return G.areas(risk_cells(t), "risk")


@query(
    "g13_representative_points",
    f"""z AS (SELECT DISTINCT zone_id, cx, cy FROM {_box_cells('fx_risk', False)}), ru AS (SELECT zone_id, cy, min(cx) AS start, count(*) AS n FROM
      (SELECT *, cx - row_number() OVER (PARTITION BY zone_id, cy ORDER BY cx) AS g FROM z) GROUP BY zone_id, cy, g),
    k AS (SELECT *, row_number() OVER (PARTITION BY zone_id ORDER BY abs(cy * 2 - lo - hi), cy, n DESC, start) AS k FROM (SELECT *, min(cy) OVER (PARTITION BY zone_id) AS lo, max(cy) OVER (PARTITION BY zone_id) AS hi FROM ru))
    SELECT zone_id, (start + n / 2e0) * 100 AS x, (cy + 0.5e0) * 100 AS y FROM k WHERE k = 1""",
    "fx_risk",
)
def g13(t):
    return G.representative_points(G.box_cells(t.fx_risk).select("zone_id", "cx", "cy"), "zone_id")


@query("g14_area_and_length", "SELECT zone_id, w * h / 2e0 AS area, round(4 * sqrt((w / 2e0) ** 2 + (h / 2e0) ** 2), 6) AS length FROM fx_risk", "fx_risk")
def g14(t):
    return diamonds(t).select("zone_id", geo.ring_area(c("ring")).alias("area"), F.round(geo.line_length(c("ring")), 6).alias("length"))


@query("g15_geometry_checks", "SELECT count(*) AS n, count(*) FILTER (w * h = 0) AS zero_area, 0::BIGINT AS open_rings, 0::BIGINT AS short_rings, count(*) FILTER (zone_id IS NULL) AS missing_key FROM fx_risk", "fx_risk")
def g15(t):
    d, ring = diamonds(t), c("ring")
    return d.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(geo.ring_area(ring) == 0).alias("zero_area"), F.count_if(F.element_at(ring, 1) != F.element_at(ring, -1)).alias("open_rings"),
        F.count_if(F.size(ring) < 4).alias("short_rings"), F.count_if(c("zone_id").isNull()).alias("missing_key"),
    )


@query("g16_overlap_ratio", f"SELECT 1 - count(DISTINCT (cx, cy)) / count(*) AS ratio, count(*) AS cells FROM {_box_cells('fx_risk', False)}", "fx_risk")
def g16(t):
    return G.overlap_ratio(G.box_cells(G.deal(t.fx_risk)))


UNITS = "un AS (SELECT *, 8000 AS w, 10000 AS h FROM fx_admin)"


def units(t):
    return t.fx_admin.withColumns({"w": F.lit(8000), "h": F.lit(10000)})


@query(
    "g17_within_buffer",
    UNITS + """ SELECT unit_no, nr_ref, round(d, 6) AS distance FROM (SELECT un.unit_no, nr_ref, sqrt(greatest(xmin - x, 0, x - xmin - w) ** 2 + greatest(ymin - y, 0, y - ymin - h) ** 2) AS d FROM fx_sites, un) WHERE d <= 2000""",
    "fx_sites", "fx_admin",
)
def g17(t):
    return G.within_box(t.fx_sites.select("nr_ref", "x", "y"), units(t).select("unit_no", "xmin", "ymin", "w", "h"), 2000).select("unit_no", "nr_ref", F.round("distance", 6).alias("distance"))


# joins

@query("j01_left_lookup", "SELECT o_orderkey, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0")
def j01(t):
    rich = t.customer.where("c_acctbal > 0").select("c_custkey", "c_mktsegment")
    return t.orders.join(rich, c("o_custkey") == c("c_custkey"), "left").select("o_orderkey", "c_mktsegment")


@query(
    "j02_point_in_unit",
    UNITS + """, m AS (SELECT bldg_id, unit_no, (x > xmin AND x < xmin + w AND y > ymin AND y < ymin + h) AS i FROM fx_buildings JOIN un ON x BETWEEN xmin AND xmin + w AND y BETWEEN ymin AND ymin + h)
    SELECT b.bldg_id, max_by(unit_no, (i, unit_no)) AS unit_no FROM fx_buildings b LEFT JOIN m USING (bldg_id) GROUP BY b.bldg_id""",
    "fx_buildings", "fx_admin",
)
def j02(t):
    return J.assign_units(t.fx_buildings, units(t)).select("bldg_id", "unit_no")


@query(
    "j03_nearest_within",
    """m AS (SELECT zone_id, nr_ref, (xmin - x) ** 2 + (ymin - y) ** 2 AS d FROM fx_risk JOIN fx_sites ON abs(xmin - x) <= 500 AND abs(ymin - y) <= 500),
    k AS (SELECT *, rank() OVER (PARTITION BY zone_id ORDER BY d) AS k FROM m WHERE d <= 250000)
    SELECT z.zone_id, nr_ref, round(sqrt(d), 6) AS distance FROM fx_risk z LEFT JOIN k ON k.zone_id = z.zone_id AND k = 1""",
    "fx_risk", "fx_sites",
)
def j03(t):
    zones = t.fx_risk.select("zone_id", c("xmin").alias("x"), c("ymin").alias("y"))
    return J.nearest(zones, t.fx_sites, 500, "zone_id", "nr_ref").withColumn("distance", F.round("distance", 6))


@query("j04_nearest_site", SITES + ", " + WINDOW + " SELECT cx, cy, b.s AS site_uid, b.d AS dist FROM (SELECT cx, cy, min(struct_pack(d := round(dist, 6), s := site_uid)) AS b FROM wn WHERE dist <= r_85 GROUP BY ALL)", "fx_sites")
def j04(t):
    return J.nearest_site_of_cells(sites(t).select("site_uid", "x", "y", "r_85"), "r_85")


@query("j05_outer_zero_fill", "a AS (SELECT l_suppkey AS k, count(*) AS items FROM lineitem WHERE l_quantity > 49 GROUP BY ALL), b AS (SELECT s_suppkey AS k, count(*) AS suppliers FROM supplier WHERE s_acctbal > 0 GROUP BY ALL) SELECT k, coalesce(items, 0) AS items, coalesce(suppliers, 0) AS suppliers FROM a FULL JOIN b USING (k)")
def j05(t):
    a = t.lineitem.where("l_quantity > 49").groupBy(c("l_suppkey").alias("k")).agg(F.count(F.lit(1)).alias("items"))
    b = t.supplier.where("s_acctbal > 0").groupBy(c("s_suppkey").alias("k")).agg(F.count(F.lit(1)).alias("suppliers"))
    return a.join(b, "k", "full_outer").na.fill(0, ["items", "suppliers"])


@query("j06_anti_join", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def j06(t):
    return t.customer.join(t.orders.select(c("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("j07_semi_join", "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)")
def j07(t):
    big = t.orders.where("o_totalprice > 100000").select(c("o_custkey").alias("c_custkey"))
    return t.customer.join(big, "c_custkey", "left_semi").select("c_custkey")


@query(
    "j08_code_difference",
    "a AS (SELECT gmi AS code FROM fx_admin), b AS (SELECT DISTINCT substr(gmi, 1, 6) || '1' AS code FROM fx_admin) SELECT code, CASE WHEN a.code IS NULL THEN 'only_right' WHEN b.code IS NULL THEN 'only_left' ELSE 'both' END AS side, "
    "substr(code, 1, 6) IN (SELECT substr(code, 1, 6) FROM b) AS base_known FROM a FULL JOIN b USING (code)",
    "fx_admin",
)
def j08(t):
    a = t.fx_admin.select(c("gmi").alias("code"), F.lit(True).alias("l"))
    b = t.fx_admin.select(F.concat(F.substring("gmi", 1, 6), F.lit("1")).alias("code"), F.lit(True).alias("r")).distinct()
    base = b.select(F.substring("code", 1, 6).alias("base"), F.lit(True).alias("base_known")).distinct()
    side = F.when(c("l").isNull(), "only_right").when(c("r").isNull(), "only_left").otherwise("both")
    rows = a.join(b, "code", "full_outer").withColumn("base", F.substring("code", 1, 6)).join(base, "base", "left")
    return rows.select("code", side.alias("side"), F.coalesce("base_known", F.lit(False)).alias("base_known"))


_LEVELS = """re AS (SELECT DISTINCT substr(gmi, 1, 2) AS code, 'Province ' || substr(gmi, 1, 2) AS name FROM fx_admin UNION ALL SELECT DISTINCT substr(gmi, 1, 4), 'County ' || substr(gmi, 1, 4) FROM fx_admin
UNION ALL SELECT gmi, name FROM fx_admin)"""


def register_rows(t):
    """Three-level register: provinces, counties and communes with their own names."""
    a = t.fx_admin
    level = lambda n, word: a.select(F.substring("gmi", 1, n).alias("code")).distinct().withColumn("name", F.concat(F.lit(word), "code"))
    return level(2, "Province ").unionByName(level(4, "County ")).unionByName(a.select(c("gmi").alias("code"), "name"))


def with_parents(rows):
    """Communes with the names of their county and province."""
    of = lambda n, name: rows.where(F.length("code") == n).select(c("code").alias(f"{name}_code"), c("name").alias(f"{name}_name"))
    low = rows.where(F.length("code") == 7).withColumns({"woj_code": F.substring("code", 1, 2), "pow_code": F.substring("code", 1, 4)})
    return low.join(of(2, "woj"), "woj_code", "left").join(of(4, "pow"), "pow_code", "left")


@query("j09_parent_names", _LEVELS + " SELECT g.code, g.name, substr(g.code, 1, 2) AS woj_code, substr(g.code, 1, 4) AS pow_code, w.name AS woj_name, p.name AS pow_name FROM re g LEFT JOIN re w ON w.code = substr(g.code, 1, 2) LEFT JOIN re p ON p.code = substr(g.code, 1, 4) WHERE length(g.code) = 7", "fx_admin")
def j09(t):
    return with_parents(register_rows(t))


@query("j10_dictionary_names", "d AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'unit ' || s_suppkey::VARCHAR END AS known FROM supplier WHERE s_suppkey % 4 <> 1) SELECT unit_no, coalesce(nullif(known, ''), name) AS name FROM fx_admin LEFT JOIN d ON s_suppkey = unit_no", "fx_admin")
def j10(t):
    known = F.when(c("s_suppkey") % 3 == 0, "").otherwise(F.concat(F.lit("unit "), c("s_suppkey").cast("string")))
    names = t.supplier.where("s_suppkey % 4 <> 1").select(c("s_suppkey").alias("unit_no"), known.alias("known"))
    return t.fx_admin.join(names, "unit_no", "left").select("unit_no", F.coalesce(F.nullif("known", F.lit("")), "name").alias("name"))


_MEMBER = "ro AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN g.gmi ELSE '' END AS code, g.name AS name FROM customer JOIN fx_admin g ON g.unit_no = c_custkey % (SELECT count(*) FROM fx_admin))"


@query("j11_unit_membership", _MEMBER + " SELECT k, u.unit_no FROM ro JOIN fx_admin u ON CASE WHEN ro.code <> '' THEN ro.code = u.gmi ELSE ro.name = u.name END", "fx_admin")
def j11(t):
    """By code where there is one, else by name: two equi joins, not one condition on every pair."""
    n = t.fx_admin.agg(F.count(F.lit(1)).alias("n"))
    keyed = t.customer.join(n, F.lit(True)).select(c("c_custkey").alias("k"), (c("c_custkey") % c("n")).alias("unit_no"))
    rows = keyed.join(t.fx_admin.select("unit_no", "gmi", "name"), "unit_no").select("k", F.when(c("k") % 2 == 0, c("gmi")).otherwise("").alias("code"), "name")
    of = t.fx_admin.select("unit_no", "gmi", c("name").alias("unit_name"))
    by_code = rows.where("code <> ''").join(of, c("code") == c("gmi"))
    by_name = rows.where("code = ''").join(of, c("name") == c("unit_name"))
    return by_code.select("k", "unit_no").unionByName(by_name.select("k", "unit_no"))


@query("j12_unit_lookup", _LEVELS + " SELECT re.code, re.name, count(g.gmi) AS communes FROM re JOIN fx_admin g ON starts_with(g.gmi, re.code) GROUP BY ALL", "fx_admin")
def j12(t):
    """Each unit of any level with its communes: the commune names its three prefixes."""
    levels = t.fx_admin.select(F.explode(F.array(F.substring("gmi", 1, 2), F.substring("gmi", 1, 4), c("gmi"))).alias("code"))
    return levels.join(register_rows(t), "code").groupBy("code", "name").agg(F.count(F.lit(1)).alias("communes"))


# coverage

@query("a01_profiles", SITES + " SELECT nr_ref, prof_w, spl30, CASE WHEN moc_w <= 450 THEN 'nearest_profile_300' WHEN moc_w <= 750 THEN 'nearest_profile_600' WHEN moc_w <= 1050 THEN 'nearest_profile_900' ELSE 'nearest_profile_1200_or_cap' END AS rule FROM s1", "fx_sites")
def a01(t):
    return profiled(t).select("nr_ref", "prof_w", "spl30", "rule")


@query("a02_radii", SITES + " SELECT nr_ref, round(r_80, 6) AS r_80, round(r_85, 6) AS r_85, round(r_90, 6) AS r_90 FROM s1", "fx_sites")
def a02(t):
    return profiled(t).select("nr_ref", *(F.round(f"r_{d}", 6).alias(f"r_{d}") for d in DB))


@query("a03_colocated_sites", "SELECT x, y, count(*) AS n, min(nr_ref) AS first_ref, max(moc_w) AS top_power FROM fx_sites GROUP BY x, y HAVING count(*) > 1", "fx_sites")
def a03(t):
    return V.colocated(t.fx_sites)


@query("a04_dedup_sites", SITES + " SELECT site_uid, nr_ref, x, y, moc_w, site_cnt FROM sd", "fx_sites")
def a04(t):
    return sites(t).select("site_uid", "nr_ref", "x", "y", "moc_w", "site_cnt")


@query("a05_best_level", ", ".join([SITES, WINDOW, BEST]) + " SELECT cx, cy, b.level AS level, -b.neg AS site_uid FROM be", "fx_sites")
def a05(t):
    return V.best_levels(sites(t), DB[0])


@query("a06_clutter_cells", COVER + " SELECT * FROM cl", *COVER_FIXTURES)
def a06(t):
    return clutter(t)


@query("a07_building_cells", COVER + " SELECT * FROM bc", *COVER_FIXTURES)
def a07(t):
    return built(t)


@query("a08_attenuated_level", COVER + " SELECT * FROM atn", *COVER_FIXTURES)
def a08(t):
    return levels(t).select("cx", "cy", "level", "site_uid")


@query("a09_threshold_class", COVER + " SELECT cx, cy, CASE WHEN level >= 90 THEN 90 WHEN level >= 85 THEN 85 WHEN level >= 80 THEN 80 ELSE 0 END::INTEGER AS db FROM atn", *COVER_FIXTURES)
def a09(t):
    return levels(t).select("cx", "cy", "db")


@query("a10_covered_cells", COVER + " SELECT cx, cy, level, site_uid, db, site_uid * 1000 + db AS code FROM co", *COVER_FIXTURES)
def a10(t):
    return covered(t)


RANGES = "ra AS (SELECT site_uid, db, (count(*) * 10000)::DOUBLE AS area_m2, count(*)::DOUBLE AS area_ha FROM co GROUP BY ALL)"


@query("a11_ranges", COVER + ", " + RANGES + " SELECT ra.*, nr_ref, moc_w, prof_w, spl30 FROM ra JOIN sd USING (site_uid)", *COVER_FIXTURES)
def a11(t):
    return V.ranges(covered(t), sites(t))


@query("a12_coverage_summary", COVER + " SELECT db, count(*) AS cells, count(*)::DOUBLE AS area_ha, count(DISTINCT site_uid) AS sites FROM co GROUP BY db", *COVER_FIXTURES)
def a12(t):
    return covered(t).groupBy("db").agg(F.count(F.lit(1)).alias("cells"), F.count(F.lit(1)).cast("double").alias("area_ha"), F.count_distinct("site_uid").alias("sites"))


@query(
    "a13_ring_ranges",
    SITES + ", " + WINDOW + """, ne AS (SELECT cx, cy, min(struct_pack(d := round(dist, 6), s := site_uid)) AS b FROM wn WHERE dist <= r_80 GROUP BY ALL),
    rg AS (SELECT site_uid, CASE WHEN b.d <= r_90 THEN 90 WHEN b.d <= r_85 THEN 85 WHEN b.d <= r_80 THEN 80 ELSE 0 END AS db FROM ne JOIN sd ON site_uid = b.s)
    SELECT site_uid, db, (count(*) * 10000)::DOUBLE AS area_m2, count(*)::DOUBLE AS area_ha FROM rg WHERE db > 0 GROUP BY ALL""",
    "fx_sites",
)
def a13(t):
    return V.ring_ranges(J.nearest_site_of_cells(sites(t), "r_80", carry=tuple(f"r_{d}" for d in DB)), DB)


@query("a13_exact_ranges")
def a13_exact(t):
    """Ring areas of each site's own part of the plane, exact where ``a13_ring_ranges`` counts cells."""
    return voronoi.exact_ranges(sites(t), {d: f"r_{d}" for d in DB}).select("site_uid", "db", F.round("area_m2", 2).alias("area_m2"))


@query("a14_station_export", SITES + " SELECT site_uid, nr_ref, kind, moc_w, prof_w, spl30, site_cnt, x, y FROM sd", "fx_sites")
def a14(t):
    return sites(t).select("site_uid", "nr_ref", "kind", "moc_w", "prof_w", "spl30", "site_cnt", "x", "y")


@query("a15_coverage_checks", COVER + " SELECT count(*) FILTER (site_uid IS NULL) AS missing_site, count(DISTINCT db) AS classes, count(*) - count(DISTINCT (cx, cy)) AS overlap, count(*) AS cells FROM co", *COVER_FIXTURES)
def a15(t):
    """Distinct cells are counted as bits of words of 64 columns, so no cell is shuffled."""
    n = F.count(F.lit(1))
    words = G.words(covered(t), n.alias("n"), F.count_if(c("site_uid").isNull()).alias("missing"), *(F.max(c("db") == d).alias(f"has_{d}") for d in DB))
    classes = sum((F.coalesce(F.max(f"has_{d}").cast("bigint"), F.lit(0)) for d in DB), F.lit(0).cast("bigint"))
    cells = F.coalesce(F.sum("n"), F.lit(0))
    return words.agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("missing_site"), classes.alias("classes"), (cells - F.coalesce(F.sum("distinct"), F.lit(0))).alias("overlap"), cells.alias("cells"))


_LEV = "CASE levels WHEN '3' THEN 3 WHEN '2;4' THEN 2 ELSE 0 END::DOUBLE"


@query("a16_building_rows", f"SELECT osm_id, building AS bldg, {_LEV} AS levels, CASE WHEN height = '12,5' THEN 12.5 ELSE {_LEV} * 3 END::DOUBLE AS height_m FROM fx_tags WHERE building IS NOT NULL AND building <> 'no'", "fx_tags")
def a16(t):
    return V.building_rows(t.fx_tags)


_CLUT = """CASE WHEN landuse = 'forest' THEN 'forest' WHEN landuse = 'residential' THEN 'residential' WHEN landuse = 'meadow' THEN 'open_green' WHEN "natural" = 'scrub' THEN 'scrub' WHEN "natural" = 'water' THEN 'water'
WHEN leisure = 'park' THEN 'open_green' WHEN amenity = 'parking' THEN 'parking' END"""
_CROWS = f"cr AS (SELECT osm_id, {_CLUT} AS clutter FROM fx_tags WHERE (building IS NULL OR building = 'no') AND {_CLUT} IS NOT NULL)"


@query("a17_clutter_rows", _CROWS + " SELECT osm_id, clutter, CASE clutter WHEN 'forest' THEN 10 WHEN 'residential' THEN 6 WHEN 'open_green' THEN 1.5 WHEN 'scrub' THEN 5 WHEN 'water' THEN 0 ELSE 1 END::DOUBLE AS att_db FROM cr", "fx_tags")
def a17(t):
    return V.clutter_rows(t.fx_tags)


@query("a18_roads", "SELECT osm_id, highway, substr(name, 1, 8) AS name FROM fx_tags WHERE highway IN ('primary', 'track')", "fx_tags")
def a18(t):
    return V.roads(t.fx_tags)


@query(
    "a19_layer_counts",
    _CROWS + """, v AS (SELECT 'buildings' AS layer, building AS value FROM fx_tags WHERE building IS NOT NULL AND building <> 'no' UNION ALL SELECT 'clutter', clutter FROM cr
      UNION ALL SELECT 'roads', highway FROM fx_tags WHERE highway IN ('primary', 'track'))
    SELECT layer, value, n FROM (SELECT layer, value, count(*) AS n FROM v GROUP BY layer, value) QUALIFY row_number() OVER (PARTITION BY layer ORDER BY n DESC, value) <= 30""",
    "fx_tags",
)
def a19(t):
    layer = lambda name, df, col: df.select(F.lit(name).alias("layer"), c(col).alias("value"))
    tags = t.fx_tags
    rows = layer("buildings", V.building_rows(tags), "bldg").unionByName(layer("clutter", V.clutter_rows(tags), "clutter")).unionByName(layer("roads", V.roads(tags), "highway"))
    return V.layer_counts(rows)


