"""Goldens, invariants and edge cases of the coverage operators."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from earshot.functions import geo
from earshot.functions import scalars as S
from earshot.operators import audit, changes, components, coverage, grid, population, quantiles, risk, spatial_join, tiles, voronoi
from earshot.plans import registry
from earshot.sources import files
from tests.conftest import SF


def one(spark, **columns):
    row = spark.range(1)
    return row.select(*(c.alias(n) for n, c in columns.items())).first()


def test_radii(spark):
    got = one(spark, **{f"r{s}_{t}": F.round(coverage.radius(F.lit(s), t)) for s in (103, 109, 112, 115) for t in (65, 70, 75)})
    want = {103: (2383, 1340, 754), 109: (4755, 2674, 1504), 112: (6716, 3777, 2124), 115: (9487, 5335, 3000)}
    assert all(got[f"r{s}_{t}"] == w for s, three in want.items() for t, w in zip((65, 70, 75), three, strict=True))


def test_priority_score_golden(spark):
    people, ha = F.lit(4.4159), F.lit(5.0)
    got = one(spark, s=risk.priority_score(F.lit(0.0), F.lit(0.0), F.lit(2), F.lit(1.0), ha), c=risk.priority_class(F.lit(46.79)), a=risk.action_seed(F.lit(90.0), people, ha))
    assert got["s"] == 45.0 and got["c"] == "C" and got["a"] == "modernizacja_or_new"


def test_projection_round_trip(spark):
    df = spark.range(200).select((49 + F.col("id") % 6 + 0.123).alias("lat"), (14 + F.col("id") % 10 + 0.456).alias("lon"))
    e, n = geo.to_metric(F.col("lat"), F.col("lon"))
    back = df.withColumns({"e": e, "n": n})
    lat, lon = geo.to_degrees(F.col("e"), F.col("n"))
    off = back.select(F.max(F.abs(lat - F.col("lat"))).alias("a"), F.max(F.abs(lon - F.col("lon"))).alias("b")).first()
    assert off["a"] < 1e-9 and off["b"] < 1e-9
    centre = one(spark, e=geo.to_metric(F.lit(52.0), F.lit(19.0))[0], x=geo.to_equal_area(F.lit(52.0), F.lit(10.0))[0], y=geo.to_equal_area(F.lit(52.0), F.lit(10.0))[1])
    assert centre["e"] == 500000 and abs(centre["x"] - 4321000) < 1e-6 and abs(centre["y"] - 3210000) < 1e-6


def test_repair_text(spark):
    df = spark.createDataFrame([("Å\x81Ã³dÅº",), ("Łódź",), (None,), ("plain",), ("Ãx",)], "v string")
    assert [r[0] for r in df.select(S.repair_text(F.col("v"))).collect()] == ["Łódź", "Łódź", None, "plain", "Ãx"]


def test_rings(spark):
    square = "array(named_struct('x', 0D, 'y', 0D), named_struct('x', 300D, 'y', 0D), named_struct('x', 300D, 'y', 200D), named_struct('x', 0D, 'y', 200D), named_struct('x', 0D, 'y', 0D))"
    df = spark.sql(f"select {square} as ring")
    assert df.select(geo.ring_area(F.col("ring")), geo.line_length(F.col("ring"))).first()[:] == (60000.0, 1000.0)


def _reach(cells):
    left, out = set(cells), []
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            x, y = todo.pop()
            seen.add((x, y))
            for p in [(x + a, y + b) for a in (-1, 0, 1) for b in (-1, 0, 1)]:
                if p in left:
                    left.remove(p)
                    todo.append(p)
        out.append(frozenset(seen))
    return set(out)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sets(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=60))
def test_labels_are_components(spark, cells):
    df = spark.createDataFrame(sorted(cells), "cx bigint, cy bigint")
    got = {}
    for r in tiles.label_cells(df).collect():
        got.setdefault(r.gap_id, set()).add((r.cx, r.cy))
    assert {frozenset(v) for v in got.values()} == _reach(cells)
    assert all(k == min(y * components.KEY + x for x, y in v) for k, v in got.items())


def test_components_of_a_long_path(spark):
    edges = spark.range(500).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components.connected_components(edges).where("component = 0").count() == 501
    assert components.connected_components(edges.limit(0)).count() == 0


def test_population_is_kept(spark):
    grid_rows = spark.range(6).select(F.col("id").alias("cell_id"), F.col("id").alias("gx"), F.lit(0).cast("bigint").alias("gy"), (F.col("id") * 7).alias("tot"))
    kinds = ["house", "garage", "yes", "school", "apartments"]
    buildings = spark.createDataFrame([(i, kinds[i % 5], i % 3, i % 10, 30 + i, i % 5 * 500 + 3, 10) for i in range(40)], "bldg_id bigint, bldg string, levels bigint, height_m bigint, area_m2 bigint, x bigint, y bigint")
    scored = population.to_census(population.capacity_scores(buildings), grid_rows, 0, 0)
    models = population.cell_models(grid_rows, population.score_sums(scored))
    points = population.population_points(population.allocate(scored, models), population.residuals(grid_rows, models, 0, 0))
    off = population.balance(grid_rows, points).agg(F.max("off_night"), F.max("off_day")).first()
    assert max(off) < 1e-9


def test_replay_of_diff_gives_the_later_snapshot(spark):
    schema = "nr_ref string, moc string, h string"
    a = spark.createDataFrame([("A", "100", "0"), ("B", "5", "5"), ("C", "", None)], schema)
    b = spark.createDataFrame([("A", "100", "10"), ("C", "1", ""), ("D", "900", "3")], schema)
    registry = changes.diff(a, b, ("V1", "V2"))
    got = changes.replay(a, registry, ["V1→V2"])
    assert {tuple(r) for r in got.collect()} == {("A", "100", "10"), ("C", "1", ""), ("D", "900", "3")}
    assert {r.operation for r in registry.collect()} == {"add", "update", "disable"}
    assert changes.replay_violations(a, registry).count() == 0
    assert changes.diff(a, a, ("x", "y")).count() == 0 and tuple(changes.removed_columns(a, b.drop("h"), ("x", "y")).select("field", "filled").first()) == ("h", 2)


def test_empty_correction_still_overwrites(spark):
    base = spark.createDataFrame([("A", "x")], "nr_ref string, f string")
    fix = spark.createDataFrame([("A", "f", "")], "nr_ref string, field string, suggested string")
    assert changes.apply_cells(base, fix).first()["f"] == ""


def test_nearest_keeps_ties_and_misses(spark):
    left = spark.createDataFrame([(1, 0, 0), (2, 9000, 9000)], "l bigint, x bigint, y bigint")
    right = spark.createDataFrame([(1, 3, 4), (2, -3, -4), (3, 50, 0)], "r bigint, x bigint, y bigint")
    got = {tuple(r) for r in spatial_join.nearest(left, right, 100, "l", "r").collect()}
    assert got == {(1, 1, 5.0), (1, 2, 5.0), (2, None, None)}


def test_units_prefer_inside_then_last(spark):
    units = spark.createDataFrame([(1, 0, 0, 100, 100), (2, 100, 0, 100, 100), (3, 50, 0, 60, 100)], "unit_no bigint, xmin bigint, ymin bigint, w bigint, h bigint")
    points = spark.createDataFrame([(1, 20, 20), (2, 100, 50), (3, 55, 5), (4, 900, 900)], "point_id bigint, x bigint, y bigint")
    got = {r.point_id: r.unit_no for r in spatial_join.assign_units(points, units).collect()}
    assert got == {1: 1, 2: 3, 3: 3, 4: None}


def test_required_columns_fail_at_once(spark):
    with pytest.raises(ValueError, match="missing columns: b"):
        audit.require_columns(spark.range(1).withColumnRenamed("id", "a"), ["a", "b"])


def test_mode_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("g", v) for v in "bbaac"] + [("h", None)], "k string, v string")
    assert audit.mode_lookup(df, ["k"], "v", support=1, share=0).collect()[0]["value"] == "a"


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "lp bigint, nr_ref string, kind string, power double, height double")
    assert changes.impute_heights(empty).count() == 0
    sites = spark.createDataFrame([], "x bigint, y bigint, spl30 int, site_uid bigint")
    assert coverage.best_levels(sites, 80).count() == 0


def test_manifest_and_optional(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("abc")
    row = files.manifest(spark, f"file://{folder}").first()
    assert row["path"] == "in/a.txt" and row["size"] == 3 and row["sha256"].startswith("ba7816bf")
    assert files.read_optional(spark, f"file://{tmp_path}/none", "a string").count() == 0


def test_free_field_level_by_hand(spark):
    sites = spark.createDataFrame([(50, 50, 103, 1), (250, 50, 115, 2)], "x bigint, y bigint, spl30 int, site_uid bigint")
    got = {(r.cx, r.cy): (r.level, r.site_uid) for r in coverage.best_levels(sites, 100).collect()}
    assert got[(0, 0)] == (round(115 - 20 * math.log10(200 / 30), 6), 2) if 200 <= 30 * 10 ** (15 / 20) else got[(0, 0)] == (103.0, 1)


def test_quantiles_against_sorting(spark):
    draw = random.Random(11)
    values = [draw.choice([draw.gauss(0, 1e6), draw.randrange(5), 1e-9 * draw.random(), 7.0]) for _ in range(3000)] + [None, 1e18, -1e18]
    df = spark.createDataFrame([(i % 3, v if v is None else float(v)) for i, v in enumerate(values)], "g int, v double")
    for p in (0.0, 0.05, 0.5, 0.95, 0.999, 1.0):
        want = df.agg(F.percentile("v", p)).first()[0]
        assert quantiles.quantile(df, "v", p) == want and quantiles.quantile(df, "v", p, bins=2) == want
        by_group = {r.g: r.q for r in quantiles.grouped(df.groupBy("g", "v").count(), ["g"], "v", "count", p, "q").collect()}
        assert by_group == {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", p).alias("q")).collect()}
    assert quantiles.quantile(df.where("v > 1e30"), "v", 0.5) is None and quantiles.quantile(df.where("v = 7"), "v", 0.3) == 7.0


def test_no_aggregate_buffer_holds_a_table(spark):
    for name in ("c23_imputation_report", "d21_priority_gaps", "q13_median_mad", "q30_audit_summary", "r09_existing_recommendations"):
        plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().toString().lower()
        assert "percentile(" not in plan and "median(" not in plan


def test_repeated_flag_with_many_blanks(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 > 0, F.col("id") - F.col("id") % 4).alias("k"))
    got = audit.repeated_flag(df, F.col("k"), "d")
    counts = {}
    for r in df.collect():
        counts[r.k] = counts.get(r.k, 0) + 1
    assert got.where("d").count() == sum(n for n in counts.values() if n > 1) and got.count() == 900
    assert audit.repeated_flag(df.limit(0), F.col("k"), "d").count() == 0


@pytest.mark.parametrize("share", [0.3, 0.45, 0.7])
def test_labels_across_tiles(spark, share):
    draw = random.Random(int(share * 100))
    edge = tiles.TILE
    cells = {(x, y) for x in range(-9, 9) for y in range(edge - 9, edge + 9) if draw.random() < share}  # around a corner of four tiles
    cells |= {(x, 2 * edge - 1) for x in range(-200, 200)} | {(199, y) for y in range(edge + 20, 2 * edge)}  # a line through several
    df = spark.createDataFrame(sorted(cells), "cx bigint, cy bigint")
    got = {}
    for r in tiles.label_cells(df).collect():
        got.setdefault(r.gap_id, set()).add((r.cx, r.cy))
    assert {frozenset(v) for v in got.values()} == _reach(cells)
    assert all(k == min(y * components.KEY + x for x, y in v) for k, v in got.items())
    assert tiles.label_cells(df.limit(0)).count() == 0


def test_best_levels_of_a_crowded_tile(spark):
    draw = random.Random(8)
    sites = [(i, float(draw.randrange(-2000, 14_000)), float(draw.randrange(0, 3000)), float(draw.choice([103, 109, 115]))) for i in range(1, 80)]
    sites += [(i, 500.0, 500.0, 109.0) for i in range(100, 200)]  # equal levels: the smallest uid wins
    df = spark.createDataFrame(sites, "site_uid bigint, x double, y double, spl30 double")
    near = df.withColumn("r", coverage.radius(F.col("spl30"), 85))
    plain = {tuple(r) for r in tiles.best_packed(near, 30.0).collect()}
    assert plain == {tuple(r) for r in tiles.best_packed(near, 30.0, hot=7).collect()}
    want = {}
    for uid, x, y, spl in sites:
        r = 30 * 10 ** ((spl - 85) / 20)
        for cx in range(int((x - r) // 100), int((x + r) // 100) + 1):
            for cy in range(int((y - r) // 100), int((y + r) // 100) + 1):
                d = math.hypot((cx + 0.5) * 100 - x, (cy + 0.5) * 100 - y)
                if d <= r:
                    level = (round(spl - 20 * math.log10(max(d, 30) / 30), 6), -uid)
                    want[cx, cy] = max(want.get((cx, cy), level), level)
    got = {(r.cx, r.cy): (r.level, -r.site_uid) for r in coverage.best_levels(df, 85).collect()}
    assert got.keys() == want.keys() and all(abs(got[k][0] - want[k][0]) < 2e-6 and got[k][1] == want[k][1] for k in want)


def test_nearest_with_a_third_of_all_points_in_one_bin(spark):
    draw = random.Random(12)
    crowd = [(i, 5_000 + draw.randrange(60), 5_000 + draw.randrange(60)) for i in range(400)]
    right = [(1000 + i, draw.randrange(12_000), draw.randrange(12_000)) for i in range(800)] + crowd + [(5000, 5_010, 5_010), (5001, 5_010, 5_010), (5002, None, 3)]
    left = [(i, draw.randrange(-500, 12_500), draw.randrange(-500, 12_500)) for i in range(500)] + [(600 + i, 4_000 + draw.randrange(2_000), 4_000 + draw.randrange(2_000)) for i in range(300)] + [(999, 5_010, 5_010)]
    lefts, rights = spark.createDataFrame(left, "l bigint, x bigint, y bigint"), spark.createDataFrame(right, "r bigint, x bigint, y bigint")
    want = set()
    for key, x, y in left:
        far = [((x - rx) ** 2 + (y - ry) ** 2, r) for r, rx, ry in right if rx is not None]
        least = min(far)[0]
        want |= {(key, r, math.sqrt(d)) for d, r in far if d == least} if least <= 1_000**2 else {(key, None, None)}
    for leaf in (10, 10**6):
        assert {tuple(r) for r in spatial_join.nearest(lefts, rights, 1_000, "l", "r", leaf=leaf).collect()} == want
    places = rights.where("x is not null").select(F.col("x").cast("double").alias("rx"), F.col("y").cast("double").alias("ry")).distinct()
    levels = spatial_join._adaptive_grid(places, 1_000, 10)
    assert len(levels) > 3 and levels[-1].agg(F.max("n")).first()[0] <= 10
    pairs = spatial_join._reachable_leaves(lefts.withColumnRenamed("l", "lid").select("lid", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")), levels, 1_000)
    assert pairs.groupBy("lid").count().agg(F.avg("count")).first()[0] < 8  # a handful of leaves of at most ten places, not the crowd


def test_circle_and_polygon():
    square = [(-1.0, -1.0), (1.0, -1.0), (1.0, 1.0), (-1.0, 1.0)]
    assert voronoi.circle_area(square, 0.5) == pytest.approx(math.pi / 4)
    assert voronoi.circle_area(square, 1.0) == pytest.approx(math.pi)  # the sides touch the circle
    assert voronoi.circle_area(square, 2.0) == pytest.approx(4.0)
    assert voronoi.circle_area([(0.0, -9.0), (9.0, -9.0), (9.0, 9.0), (0.0, 9.0)], 2.0) == pytest.approx(2 * math.pi)
    assert voronoi.circle_area(square, 1.2) == pytest.approx(math.pi * 1.44 - 4 * (1.44 * math.acos(1 / 1.2) - math.sqrt(0.44)))


def test_exact_ranges_against_cells(spark):
    draw = random.Random(13)
    places = {(draw.randrange(9_000), draw.randrange(9_000)) for _ in range(40)} | {(4_000 + draw.randrange(90), 4_000 + draw.randrange(90)) for _ in range(60)}
    rows = [(i, float(x), float(y), 1_500.0 if i % 2 else 900.0, 600.0, 200.0) for i, (x, y) in enumerate(sorted(places), 1)]
    sites = spark.createDataFrame(rows, "site_uid bigint, x double, y double, r_65 double, r_70 double, r_75 double")
    radii = {65: "r_65", 70: "r_70", 75: "r_75"}
    got = {(r.site_uid, r.db): r.area_m2 for r in voronoi.exact_ranges(sites, radii).collect()}
    whole = {k: v for k, v in ((tuple(r)[:2], r.area_m2) for r in voronoi.exact_ranges(sites, radii, first_bin=1).collect())}
    assert got.keys() == whole.keys() and all(abs(got[k] - whole[k]) < 1e-3 for k in got)
    step, count = 20, {}
    for cx in range(-1_500 // step, 10_500 // step):
        for cy in range(-1_500 // step, 10_500 // step):
            x, y = (cx + 0.5) * step, (cy + 0.5) * step
            d, i = min((math.hypot(x - r[1], y - r[2]), r[0]) for r in rows if abs(x - r[1]) <= 1_500 and abs(y - r[2]) <= 1_500) if any(abs(x - r[1]) <= 1_500 and abs(y - r[2]) <= 1_500 for r in rows) else (9e9, 0)
            if i:
                db = 75 if d <= 200 else 70 if d <= 600 else 65 if d <= rows[i - 1][3] else 0
                count[i, db] = count.get((i, db), 0) + step * step
    for key, area in got.items():
        edge = 2 * math.pi * {65: 2_100, 70: 800, 75: 200}[key[1]]
        assert abs(area - count.get(key, 0)) <= edge * step, key
    total = sum(v for k, v in count.items() if k[1])
    assert abs(sum(got.values()) / total - 1) < 5e-3
    assert voronoi.exact_ranges(sites.limit(0), radii).count() == 0
