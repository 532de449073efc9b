"""Polygons with parts and holes against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from earshot.operators import polygons as P


def star(draw, x, y, n, low, high):
    return [(round(x + draw.uniform(low, high) * math.cos(2 * math.pi * k / n)), round(y + draw.uniform(low, high) * math.sin(2 * math.pi * k / n))) for k in range(n)]


def shapes(seed, count):
    """id -> [(part, ring)]: concave, some with holes, some in two parts, some overlapping others."""
    draw = random.Random(seed)
    out = {}
    for i in range(count):
        x, y = draw.randrange(3000), draw.randrange(3000)
        rings = [(0, star(draw, x, y, draw.randrange(3, 15), 150, 600))]
        if draw.random() < 0.6:
            rings.append((0, star(draw, x, y, draw.randrange(3, 8), 20, 120)))
        if draw.random() < 0.5:
            rings.append((1, [(x + 1500, y), (x + 1500, y + 300), (x + 1900, y + 300), (x + 1900, y)]))  # on cell lines
        out[i] = rings
    return out


def layer(spark, polygons):
    rows = [(i, part, k, pos, float(x), float(y)) for i, rings in polygons.items() for k, (part, ring) in enumerate(rings) for pos, (x, y) in enumerate(ring)]
    return P.from_vertices(spark.createDataFrame(rows, "id int, part int, ring int, pos int, x double, y double"), "id")


def edges(rings):
    return [(*a, *b) for _, r in rings for a, b in zip(r, r[1:] + r[:1]) if a != b]


def on_edge(rings, x, y):
    return any((bx - ax) * (y - ay) == (by - ay) * (x - ax) and min(ax, bx) <= x <= max(ax, bx) and min(ay, by) <= y <= max(ay, by) for ax, ay, bx, by in edges(rings))


def inside(rings, x, y):
    return sum((ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax for ax, ay, bx, by in edges(rings)) % 2 == 1


@pytest.mark.parametrize("cell", [70, 100])
def test_fill(spark, cell):
    polygons = shapes(1, 12)
    got = {tuple(r) for r in P.fill_cells(layer(spark, polygons), "id", cell=cell).collect()}
    span = range(-800 // cell, 5800 // cell)
    assert got == {(i, cx, cy) for i, rings in polygons.items() for cx in span for cy in span if inside(rings, (cx + 0.5) * cell, (cy + 0.5) * cell)}
    touched = {tuple(r) for r in P.fill_cells(layer(spark, polygons), "id", cell=cell, touched=True).collect()}
    assert got < touched


def test_location_with_edges_and_overlaps(spark):
    polygons = shapes(2, 25)
    draw = random.Random(3)
    points = [(k, float(draw.randrange(-300, 5000)), float(draw.randrange(-300, 4000))) for k in range(1500)]
    points += [(2000 + k, float(x), float(y)) for k, (x, y) in enumerate((x, y) for rings in polygons.values() for _, ring in rings for x, y in ring)]  # the corners themselves
    points += [(5000, None, 1.0)]
    df = spark.createDataFrame(points, "k int, x double, y double")
    shape = layer(spark, polygons)
    for cell, hot in ((1000, 10**6), (250, 20)):
        got = {r.k: {(f.inside, f.key) for f in r.found} for r in P.locate(df, shape, "id", cell, hot).collect()}
        for k, x, y in points:
            want = set()
            for i, rings in polygons.items():
                if x is not None and (on_edge(rings, x, y) or inside(rings, x, y)):
                    want.add((not on_edge(rings, x, y), i))
            assert got[k] == want, (k, x, y)
    assigned = {r.k: r.id for r in P.assign(df, shape, "id").collect()}
    assert assigned == {k: max(v)[1] if v else None for k, v in got.items()}
    assert {r.k for r in P.mask(df, shape, "id").collect()} == {k for k, v in got.items() if v}


def test_a_hot_cell_is_dealt_over_tasks(spark):
    shape = layer(spark, {1: [(0, [(0, 0), (900, 0), (0, 900)])]})
    points = spark.range(3000).select("id", F.lit(300.0).alias("x"), F.when(F.col("id") < 1000, 300.0).otherwise(700.0).alias("y"))
    found = P.locate(points.withColumnRenamed("id", "k"), shape, "id", hot=100)
    assert found.groupBy(F.size("found").alias("n")).count().collect() and found.where(F.size("found") == 1).count() == 1000 and found.count() == 3000


def test_ring_of_100000_corners(spark):
    n = 100_000
    wave = lambda k: 40_000 + 3_000 * math.sin(2 * math.pi * 500 * k / n)
    ring = [(wave(k) * math.cos(2 * math.pi * k / n), wave(k) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    shape = layer(spark, {1: [(0, ring), (0, [(x / 2, y / 2) for x, y in ring])]})
    cells = P.fill_spans(shape, "id").agg(F.sum(F.col("cx1") - F.col("cx0") + 1)).first()[0]
    area = abs(sum(ax * by - bx * ay for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]))) / 2
    assert abs(cells * 1e4 / (area * 0.75) - 1) < 1e-3
    draw = random.Random(4)
    points = [(k, draw.uniform(-45e3, 45e3), draw.uniform(-45e3, 45e3)) for k in range(500)]
    got = {r.k: r.id for r in P.assign(spark.createDataFrame(points, "k int, x double, y double"), shape, "id", cell=500).collect()}
    rings = [(0, ring), (0, [(x / 2, y / 2) for x, y in ring])]
    for k, x, y in points[:60]:
        assert (got[k] == 1) == inside(rings, x, y)


def test_inner_points(spark):
    polygons = shapes(5, 60)
    got = {r.id: (r.x, r.y) for r in P.representative_points(layer(spark, polygons), "id").collect()}
    assert len(got) == 60 and all(inside(polygons[i], *p) and not on_edge(polygons[i], *p) for i, p in got.items())


def test_distance(spark):
    polygons = shapes(6, 15)
    draw = random.Random(7)
    points = [(k, float(draw.randrange(-900, 5500)), float(draw.randrange(-900, 4500))) for k in range(300)]
    got = {(r.k, r.id): r.distance for r in P.within_distance(spark.createDataFrame(points, "k int, x double, y double"), "k", layer(spark, polygons), "id", 250.0).collect()}

    def far(x, y, e):
        ax, ay, bx, by = e
        t = max(0, min(1, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / ((bx - ax) ** 2 + (by - ay) ** 2)))
        return math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay))

    want = {}
    for k, x, y in points:
        for i, rings in polygons.items():
            d = 0.0 if inside(rings, x, y) or on_edge(rings, x, y) else min(far(x, y, e) for e in edges(rings))
            if d <= 250:
                want[k, i] = d
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-6 for p in want)


@pytest.mark.parametrize("share", [0.35, 0.6, 0.85])
def test_traced_outlines_fill_the_same_cells(spark, share):
    draw = random.Random(int(share * 100))
    cells = [(key, x, y) for key in ("a", "b") for x in range(-12, 12) for y in range(14) if draw.random() < share]
    outlines = P.trace(spark.createDataFrame(cells, "key string, cx bigint, cy bigint"), "key")
    rows = outlines.collect()
    back = {tuple(r) for r in P.fill_cells(P.to_layer(outlines, "key"), "key").collect()}
    assert back == set(cells)
    by_piece = {}
    for key, piece, x, y in map(tuple, P.fill_cells(P.to_layer(outlines, "key", "piece"), "key", "piece").collect()):
        by_piece.setdefault((key, piece), set()).add((x, y))
    assert sorted(map(sorted, by_piece.values())) == sorted(map(sorted, pieces(cells)))
    assert all(sum(not r.hole for r in rows if (r.key, r.piece) == p) == 1 for p in by_piece)


def pieces(cells):
    """Cells of one key that hang together over sides."""
    left, out = set(cells), []
    while left:
        key, x, y = todo = left.pop()
        piece, todo = {(x, y)}, [(x, y)]
        while todo:
            x, y = todo.pop()
            for near in ((x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)):
                if (key, *near) in left:
                    left.discard((key, *near))
                    piece.add(near)
                    todo.append(near)
        out.append(piece)
    return out


def test_empty_layers(spark):
    none = P.from_vertices(spark.createDataFrame([], "id int, part int, ring int, pos int, x double, y double"), "id")
    points = spark.createDataFrame([(1, 0.0, 0.0)], "k int, x double, y double")
    assert P.fill_cells(none, "id", touched=True).count() == 0 and P.assign(points, none, "id").collect()[0].id is None
    assert P.trace(spark.createDataFrame([], "key string, cx bigint, cy bigint"), "key").count() == 0
    assert P.within_distance(points, "k", none, "id", 10.0).count() == 0 and P.representative_points(none, "id").count() == 0
