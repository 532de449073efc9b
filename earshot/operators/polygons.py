"""Polygons with parts and holes: fill, point location, tracing, points inside, distance.

A layer has key columns and ``rings``: an array of (part, points), each a closed ring of
(x, y). Outer rings and holes of all parts lie side by side; what is inside follows from
parity: a point is inside where an odd number of edges cross the ray to its right. Sides of
edges are told by cross products, which are exact for coordinates in whole (or half) metres.
Work grows with the edges and the cells they and the spans between them meet; no step
holds a polygon's area, and none walks all vertices for each cell or point.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earshot.operators.grid import CELL, _span, cell_of, on_cells
from earshot.operators.outlines import chains
from earshot.sources.storage import materialize

#: Where a cell's anchor lies in it: off every lattice, so that no vertex or lattice line meets it.
ANCHOR_X, ANCHOR_Y = 0.381966011250105, 0.276393202250021
#: A cell with more points than this is dealt over several tasks.
HOT_POINTS = 1_000_000

c = F.col


def from_vertices(vertices: DataFrame, *keys: str) -> DataFrame:
    """A layer of a vertex table (keys, part, ring, pos, x, y): rings are put in order of pos and
    closed. Rings of fewer than three points bound nothing and change nothing."""
    points = F.transform(F.sort_array(F.collect_list(F.struct("pos", "x", "y"))), lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")))
    rings = vertices.groupBy(*keys, "part", "ring").agg(points.alias("points"))
    closed = F.when(F.element_at("points", 1) == F.element_at("points", -1), c("points")).otherwise(F.concat("points", F.slice("points", 1, 1)))
    ordered = F.sort_array(F.collect_list(F.struct("part", "ring", closed.alias("points"))))
    return rings.groupBy(*keys).agg(F.transform(ordered, lambda r: F.struct(r["part"].alias("part"), r["points"].alias("points"))).alias("rings"))


def edges(layer: DataFrame, *keys: str) -> DataFrame:
    """(keys, part, ax, ay, bx, by): a row for each edge that has a length."""

    def of(ring: Column) -> Column:
        n = F.size(ring["points"])
        a, b = F.slice(ring["points"], F.lit(1), n - 1), F.slice(ring["points"], F.lit(2), n - 1)
        fields = lambda p, q: (ring["part"].alias("part"), p["x"].alias("ax"), p["y"].alias("ay"), q["x"].alias("bx"), q["y"].alias("by"))
        return F.zip_with(a, b, lambda p, q: F.struct(*fields(p, q)))

    rows = layer.select(*keys, F.explode("rings").alias("ring")).where(F.size("ring.points") > 1)
    return rows.select(*keys, F.explode(of(c("ring"))).alias("e")).select(*keys, "e.*").where("ax <> bx or ay <> by")


def _crossings(edge_rows: DataFrame, keys: list[str], cell: int, shift: float) -> DataFrame:
    """(keys, cy, xs): where edges cross the line y = (cy + shift) * cell, ascending. An edge holds its lower end, not its upper."""
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    rows = edge_rows.withColumn("cy", F.explode(_span(F.ceil(low / cell - shift).cast("bigint"), F.ceil(high / cell - shift).cast("bigint") - 1)))
    y = (c("cy") + shift) * cell
    rows = rows.withColumn("x", (c("bx") - c("ax")) * (y - c("ay")) / (c("by") - c("ay")) + c("ax"))
    return rows.groupBy(*keys, "cy").agg(F.sort_array(F.collect_list("x")).alias("xs"))


def _spans(xs: Column) -> Column:
    """Crossings in pairs: from each odd one to the next the line runs inside."""
    starts = F.sequence(F.lit(0), F.size(xs) - 2, F.lit(2))
    return F.transform(starts, lambda i: F.struct(F.get(xs, i).alias("a"), F.get(xs, i + 1).alias("b")))


def fill_spans(layer: DataFrame, *keys: str, cell: int = CELL) -> DataFrame:
    """(keys, cy, cx0, cx1): unbroken runs of cells whose centre is inside, by rows. A centre on a left
    edge is inside, on a right edge not."""
    xs = _crossings(edges(layer, *keys), list(keys), cell, 0.5)
    rows = xs.where(F.size("xs") > 1).select(*keys, "cy", F.explode(_spans(c("xs"))).alias("s"))
    first = lambda v: F.ceil(c(v) / cell - 0.5).cast("bigint")
    return rows.select(*keys, "cy", first("s.a").alias("cx0"), (first("s.b") - 1).alias("cx1")).where("cx1 >= cx0")


def _meets(x: Column, y: Column, side: float) -> Column:
    """Whether the edge meets the closed square at (x, y)."""
    ax, ay, bx, by = c("ax"), c("ay"), c("bx"), c("by")
    box = (F.least(ax, bx) <= x + side) & (F.greatest(ax, bx) >= x) & (F.least(ay, by) <= y + side) & (F.greatest(ay, by) >= y)
    cross = lambda px, py: (bx - ax) * (py - ay) - (by - ay) * (px - ax)
    corners = [cross(x, y), cross(x + side, y), cross(x, y + side), cross(x + side, y + side)]
    return box & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)


def edge_cells(edge_rows: DataFrame, cell: int = CELL) -> DataFrame:
    """Edges once per cell whose closed square they meet: rows first, then in each row only the columns
    around the edge's part in it."""
    ax, ay, bx, by = c("ax"), c("ay"), c("bx"), c("by")
    low, high = F.least(ay, by), F.greatest(ay, by)
    rows = edge_rows.withColumn("cy", F.explode(_span(F.ceil(low / cell).cast("bigint") - 1, F.floor(high / cell).cast("bigint"))))
    at = lambda y: F.when(ay == by, ax).otherwise((bx - ax) * (F.least(F.greatest(y, low), high) - ay) / (by - ay) + ax)
    one, two = at((c("cy") * cell).cast("double")), at(((c("cy") + 1) * cell).cast("double"))
    flat = ay == by
    first = F.when(flat, F.least(ax, bx)).otherwise(F.least(one, two))
    last = F.when(flat, F.greatest(ax, bx)).otherwise(F.greatest(one, two))
    # one cell more on either side, then the exact test: rounding never decides
    rows = rows.withColumn("cx", F.explode(_span(F.floor(first / cell).cast("bigint") - 1, F.floor(last / cell).cast("bigint") + 1)))
    return rows.where(_meets(c("cx") * cell, c("cy") * cell, cell))


def _touched_rows(layer: DataFrame, keys: list[str], cell: int) -> DataFrame:
    """(keys, cy, cxs): the touched cells of each polygon by rows, from one walk over its edges: an edge meets unbroken cells
    of a row, found at both ends by the exact test, and crosses the row's middle at most once."""
    least = lambda v: cell_of(F.array_min(F.transform(F.flatten("rings.points"), lambda p: p[v])), cell)
    rows = edges(layer.withColumns({"__x0": least("x"), "__y0": least("y")}), *keys, "__x0", "__y0")
    ax, ay, bx, by = c("ax"), c("ay"), c("bx"), c("by")
    low, high = F.least(ay, by), F.greatest(ay, by)
    rows = rows.withColumn("cy", F.explode(_span(F.ceil(low / cell).cast("bigint") - 1, F.floor(high / cell).cast("bigint"))))
    at = lambda y: (bx - ax) * (y - ay) / (by - ay) + ax
    end = lambda k: at(F.least(F.greatest((c("cy") + k) * cell, low), high))
    flat = ay == by
    first = F.floor(F.when(flat, F.least(ax, bx)).otherwise(F.least(end(0), end(1))) / cell).cast("bigint") - 1
    last = F.floor(F.when(flat, F.greatest(ax, bx)).otherwise(F.greatest(end(0), end(1))) / cell).cast("bigint") + 1
    rows = rows.withColumns({"__first": first, "__last": last})
    # rounding is off by a cell at most, and the exact test decides
    meets = lambda v: F.when(_meets(v * cell, c("cy") * cell, cell), v)
    cx0 = F.greatest(F.coalesce(*(meets(c("__first") + i) for i in range(3))), c("__x0"))
    cx1 = F.coalesce(*(meets(c("__last") - i) for i in range(3)))
    middle = (c("cy") + 0.5) * cell
    crossing = F.when((low <= middle) & (middle < high), at(middle))
    rows = rows.select(*keys, "cy", "__y0", cx0.alias("cx0"), cx1.alias("cx1"), crossing.alias("x"))
    met = F.when((c("cy") >= c("__y0")) & (c("cx1") >= c("cx0")), F.struct("cx0", "cx1"))
    held = rows.groupBy(*keys, "cy").agg(F.sort_array(F.collect_list("x")).alias("xs"), F.collect_set(met).alias("met"))
    none = F.array().cast("array<struct<cx0:bigint,cx1:bigint>>")
    inner = lambda s: F.struct(F.ceil(s["a"] / cell - 0.5).cast("bigint").alias("cx0"), (F.ceil(s["b"] / cell - 0.5).cast("bigint") - 1).alias("cx1"))
    spans = F.when(F.size("xs") > 1, F.transform(_spans(c("xs")), inner)).otherwise(none)
    runs = F.transform(F.concat("met", spans), lambda r: _span(r["cx0"], r["cx1"]))
    return held.select(*keys, "cy", F.array_distinct(F.flatten(runs)).alias("cxs"))


def fill_cells(layer: DataFrame, *keys: str, cell: int = CELL, touched: bool = False) -> DataFrame:
    """(keys, cx, cy): cells whose centre is inside; with ``touched`` those, too, whose closed square an edge
    meets, from the cell of the polygon's least x and y on: what lies left of it or below isn't touched by a line
    on the cell's own edge."""
    if touched:
        return _touched_rows(layer, list(keys), cell).select(*keys, F.explode("cxs").alias("cx"), "cy")
    spans = fill_spans(layer, *keys, cell=cell)
    return spans.select(*keys, F.explode(_span(c("cx0"), c("cx1"))).alias("cx"), "cy")


def touched_cells(layer: DataFrame, *keys: str, cell: int = CELL) -> DataFrame:
    """(cx, cy): every cell that any polygon covers or touches, once. Cells are shuffled as bits, 64 columns of a row in a word."""
    cells = fill_cells(layer, *keys, cell=cell, touched=True)
    held = cells.groupBy("cy", F.shiftright("cx", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(cx, 64) as int))")).alias("bits"))
    places = F.filter(F.sequence(F.lit(0), F.lit(63)), lambda i: F.getbit("bits", i) == 1)
    return held.select("cy", "word", F.explode(places).alias("i")).select((c("word") * 64 + c("i")).alias("cx"), "cy")


# point location


def cell_index(layer: DataFrame, key: str, cell: int = 1000) -> DataFrame:
    """(cx, cy, held): for each cell a list of (key, parity, edges) of the polygons there. A cell that no edge
    meets has none and lies inside (polygons all round it aren't listed); else ``parity`` tells whether the cell's
    anchor is inside, and the edges are those that meet the cell."""
    rows, edge = edges(layer, key), F.struct("ax", "ay", "bx", "by")
    spans = _crossings(rows, [key], cell, ANCHOR_Y).where(F.size("xs") > 1).select(key, "cy", F.explode(_spans(c("xs"))).alias("s"))
    first = lambda v: F.ceil(c(v) / cell - ANCHOR_X).cast("bigint")
    none = F.lit(None).cast("struct<ax:double,ay:double,bx:double,by:double>")
    # a cell's edges and a row if its anchor is inside meet in one grouping, so the edges are walked once and nothing is joined
    border = edge_cells(rows, cell).select(key, "cx", "cy", edge.alias("edge"), F.lit(False).alias("odd"))
    inner = spans.select(key, F.explode(_span(first("s.a"), first("s.b") - 1)).alias("cx"), "cy", none.alias("edge"), F.lit(True).alias("odd"))
    both = border.unionByName(inner).groupBy(key, "cx", "cy").agg(F.collect_list("edge").alias("edges"), F.max("odd").alias("parity"))
    return both.groupBy("cx", "cy").agg(F.collect_list(F.struct(c(key).alias("key"), "parity", "edges")).alias("held"))


def _on(e: Column, x: Column, y: Column) -> Column:
    cross = (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])
    return (cross == 0) & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])) & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))


def _crossed(e: Column, x: Column, y: Column, px: Column, py: Column) -> Column:
    """How often the way from the anchor (px, py), first up or down, then sideways, to (x, y) crosses the edge."""
    side = lambda qx, qy: (e["bx"] - e["ax"]) * (qy - e["ay"]) - (e["by"] - e["ay"]) * (qx - e["ax"])
    # below the point: turned so that the edge runs to the right, the point lies on its left; a level edge at its height counts as below
    below = lambda qy: F.when(e["bx"] > e["ax"], side(px, qy) >= 0).otherwise(side(px, qy) <= 0)
    upright = ((e["ax"] > px) != (e["bx"] > px)) & (below(y) != below(py))
    right = lambda qx: F.when(e["by"] > e["ay"], side(qx, y) > 0).otherwise(side(qx, y) < 0)
    level = ((e["ay"] > y) != (e["by"] > y)) & (right(px) != right(x))
    return upright.cast("int") + level.cast("int")


def locate(points: DataFrame, layer: DataFrame, key: str, cell: int = 1000, hot: int = HOT_POINTS) -> DataFrame:
    """``points`` (x, y) with ``found``: an array of (inside, key) of all polygons that hold the point
    (inside true) or have it on their edge (false). Points with null coordinates find nothing.

    A point meets the list of its cell and tests the few edges there. A cell with more than ``hot``
    points is dealt over several tasks, each with the cell's list."""
    index = cell_index(layer, key, cell)
    at = points.withColumns({"__cx": cell_of(c("x"), cell), "__cy": cell_of(c("y"), cell)})
    full = at.groupBy("__cx", "__cy").agg(F.count(F.lit(1)).alias("n")).where(c("n") > hot)
    full = materialize(full.select("__cx", "__cy", F.ceil(c("n") / hot).cast("int").alias("__shares")), "hot-cells")
    at = at.join(F.broadcast(full), ["__cx", "__cy"], "left") if full.count() <= 100_000 else on_cells(at, full, ["__cx", "__cy"], "left")
    at = at.withColumn("__share", F.coalesce(F.floor(F.rand(7) * c("__shares")).cast("int"), F.lit(0))).drop("__shares")
    held = index.join(full, (c("cx") == c("__cx")) & (c("cy") == c("__cy")), "left")
    held = held.select(c("cx").alias("__cx"), c("cy").alias("__cy"), F.explode(F.sequence(F.lit(0), F.coalesce("__shares", F.lit(1)) - 1)).alias("__share"), c("held").alias("__held"))
    x, y = c("x").cast("double"), c("y").cast("double")
    px, py = (c("__cx") + ANCHOR_X) * cell, (c("__cy") + ANCHOR_Y) * cell

    def test(p: Column) -> Column:
        ways = F.aggregate(p["edges"], F.lit(0), lambda n, e: n + _crossed(e, x, y, px, py))
        inside = p["parity"] != (ways % 2 == 1)
        on = F.exists(p["edges"], lambda e: _on(e, x, y))
        return F.when(on, F.struct(F.lit(False).alias("inside"), p["key"].alias("key"))).when(inside, F.struct(F.lit(True).alias("inside"), p["key"].alias("key")))

    met = on_cells(at, held, ["__cx", "__cy", "__share"], "left")
    kind = index.schema["held"].dataType.elementType["key"].dataType.simpleString()
    found = F.coalesce(F.array_compact(F.transform("__held", test)), F.array().cast(f"array<struct<inside:boolean,key:{kind}>>"))
    return met.withColumn("found", found).drop("__cx", "__cy", "__share", "__held")


def assign(points: DataFrame, layer: DataFrame, key: str, cell: int = 1000, hot: int = HOT_POINTS) -> DataFrame:
    """``points`` with the key of the polygon that holds them, null where none does: one that holds the point
    inside goes before one with the point on its edge; of several, the last key."""
    found = locate(points, layer, key, cell, hot)
    return found.withColumn(key, F.array_max("found")["key"]).drop("found")


def mask(points: DataFrame, layer: DataFrame, key: str, cell: int = 1000) -> DataFrame:
    """``points`` inside any polygon or on its edge."""
    return locate(points, layer, key, cell).where(F.size("found") > 0).drop("found")


# points inside and distances


def representative_points(layer: DataFrame, key: str) -> DataFrame:
    """(key, x, y): a point inside each polygon. Each part is cut by a level line halfway between the vertices
    next to its middle, so no vertex lies on it; the middle of the widest inner span of all parts is taken."""
    rows = edges(layer, key)
    low = rows.groupBy(key, "part").agg(((F.min(F.least("ay", "by")) + F.max(F.greatest("ay", "by"))) / 2).alias("mid"))
    ends = rows.join(low, [key, "part"])
    line = ends.groupBy(key, "part").agg(F.max(F.when(c("ay") <= c("mid"), c("ay"))).alias("below"), F.min(F.when(c("ay") > c("mid"), c("ay"))).alias("above"))
    line = line.select(key, "part", ((c("below") + c("above")) / 2).alias("y"))
    met = rows.join(line, [key, "part"]).where((c("ay") > c("y")) != (c("by") > c("y")))
    x = (c("bx") - c("ax")) * (c("y") - c("ay")) / (c("by") - c("ay")) + c("ax")
    cut = met.groupBy(key, "part", "y").agg(F.sort_array(F.collect_list(x)).alias("xs"))
    rows = cut.select(key, "part", "y", F.explode(_spans(c("xs"))).alias("s"))
    best = rows.groupBy(key).agg(F.min(F.struct((c("s.a") - c("s.b")).alias("w"), "part", c("s.a").alias("a"), c("s.b").alias("b"), "y")).alias("m"))
    return best.select(key, ((c("m.a") + c("m.b")) / 2).alias("x"), c("m.y").alias("y"))


def within_distance(points: DataFrame, point_key: str, layer: DataFrame, key: str, reach: float) -> DataFrame:
    """(point_key, key, distance): every point no farther than ``reach`` from a polygon, 0 inside.

    Edges are cut into pieces of at most ``reach``, each is listed in the bins of that size that its box meets, and a
    point, of which there are fewer, takes the least distance over the pieces of the nine bins around its own."""
    n = F.ceil(F.hypot(c("bx") - c("ax"), c("by") - c("ay")) / reach).cast("int")
    pieces = edges(layer, key).withColumn("n", F.greatest(n, F.lit(1))).withColumn("i", F.explode(F.sequence(F.lit(0), c("n") - 1)))
    at = lambda a, b, i: c(a) + (c(b) - c(a)) * i / c("n")
    ends = {"x1": at("ax", "bx", c("i")), "y1": at("ay", "by", c("i")), "x2": at("ax", "bx", c("i") + 1), "y2": at("ay", "by", c("i") + 1)}
    # distances are taken to whole edges, so that cutting does not move them
    pieces = pieces.withColumns(ends)
    bins = lambda a, b: F.explode(_span(cell_of(F.least(a, b), reach), cell_of(F.greatest(a, b), reach)))
    pieces = pieces.withColumn("bx_", bins("x1", "x2")).withColumn("by_", bins("y1", "y2")).select(key, "ax", "ay", "bx", "by", "bx_", "by_")
    px, py = c("x").cast("double"), c("y").cast("double")
    around = lambda v: F.explode(_span(cell_of(v, reach) - 1, cell_of(v, reach) + 1))
    asked = points.select(point_key, px.alias("x"), py.alias("y")).withColumn("bx_", around(c("x"))).withColumn("by_", around(c("y")))
    near = on_cells(asked, pieces, ["bx_", "by_"])
    dx, dy = c("bx") - c("ax"), c("by") - c("ay")
    along = F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((c("x") - c("ax")) * dx + (c("y") - c("ay")) * dy) / (dx * dx + dy * dy)))
    far = F.hypot(c("x") - c("ax") - along * dx, c("y") - c("ay") - along * dy)
    outer = near.withColumn("distance", far).where(c("distance") <= reach).select(point_key, key, "distance")
    inner = locate(points.select(point_key, "x", "y"), layer, key).select(point_key, F.explode("found").alias("f")).select(point_key, c("f.key").alias(key), F.lit(0.0).alias("distance"))
    return outer.unionByName(inner).groupBy(point_key, key).agg(F.min("distance").alias("distance"))


# cells to polygons


def trace(cells: DataFrame, key: str, cell: int = CELL, most_rounds: int = 60) -> DataFrame:
    """(key, piece, ring, hole, area, points): the outlines of the cells of each key as closed rings, outer ones to the
    left and holes to the right, with corners only. Pieces hang together over sides; cells that touch at a
    corner are pieces of their own. ``piece`` is the id of the outer ring, so a piece's rings share it.

    Sides are walked within tiles (``outlines.chains``), so only corners leave a task. Rings over several tiles are put together
    from their chains by pointer doubling (each round a join of those chains with themselves, written down), so no task holds a
    key's area. A hole belongs to the ring left of it in the row of its leftmost side, or to that ring's, until an outer ring is met."""
    found = materialize(chains(cells, key), "chains")
    open_ = found.where("next is not null and not closed").select(key, "id", "next")
    state = materialize(open_.select(key, "id", c("next").alias("jump"), F.least("id", "next").alias("ring")), "rings")
    for _ in range(most_rounds):
        ahead = state.select(key, c("id").alias("jump"), c("jump").alias("jump2"), c("ring").alias("ring2"))
        state2 = on_cells(state, ahead, [key, "jump"]).select(key, "id", c("jump2").alias("jump"), F.least("ring", "ring2").alias("ring"), (c("ring2") < c("ring")).alias("changed"))
        state2 = materialize(state2, "rings")
        state = state2.drop("changed")
        if state2.where("changed").isEmpty():
            break
    else:
        raise RuntimeError(f"rings have not closed in {most_rounds} rounds")
    owned = F.when(c("x").isNotNull(), F.struct("x", "cy", "owner")).alias("m")
    whole = found.where("closed").select(key, c("id").alias("ring"), F.arrays_zip("xs", "ys").alias("held"), owned)
    several = on_cells(found.where("next is not null and not closed"), state.select(key, "id", "ring"), [key, "id"])
    pieces = several.groupBy(key, "ring").agg(F.sort_array(F.collect_list(F.struct("id", "next", "xs", "ys"))).alias("parts"), F.min(owned).alias("m"))

    def order(parts: pd.Series) -> pd.Series:
        """Corners of a ring in the order of its chains."""
        out = []
        for rows in parts:
            by, at, held = {r["id"]: r for r in rows}, rows[0]["id"], []
            for _ in range(len(rows)):
                held.extend({"xs": int(x), "ys": int(y)} for x, y in zip(by[at]["xs"], by[at]["ys"], strict=True))
                at = by[at]["next"]
            out.append(held)
        return pd.Series(out)

    joined = pieces.select(key, "ring", F.pandas_udf(order, "array<struct<xs:bigint,ys:bigint>>")(c("parts")).alias("held"), "m")
    at = lambda p: F.struct((p["xs"] * cell).cast("double").alias("x"), (p["ys"] * cell).cast("double").alias("y"))
    points = F.transform(F.concat("held", F.slice("held", 1, 1)), at)
    n = F.size("points")
    twice = F.zip_with(F.slice("points", F.lit(1), n - 1), F.slice("points", F.lit(2), n - 1), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    rings = whole.unionByName(joined).select(key, "ring", points.alias("points"), "m").withColumn("area", F.aggregate(twice, F.lit(0.0), lambda s, v: s + v) / 2)
    rings = materialize(rings.withColumn("hole", c("area") < 0), "outlines")
    # a hole whose run of cells begins in a tile to the left takes the last run before it that left its tile
    holes = rings.where("hole").select(key, "ring", "m.x", "m.cy", "m.owner")
    runs = found.where("next is null").select(key, F.lit(None).cast("bigint").alias("ring"), "x", "cy", c("id").alias("owner"))
    before = F.last("owner", True).over(Window.partitionBy(key, "cy").orderBy("x", F.col("ring").isNotNull()).rowsBetween(Window.unboundedPreceding, 0))
    afar = holes.where("owner is null").unionByName(runs).withColumn("owner", before).where("ring is not null")
    holes = holes.where("owner is not null").unionByName(afar).select(key, "ring", c("owner").alias("id"))
    held = on_cells(holes, state.select(key, "id", c("ring").alias("joined")), [key, "id"], "left").select(key, "ring", F.coalesce("joined", "id").alias("parent"))
    held = materialize(held, "owners")
    for _ in range(most_rounds):
        above = held.select(key, c("ring").alias("parent"), c("parent").alias("above"))
        moved = materialize(on_cells(held, above, [key, "parent"], "left").select(key, "ring", F.coalesce("above", "parent").alias("parent"), c("above").isNotNull().alias("moved")), "owners")
        held = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    outer = rings.where("not hole").withColumn("parent", c("ring"))
    owned = outer.unionByName(on_cells(rings.where("hole"), held, [key, "ring"]))
    return owned.select(key, c("parent").alias("piece"), "ring", "hole", F.abs("area").alias("area"), "points")


def to_layer(outlines: DataFrame, *keys: str) -> DataFrame:
    """Rings of ``trace`` as a layer again, a row per key or per (key, piece)."""
    ring = F.struct(c("piece").alias("part"), c("points").alias("points"))
    return outlines.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("piece", "hole", "ring", ring.alias("r")))).alias("h")).select(*keys, c("h.r").alias("rings"))
