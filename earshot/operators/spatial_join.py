"""Spatial joins rewritten as equi joins on cells or bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from earshot.operators.grid import CELL, _span, cell_of, on_cells
from earshot.operators.tiles import nearest_sites
from earshot.sources.storage import materialize

#: A bin with more places than this is split.
LEAF_POINTS = 2_000


def assign_units(points: DataFrame, units: DataFrame, cover: int = 1000, carry: tuple[str, ...] = ()) -> DataFrame:
    """``points`` with unit_no (and the columns ``carry``) of the unit that holds them, null where none does. Units are
    boxes (xmin, ymin, w, h); a strictly inside match beats one on the boundary, the last unit wins.

    Units are covered with cells once and listed per cell; each point meets the list
    of its cell and picks from it, so points are joined once and never grouped.
    """
    c = F.col
    cells = units.withColumn("__cy", F.explode(_span(cell_of(c("ymin"), cover), cell_of(c("ymin") + c("h"), cover))))
    cells = cells.withColumn("__cx", F.explode(_span(cell_of(c("xmin"), cover), cell_of(c("xmin") + c("w"), cover))))
    listed = cells.groupBy("__cx", "__cy").agg(F.collect_list(F.struct("unit_no", "xmin", "ymin", "w", "h", *carry)).alias("__units"))
    at = points.withColumns({"__cx": cell_of(c("x"), cover), "__cy": cell_of(c("y"), cover)})

    def within(u: Column, strictly: bool) -> Column:
        dx, dy = c("x") - u["xmin"], c("y") - u["ymin"]
        if strictly:
            return (dx > 0) & (dx < u["w"]) & (dy > 0) & (dy < u["h"])
        return (dx >= 0) & (dx <= u["w"]) & (dy >= 0) & (dy <= u["h"])

    touching = F.filter("__units", lambda u: within(u, False))
    best = F.array_max(F.transform(touching, lambda u: F.struct(within(u, True).cast("int").alias("i"), u["unit_no"].alias("unit_no"), *(u[n].alias(n) for n in carry))))
    return on_cells(at, listed, ["__cx", "__cy"], "left").withColumn("__best", best).withColumns({n: c("__best")[n] for n in ("unit_no", *carry)}).drop("__cx", "__cy", "__units", "__best")


def _nodes(points: DataFrame, level: int, radius: int) -> DataFrame:
    """Bins of ``radius / 2**level`` with their points' number and box."""
    size = radius / 2**level
    bins = points.groupBy(F.floor(F.col("rx") / size).cast("bigint").alias("bx"), F.floor(F.col("ry") / size).cast("bigint").alias("by"))
    return bins.agg(F.count(F.lit(1)).alias("n"), F.min("rx").alias("x0"), F.max("rx").alias("x1"), F.min("ry").alias("y0"), F.max("ry").alias("y1"))


def _adaptive_grid(points: DataFrame, radius: int, leaf: int) -> list[DataFrame]:
    """Nodes by level: bins as large as the radius, and as long as some hold over ``leaf`` points the quarters of those."""
    levels, held = [], points
    while True:
        nodes = materialize(_nodes(held, len(levels), radius).withColumn("leaf", (F.col("n") <= leaf) | ((F.col("x0") == F.col("x1")) & (F.col("y0") == F.col("y1")))), "grid-nodes")
        levels.append(nodes)
        full = nodes.where("not leaf").select("bx", "by")
        if full.isEmpty():
            return levels
        size = radius / 2 ** (len(levels) - 1)
        at = held.withColumns({"bx": F.floor(F.col("rx") / size).cast("bigint"), "by": F.floor(F.col("ry") / size).cast("bigint")})
        held = materialize(on_cells(at, full, ["bx", "by"], "left_semi").select("rx", "ry"), "grid-points")


def _reachable_leaves(at: DataFrame, levels: list[DataFrame], radius: int) -> DataFrame:
    """(lid, x, y, level, bx, by): the leaves that may hold the nearest point of each left, level by level. A node is left
    out where its box is farther than the far corner of another node's box, or than the radius."""
    c = F.col
    near = lambda v, low, high: F.greatest(c(low) - c(v), c(v) - c(high), F.lit(0.0))
    far = lambda v, low, high: F.greatest(F.abs(c(v) - c(low)), F.abs(c(v) - c(high)))
    square = lambda f: (f("x", "x0", "x1") ** 2 + f("y", "y0", "y1") ** 2).cast("double")
    around = F.sequence(F.lit(-1), F.lit(1))
    start = levels[0].withColumn("ox", F.explode(around)).withColumn("oy", F.explode(around)).withColumns({"__bx": c("bx") + c("ox"), "__by": c("by") + c("oy")}).drop("ox", "oy")
    pairs = at.withColumns({"__bx": cell_of(c("x"), radius), "__by": cell_of(c("y"), radius)})
    pairs = on_cells(pairs, start, ["__bx", "__by"]).drop("__bx", "__by")
    done = None
    for level, _ in enumerate(levels):
        pairs = pairs.select("lid", "x", "y", F.lit(level).alias("level"), "bx", "by", "leaf", square(near).alias("least"), square(far).alias("most"))
        pairs = pairs if done is None else pairs.unionByName(done)
        bound = pairs.groupBy("lid").agg(F.least(F.min("most"), F.lit(float(radius) ** 2)).alias("bound"))
        pairs = materialize(on_cells(pairs, bound, ["lid"]).where("least <= bound").drop("bound"), "grid-pairs")
        done = pairs.where("leaf")
        if level + 1 < len(levels):
            children = levels[level + 1].select("*", F.floor(c("bx") / 2).cast("bigint").alias("px"), F.floor(c("by") / 2).cast("bigint").alias("py"))
            open_ = pairs.where("not leaf").select("lid", "x", "y", c("bx").alias("px"), c("by").alias("py"))
            pairs = on_cells(open_, children, ["px", "py"]).drop("px", "py", "n")
    return done.select("lid", "x", "y", "level", "bx", "by")


def nearest(left: DataFrame, right: DataFrame, radius: int, left_key: str, right_key: str, leaf: int = LEAF_POINTS) -> DataFrame:
    """(left_key, right_key, distance) of the nearest right point within ``radius``;
    all ties stay; lefts without one keep nulls.

    Right places go into bins as large as the radius; a bin with more than ``leaf`` places is split into
    quarters, again and again. Where none is, lefts meet the nine bins around theirs. Else they
    descend the grid and meet only leaves that may hold the nearest place, so a dense bin is never all pairs."""
    c = F.col
    places = right.select(c("x").cast("double").alias("rx"), c("y").cast("double").alias("ry")).where("rx is not null and ry is not null").distinct()
    places = materialize(places, "places")
    levels = _adaptive_grid(places, radius, leaf)
    lefts = left.select(c(left_key).alias("lid"), c("x").cast("double").alias("x"), c("y").cast("double").alias("y"))
    dx, dy = c("x") - c("rx"), c("y") - c("ry")
    if len(levels) == 1:
        around = places.select("rx", "ry", cell_of(c("rx"), radius).alias("ox"), cell_of(c("ry"), radius).alias("oy"))
        around = around.withColumn("bx", F.explode(F.sequence(c("ox") - 1, c("ox") + 1))).withColumn("by", F.explode(F.sequence(c("oy") - 1, c("oy") + 1)))
        met = on_cells(lefts.withColumns({"bx": cell_of(c("x"), radius), "by": cell_of(c("y"), radius)}), around, ["bx", "by"])
    else:
        leaves = _reachable_leaves(lefts, levels, radius)
        at = None
        for level, nodes in enumerate(levels):
            size = radius / 2**level
            own = places.withColumns({"bx": F.floor(c("rx") / size).cast("bigint"), "by": F.floor(c("ry") / size).cast("bigint")})
            own = on_cells(own, nodes.where("leaf").select("bx", "by"), ["bx", "by"]).withColumn("level", F.lit(level))
            at = own if at is None else at.unionByName(own)
        met = on_cells(leaves, at, ["level", "bx", "by"])
    met = met.select("lid", "rx", "ry", (dx * dx + dy * dy).alias("d2")).where(c("d2") <= float(radius) ** 2)
    best = met.groupBy("lid").agg(F.min("d2").alias("d2"))
    ties = on_cells(met, best, ["lid", "d2"]).distinct()
    keys = right.select(c(right_key), c("x").cast("double").alias("rx"), c("y").cast("double").alias("ry"))
    found = on_cells(ties, keys, ["rx", "ry"]).select(c("lid").alias(left_key), right_key, F.sqrt("d2").alias("distance"))
    return on_cells(left.select(left_key), found, [left_key], "left")


def nearest_site_of_cells(sites: DataFrame, radius: str, cell: int = CELL, carry: tuple[str, ...] = ()) -> DataFrame:
    """(cx, cy, site_uid, dist): the nearest site of every cell in reach, ties to the smaller uid; with the site's
    numbers ``carry``. Found tile by tile, so cells are not shuffled per site; see ``tiles``."""
    return nearest_sites(sites.select("x", "y", "site_uid", F.col(radius).alias("r"), *carry), carry, cell)
