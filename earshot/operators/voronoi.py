"""Exact ranges by the nearest site: each site's cell of the plane, cut by the circles round it.

A site's cell starts as the square round its largest circle and is cut by the bisector with one neighbour after the
other, nearest first, until a neighbour is farther than twice the farthest corner: no later one can cut it. Neighbours
come from the nine bins around. Bins begin small and double in size for the sites that are not settled yet, so a
crowded bin is settled by its closest neighbours and never meets all pairs. Areas of circle and cell are in closed form.
Neighbours stay in Arrow's arrays; a task has those of one site at a time as Python objects.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.operators.grid import cell_of, on_cells
from earshot.sources.storage import materialize

#: Bins begin at this part of the largest circle's radius.
FIRST_BIN = 16


def clip(polygon: list[tuple[float, float]], a: float, b: float, most: float) -> list[tuple[float, float]]:
    """The part of a convex polygon with a * x + b * y <= most."""
    out = []
    for (px, py), (qx, qy) in zip(polygon, polygon[1:] + polygon[:1], strict=True):
        p, q = a * px + b * py - most, a * qx + b * qy - most
        if p <= 0:
            out.append((px, py))
        if p * q < 0:
            t = p / (p - q)
            out.append((px + t * (qx - px), py + t * (qy - py)))
    return out


def circle_area(polygon: list[tuple[float, float]], r: float) -> float:
    """The area that a polygon (counter-clockwise) shares with the circle of radius ``r`` round the origin: for each
    edge the triangle over its part inside and the sectors over its parts outside."""
    total = 0.0
    for (px, py), (qx, qy) in zip(polygon, polygon[1:] + polygon[:1], strict=True):
        dx, dy = qx - px, qy - py
        length = dx * dx + dy * dy
        if not length:
            continue
        along = -(px * dx + py * dy) / length
        spare = r * r / length - (px * dy - py * dx) ** 2 / length**2
        half = math.sqrt(spare) if spare > 0 else 0.0  # a line that only touches the circle has no part inside
        enters, leaves = (min(1.0, max(0.0, along + side)) for side in (-half, half))
        for t0, t1, inside in ((0.0, enters, False), (enters, leaves, True), (leaves, 1.0, False)):
            ax, ay, bx, by = px + t0 * dx, py + t0 * dy, px + t1 * dx, py + t1 * dy
            cross = ax * by - ay * bx
            total += cross / 2 if inside else math.atan2(cross, ax * bx + ay * by) * r * r / 2
    return total


def cell_of_site(around: list[tuple[float, float]], reach: float, known: float) -> tuple[list[tuple[float, float]], bool]:
    """(corners of the cell round the origin, whether no unknown site can cut it) from neighbours at ``around``, of which all
    within ``known`` are there."""
    polygon = [(-reach, -reach), (reach, -reach), (reach, reach), (-reach, reach)]
    for d2, x, y in sorted((x * x + y * y, x, y) for x, y in around):
        if d2 > 4 * max(px * px + py * py for px, py in polygon):
            break
        polygon = clip(polygon, x, y, d2 / 2)
    return polygon, 2 * math.sqrt(max(px * px + py * py for px, py in polygon)) <= known


def measured(batch: pa.RecordBatch, radii: int, size: float) -> list[pa.Array]:
    """(settled, the area within each radius) of sites (uid, x, y, ``radii`` columns of radii, near: a list of places). A site with
    fewer than three others in sight still has a corner of its square or a stretch of its side, so it isn't measured yet."""
    x, y, *reaches = (batch.column(i).to_numpy() for i in range(1, 3 + radii))
    near = batch.column(3 + radii)
    ends, places = near.offsets.to_numpy(), near.values
    xs, ys = places.field("x").to_numpy(), places.field("y").to_numpy()
    settled, areas = np.zeros(len(x), bool), np.zeros((radii, len(x)))
    for i in range(len(x)):
        reach = [float(r[i]) for r in reaches]
        dx, dy = xs[ends[i] : ends[i + 1]] - x[i], ys[ends[i] : ends[i + 1]] - y[i]
        other = (dx != 0) | (dy != 0)
        if np.count_nonzero(other) < 3 and size < 2 * max(reach):
            continue
        polygon, settled[i] = cell_of_site(list(zip(dx[other].tolist(), dy[other].tolist(), strict=True)), max(reach), size)
        areas[:, i] = [circle_area(polygon, r) for r in reach]
    return [pa.array(settled), *map(pa.array, areas)]


def exact_ranges(sites: DataFrame, radii: dict[int, str], first_bin: int = FIRST_BIN) -> DataFrame:
    """(site_uid, db, area_m2): for each site (site_uid, x, y, radius columns) and class the area in reach that is nearer to
    it than to any other site. ``radii`` names the radius column of each class; a class has the ring outside the next
    higher one. Sites stand at different places; classes without area have no row."""
    thresholds = sorted(radii)
    columns = [radii[t] for t in thresholds]
    rows = materialize(sites.select("site_uid", *(F.col(c).cast("double").alias(c) for c in ("x", "y", *columns))), "voronoi-sites")
    most = rows.agg(F.max(F.greatest(*columns) if len(columns) > 1 else F.col(columns[0]))).first()[0]
    kind = rows.schema["site_uid"].dataType.simpleString()
    schema = f"site_uid {kind}, settled boolean, " + ", ".join(f"a{t} double" for t in thresholds)
    if most is None:
        return rows.select("site_uid", F.lit(0).alias("db"), F.lit(0.0).alias("area_m2")).limit(0)

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def measure(size: float):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(0), *measured(batch, len(columns), size)], ["site_uid", "settled", *(f"a{t}" for t in thresholds)])

        return run

    left, parts, size = rows, [], most / first_bin
    while True:
        # all sites within one bin's size of a site are in the nine bins around its own
        size = min(size, 2 * math.sqrt(2) * most * (1 + 1e-9))
        last = size >= 2 * math.sqrt(2) * most
        spread = rows.select(F.struct("x", "y").alias("p"), cell_of(F.col("x"), size).alias("bx"), cell_of(F.col("y"), size).alias("by"))
        around = F.sequence(F.lit(-1), F.lit(1))
        asked = left.withColumns({"ox": cell_of(F.col("x"), size), "oy": cell_of(F.col("y"), size)})
        asked = asked.withColumn("dx", F.explode(around)).withColumn("dy", F.explode(around)).withColumns({"bx": F.col("ox") + F.col("dx"), "by": F.col("oy") + F.col("dy")})
        # a site's neighbours are few bytes and much work: the number of tasks doesn't follow the bytes
        met = on_cells(asked, spread, ["bx", "by"]).select("site_uid", "x", "y", *columns, "p").repartition(tasks, "site_uid")
        near = met.groupBy("site_uid", "x", "y", *columns).agg(F.collect_list("p").alias("near"))
        found = materialize(near.mapInArrow(measure(size), schema), "voronoi-cells")
        parts.append(found if last else found.where("settled"))
        open_ = found.where("not settled").select("site_uid")
        if last or open_.isEmpty():
            break
        left = materialize(on_cells(left, open_, ["site_uid"], "left_semi"), "voronoi-open")
        size *= 2
    cells = reduce(DataFrame.unionByName, parts)
    inner = [f"a{t}" for t in thresholds[1:]] + [None]
    rings = [F.struct(F.lit(t).alias("db"), (F.col(f"a{t}") - (F.col(i) if i else F.lit(0.0))).alias("area_m2")) for t, i in zip(thresholds, inner, strict=True)]
    return cells.select("site_uid", F.explode(F.array(*rings)).alias("r")).select("site_uid", "r.db", "r.area_m2").where("area_m2 > 1e-6")
