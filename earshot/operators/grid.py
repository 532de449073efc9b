"""Cell tables: every layer becomes (cx, cy) rows of a metric grid, so layers meet in equi joins.

Cell (cx, cy) of size ``cell`` spans [cx*cell, (cx+1)*cell) in x and likewise in y.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import geo
from earshot.operators.components import cell_runs

CELL = 100


def cell_of(c: Column, cell: int = CELL) -> Column:
    return F.floor(c / cell).cast("bigint")


def grid_frame(sites: DataFrame, radius: Column, cell: int = CELL) -> DataFrame:
    """One row: bounds of sites grown by the largest radius, snapped out, with width and height in cells."""
    one = sites.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.max(radius).alias("r"))
    low = lambda v: F.floor((F.col(v) - F.col("r")) / cell).cast("bigint") * cell
    high = lambda v: F.ceil((F.col(v) + F.col("r")) / cell).cast("bigint") * cell
    out = one.select(low("x0").alias("minx"), high("y1").alias("maxy"), high("x1").alias("maxx"), low("y0").alias("miny"))
    return out.select("minx", "maxy", ((F.col("maxx") - F.col("minx")) / cell).cast("bigint").alias("width"), ((F.col("maxy") - F.col("miny")) / cell).cast("bigint").alias("height"))


def on_cells(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join whose sides are sorted and merged, never sent through the driver. The planner takes a table that was
    exploded into cells, made by an Arrow task or written as well-compressed columns for as small as its bytes on disk,
    and would broadcast it whole."""
    return left.join(right.hint("merge"), keys, how)


def sample(points: DataFrame, cells: DataFrame, values: dict[str, object], cell: int = CELL) -> DataFrame:
    """``points`` with the cell's values; absent cells give the defaults and ``valid`` false."""
    at = points.withColumns({"cx": cell_of(F.col("x"), cell), "cy": cell_of(F.col("y"), cell)})
    found = on_cells(at, cells.select("cx", "cy", F.struct(*values).alias("__v")), ["cx", "cy"], "left")
    out = found.withColumns({n: F.coalesce(F.col(f"__v.{n}"), F.lit(d)) for n, d in values.items()} | {"valid": F.col("__v").isNotNull()})
    return out.drop("__v", "cx", "cy")


def census_code(x: Column, y: Column, side: int = 500) -> Column:
    at = lambda c: (F.floor(c / side).cast("bigint") * side).cast("string")
    return F.concat(F.lit(f"CRS3035RES{side}mN"), at(y), F.lit("E"), at(x))


def _span(low: Column, high: Column) -> Column:
    """Cell numbers low..high, none where high < low."""
    return F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))


def deal(df: DataFrame) -> DataFrame:
    """A small table whose rows become many, over all shuffle partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def window_cells(points: DataFrame, radius: str, cell: int = CELL) -> DataFrame:
    """``points`` once per cell whose centre is within the radius, with cx, cy and dist.

    A point becomes up to tens of thousands of cells, and a small table of points
    would be read by one task: the points are dealt over all shuffle partitions first.
    """
    r, centre = F.col(radius), lambda c: (F.col(c) + 0.5) * cell
    rows = deal(points).withColumn("cy", F.explode(_span(cell_of(F.col("y") - r, cell), cell_of(F.col("y") + r, cell))))
    rows = rows.withColumn("cx", F.explode(_span(cell_of(F.col("x") - r, cell), cell_of(F.col("x") + r, cell))))
    dx, dy = centre("cx") - F.col("x"), centre("cy") - F.col("y")
    return rows.withColumn("dist", F.sqrt(dx * dx + dy * dy)).where(F.col("dist") <= r)


def box_cells(boxes: DataFrame, cell: int = CELL, touched: bool = False) -> DataFrame:
    """Boxes (xmin, ymin, w, h) once per cell: whose centre lies in [min, max), or every touched cell."""
    low = lambda c: cell_of(F.col(c), cell) if touched else F.ceil(F.col(c) / cell - 0.5).cast("bigint")
    high = lambda c, s: (F.ceil((F.col(c) + F.col(s)) / cell).cast("bigint") if touched else F.ceil((F.col(c) + F.col(s)) / cell - 0.5).cast("bigint")) - 1
    rows = boxes.withColumn("cy", F.explode(_span(low("ymin"), high("ymin", "h"))))
    return rows.withColumn("cx", F.explode(_span(low("xmin"), high("xmin", "w"))))


def rectangles(cells: DataFrame, *keys: str, cell: int = CELL) -> DataFrame:
    """Cells of each key as one rectangle per unbroken run of a row."""
    runs = cell_runs(cells.select(*keys, "cx", "cy"), *keys).groupBy(*keys, "cy", "start").agg(F.count(F.lit(1)).alias("n"))
    return runs.select(*keys, (F.col("start") * cell).alias("xmin"), (F.col("cy") * cell).alias("ymin"), (F.col("n") * cell).alias("w"), F.lit(cell).cast("bigint").alias("h"))


def areas(cells: DataFrame, *keys: str, cell: int = CELL) -> DataFrame:
    n = F.count(F.lit(1))
    return cells.groupBy(*keys).agg((n * cell * cell).cast("double").alias("area_m2"), (n * cell * cell / 1e4).alias("area_ha"))


def representative_points(cells: DataFrame, *keys: str, cell: int = CELL) -> DataFrame:
    """A point inside each key's cells: the middle of the longest run of its middle row."""
    runs = cell_runs(cells.select(*keys, "cx", "cy"), *keys).groupBy(*keys, "cy", "start").agg(F.count(F.lit(1)).alias("n"))
    rows = runs.groupBy(*keys).agg(F.min("cy").alias("low"), F.max("cy").alias("high"))
    near = on_cells(runs, rows, list(keys)).withColumn("off", F.abs(F.col("cy") * 2 - F.col("low") - F.col("high")))
    best = near.groupBy(*keys).agg(F.min(F.struct("off", "cy", (-F.col("n")).alias("m"), "start")).alias("b"))
    middle = (F.col("b.start") - F.col("b.m") / 2) * cell
    return best.select(*keys, middle.alias("x"), ((F.col("b.cy") + 0.5) * cell).alias("y"))


def words(cells: DataFrame, *sums: Column) -> DataFrame:
    """(cy, word, ``sums``, distinct): per 64 columns of a row the number of distinct cells, counted as bits."""
    bit = F.expr("shiftleft(1L, cast(pmod(cx, 64) as int))")
    held = cells.groupBy("cy", F.floor(F.col("cx") / 64).alias("word")).agg(F.bit_or(bit).alias("bits"), *sums)
    return held.withColumn("distinct", F.bit_count("bits").cast("bigint")).drop("bits")


def overlap_ratio(cells: DataFrame) -> DataFrame:
    """(sum of areas - area of the union) / sum of areas."""
    held = words(cells, F.count(F.lit(1)).alias("n"))
    return held.agg((1 - F.sum("distinct") / F.sum("n")).alias("ratio"), F.sum("n").alias("cells"))


def within_box(points: DataFrame, boxes: DataFrame, reach: int, bin_size: int = 10_000) -> DataFrame:
    """(point, box) rows no farther apart than ``reach``: bins that the grown box touches, then the exact distance."""
    grown = boxes.withColumn("by", F.explode(_span(cell_of(F.col("ymin") - reach, bin_size), cell_of(F.col("ymin") + F.col("h") + reach, bin_size))))
    grown = grown.withColumn("bx", F.explode(_span(cell_of(F.col("xmin") - reach, bin_size), cell_of(F.col("xmin") + F.col("w") + reach, bin_size))))
    at = points.withColumns({"bx": cell_of(F.col("x"), bin_size), "by": cell_of(F.col("y"), bin_size)})
    c = F.col
    far = geo.box_distance(c("x"), c("y"), c("xmin"), c("ymin"), c("xmin") + c("w"), c("ymin") + c("h"))
    return on_cells(at, grown, ["bx", "by"]).withColumn("distance", far).where(c("distance") <= reach).drop("bx", "by")
