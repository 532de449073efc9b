"""Connected components of an edge table, and runs of grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earshot.sources.storage import materialize

#: Cell keys are cy * KEY + cx.
KEY = 10_000_000


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b), longs; component is
    the smallest node reachable. Alternates large-star and small-star; every
    round is written to the shared folder. Raises if it has not settled in
    ``max_rounds``. Self-loops and nulls in edges are ignored; no edges, no rows."""

    def star(e: DataFrame, larger: bool) -> DataFrame:
        both = e if not larger else e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        low = materialize(low, "cc-low")
        met = both.join(low.hint("merge"), "a")
        if larger:
            return met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        kept = met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return kept.union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    # every edge points from the larger to the smaller node
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = materialize(e, "cc")
    before = state(e)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        e = materialize(star(star(e, True), False), "cc")
        now = state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components have not settled in {max_rounds} rounds")
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def cell_runs(cells: DataFrame, *keys: str) -> DataFrame:
    """Cells with ``start``, the first column of their unbroken run in the row."""
    order = Window.partitionBy(*keys, "cy").orderBy("cx")
    island = F.col("cx") - F.row_number().over(order)
    inside = Window.partitionBy(*keys, "cy", "island")
    return cells.withColumn("island", island).withColumn("start", F.min("cx").over(inside)).drop("island")
