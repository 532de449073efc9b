"""Exact quantiles whose memory does not grow with the table.

``quantile`` is for a whole table: a histogram of the value range is counted (combined on the map side, a
few thousand rows at most), the bin that holds the wanted rank becomes the next range, and so on until one value is
left. Least and greatest value of a range fall into different bins, so every pass narrows it; a few passes do.
``grouped`` is for groups: from counts per distinct value it sums up ranks in order, in windows that can spill.
Both interpolate linearly between the two values next to the rank, as ``percentile`` does.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BINS = 4096


def _between(low: float, high: float, position: float) -> float:
    below, above = math.floor(position), math.ceil(position)
    return low if below == above or low == high else (above - position) * low + (position - below) * high


def quantile(df: DataFrame, value: str, p: float, bins: int = BINS) -> float | None:
    """The quantile ``p`` of a numeric column, nulls left out; None where nothing is left. ``df`` is read once a pass."""
    rows = df.select(F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v)")
    n, low, high = rows.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    if not n:
        return None
    position = (n - 1) * p
    # rank -> (values before the range, least, greatest value of it)
    ranges = {math.floor(position): (0, low, high), math.ceil(position): (0, low, high)}
    while todo := {r for r in ranges.values() if r[1] < r[2]}:
        for before, low, high in todo:
            width = (high - low) / bins
            place = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)) if width > 0 else (F.col("v") > low).cast("bigint")
            counts = rows.where(F.col("v").between(low, high)).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
            found, seen = sorted(map(tuple, counts.collect())), before
            for _, n_bin, a, b in found:
                for rank, now in ranges.items():
                    if now == (before, low, high) and seen <= rank < seen + n_bin:
                        ranges[rank] = (seen, a, b)
                seen += n_bin
    return _between(ranges[math.floor(position)][1], ranges[math.ceil(position)][1], position)


def grouped(counts: DataFrame, keys: list[str], value: str, n: str, p: float, name: str) -> DataFrame:
    """(keys, name): the quantile of each group, from counts per distinct value (keys, value, n)."""
    order = Window.partitionBy(*keys).orderBy(value)
    upto = F.sum(n).over(order.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum(n).over(Window.partitionBy(*keys))
    rows = counts.where(F.col(value).isNotNull()).withColumns({"__upto": upto, "__at": (total - 1) * p})
    held = lambda rank: (rank >= F.col("__upto") - F.col(n)) & (rank < F.col("__upto"))
    picked = lambda rank: F.max(F.when(held(rank), F.col(value)))
    below, above = F.floor("__at"), F.ceil("__at")
    ends = rows.groupBy(*keys).agg(picked(below).alias("__low"), picked(above).alias("__high"), F.first("__at").alias("__at"))
    between: Column = (above - F.col("__at")) * F.col("__low") + (F.col("__at") - below) * F.col("__high")
    return ends.select(*keys, F.when(below == above, F.col("__low").cast("double")).otherwise(between).alias(name))
