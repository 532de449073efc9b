"""Ranks and running sums over a whole table without a window that holds it.

Rows go to range partitions of the order; a partition's rows are summed up by
themselves and the sums of the partitions before are added. The only table that
is read in one piece has a row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earshot.sources.storage import materialize


def running(df: DataFrame, order: list[Column], amount: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``amount`` up to and with the row, in ``order``, which must tell rows apart. Nulls count as 0."""
    value = F.coalesce(F.col(amount), F.lit(0))
    # the partitions' bounds are sampled, so they are written down once
    dealt = materialize(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()), "ranges")
    sums = dealt.groupBy("__part").agg(F.sum(value).alias("__sum"))
    before = F.sum("__sum").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("__part", F.coalesce(before, F.lit(0)).alias("__start"))
    within = F.sum(value).over(Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.withColumn("__within", within).join(starts, "__part").withColumn(name, F.col("__start") + F.col("__within")).drop("__part", "__start", "__within")


def row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``name``: the place from 1 in ``order``, which must tell rows apart."""
    return running(df.withColumn("__one", F.lit(1).cast("bigint")), order, "__one", name).drop("__one")


def ntile(place: Column, total: Column, tiles: int) -> Column:
    """SQL's ``ntile`` of the row at ``place`` of ``total``: the first ``total mod tiles`` tiles hold one row more."""
    size, larger = F.floor(total / tiles), total % tiles
    first = larger * (size + 1)
    late = larger + F.ceil((place - first) / F.greatest(size, F.lit(1)))
    return F.when(place <= first, F.ceil(place / (size + 1))).otherwise(late).cast("int")
