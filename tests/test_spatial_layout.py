"""Layers in spatial order: windows read few files and lose no row."""

import random

import pytest
from pyspark.sql import functions as F

from earshot.sources import spatial

WINDOWS = [(0, 0, 5_000, 5_000), (40_000, 40_000, 40_000, 40_000), (-9_000, 70_000, 20_000, 99_000), (-(10**6), -(10**6), 10**7, 10**7), (10**8, 0, 10**8 + 1, 1)]


@pytest.fixture(scope="module")
def layer(spark, tmp_path_factory):
    draw = random.Random(9)
    rows = [(i, float(draw.randrange(-10_000, 90_000)), float(draw.randrange(0, 100_000)), float(draw.randrange(900)), float(draw.randrange(900))) for i in range(6_000)]
    df = spark.createDataFrame(rows, "id int, x double, y double, w double, h double")
    path = f"file://{tmp_path_factory.mktemp('layer')}/zones"
    spatial.write_layer(df, path, [F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h")], file_rows=200)
    return rows, path


@pytest.mark.parametrize("window", WINDOWS)
def test_windows(spark, layer, window):
    rows, path = layer
    x0, y0, x1, y1 = window
    got = {r.id for r in spatial.read_layer(spark, path, window).collect()}
    assert got == {i for i, x, y, w, h in rows if x <= x1 and x + w >= x0 and y <= y1 and y + h >= y0}


def test_fewer_files_are_read(spark, layer):
    _, path = layer
    everything = spatial.layer_files(spark, path, WINDOWS[3])
    few = spatial.layer_files(spark, path, WINDOWS[0])
    assert len(everything) == 30 and 0 < len(few) <= 4
    plan = spatial.read_layer(spark, path, WINDOWS[0])
    assert len(plan.inputFiles()) == len(few) and spark.read.parquet(path).count() == 6_000


def test_tiles_are_pruned(spark, tmp_path):
    cells = spark.range(300 * 300).select((F.col("id") % 300 - 100).alias("cx"), F.floor(F.col("id") / 300).cast("bigint").alias("cy"), F.col("id").alias("v"))
    path = f"file://{tmp_path}/cells"
    spatial.write_cells(cells, path, tile=50)
    got = spatial.read_cells(spark, path, (-20, 10, 30, 40), tile=50)
    assert {tuple(r) for r in got.select("cx", "cy", "v").collect()} == {tuple(r) for r in cells.where("cx between -20 and 30 and cy between 10 and 40").collect()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tx" in plan
    read = spark.read.parquet(path).where("tx between -1 and 0 and ty between 0 and 0").select(F.input_file_name()).distinct().count()
    assert read == 2 and spark.read.parquet(path).select(F.input_file_name()).distinct().count() == 36


def test_rows_without_a_box_and_empty_layers(spark, tmp_path):
    df = spark.createDataFrame([(1, 5.0), (2, None)], "id int, x double")
    spatial.write_layer(df, f"file://{tmp_path}/a", [F.col("x")] * 4)
    assert [r.id for r in spatial.read_layer(spark, f"file://{tmp_path}/a", (0, 0, 9, 9)).collect()] == [1]
    spatial.write_layer(df.limit(0), f"file://{tmp_path}/b", [F.col("x")] * 4)
    assert spatial.read_layer(spark, f"file://{tmp_path}/b", (0, 0, 9, 9)).count() == 0


def test_neighbours_on_the_curve(spark):
    at = {tuple(r)[:2]: r.z for r in spark.range(64).select((F.col("id") % 8).alias("x"), F.floor(F.col("id") / 8).cast("bigint").alias("y")).withColumn("z", spatial.z_order(F.col("x") * 100, F.col("y") * 100)).collect()}
    order = sorted(at, key=at.get)
    assert [set(order[k : k + 4]) for k in range(0, 64, 4)][0] == {(0, 0), (1, 0), (0, 1), (1, 1)} and len(set(at.values())) == 64
