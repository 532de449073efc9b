"""Layers on disk in spatial order, so that a window reads few files.

Rows with boxes are written in the order of a Z curve through the middles of their boxes, and beside the files lies
a small table with the box of each file: a read opens only files whose box meets the window. Cell tables
are partitioned by square tiles, and a read names the tiles of its window, which prunes folders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a file of a layer holds at most, about.
FILE_ROWS = 500_000
#: Side of the squares that the curve runs through, in metres.
SQUARE = 100
#: Cells along a tile's side.
TILE_CELLS = 512
#: The folder of file boxes; readers of the layer pass over names that begin with an underscore.
BOXES = "_boxes"
BOX = ["xmin", "ymin", "xmax", "ymax"]


def _spread(value: Column) -> Column:
    """The lower 31 bits of a number with a zero bit before each."""
    out = value.bitwiseAND(F.lit(0x7FFFFFFF))
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        out = out.bitwiseOR(F.shiftleft(out, shift)).bitwiseAND(F.lit(mask))
    return out


def z_order(x: Column, y: Column, square: int = SQUARE) -> Column:
    """The place of a point on the Z curve; negative coordinates are moved up."""
    place = lambda v: F.floor(v / square).cast("bigint") + F.lit(2**30)
    return _spread(place(x)).bitwiseOR(F.shiftleft(_spread(place(y)), 1))


def write_layer(df: DataFrame, path: str, box: list[Column], file_rows: int = FILE_ROWS) -> None:
    """Writes ``df`` to ``path`` in files of neighbours, and the files' boxes. ``box`` is xmin, ymin, xmax, ymax; rows
    without a box go into files of their own order and into every read. No rows give an empty layer."""
    boxed = df.withColumns(dict(zip((f"__{b}" for b in BOX), (c.cast("double") for c in box), strict=True)))
    middle = lambda a, b: (F.col(a) + F.col(b)) / 2
    curve = z_order(middle("__xmin", "__xmax"), middle("__ymin", "__ymax"))
    files = max(1, -(-df.count() // file_rows))
    boxed.repartitionByRange(files, curve).sortWithinPartitions(curve).write.parquet(path)
    written = df.sparkSession.read.parquet(path)
    least, most = ("xmin", "ymin"), ("xmax", "ymax")
    ends = [*(F.min(f"__{b}").alias(b) for b in least), *(F.max(f"__{b}").alias(b) for b in most)]
    blank = F.count_if(F.col("__xmin").isNull()).alias("unplaced")
    written.groupBy(F.col("_metadata.file_path").alias("file")).agg(*ends, blank, F.count(F.lit(1)).alias("n")).coalesce(1).write.parquet(f"{path}/{BOXES}")


def layer_files(spark: SparkSession, path: str, window: tuple[float, float, float, float]) -> list[str]:
    """The files of a layer that may hold rows that meet the window."""
    x0, y0, x1, y1 = window
    boxes = spark.read.parquet(f"{path}/{BOXES}")
    meets = (F.col("xmin") <= x1) & (F.col("xmax") >= x0) & (F.col("ymin") <= y1) & (F.col("ymax") >= y0)
    return sorted(r[0] for r in boxes.where(meets | (F.col("unplaced") > 0)).select("file").collect())


def read_layer(spark: SparkSession, path: str, window: tuple[float, float, float, float]) -> DataFrame:
    """Rows of a layer whose box meets the window (xmin, ymin, xmax, ymax), edges included."""
    x0, y0, x1, y1 = window
    files = layer_files(spark, path, window)
    rows = spark.read.parquet(*files) if files else spark.read.parquet(path).limit(0)
    meets = (F.col("__xmin") <= x1) & (F.col("__xmax") >= x0) & (F.col("__ymin") <= y1) & (F.col("__ymax") >= y0)
    return rows.where(meets).drop(*(f"__{b}" for b in BOX))


def write_cells(cells: DataFrame, path: str, tile: int = TILE_CELLS) -> None:
    """Writes a cell table (cx, cy, ...) with a folder for each tile."""
    at = lambda v: F.floor(F.col(v) / tile).cast("bigint")
    placed = cells.withColumns({"ty": at("cy"), "tx": at("cx")})
    placed.repartition("ty", "tx").sortWithinPartitions("ty", "tx", "cy", "cx").write.partitionBy("ty", "tx").parquet(path)


def read_cells(spark: SparkSession, path: str, window: tuple[int, int, int, int], tile: int = TILE_CELLS) -> DataFrame:
    """Cells of a table with cx0 <= cx <= cx1 and cy0 <= cy <= cy1; only the window's tiles are read."""
    x0, y0, x1, y1 = window
    tiles = F.col("tx").between(x0 // tile, x1 // tile) & F.col("ty").between(y0 // tile, y1 // tile)
    return spark.read.parquet(path).where(tiles & F.col("cx").between(x0, x1) & F.col("cy").between(y0, y1)).drop("tx", "ty")
