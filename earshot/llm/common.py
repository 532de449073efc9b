"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.operators.components import connected_components
from earshot.sources.storage import materialize, shared_dir, shared_path

__all__ = ["LARGE_ROWS", "broadcast_if_small", "connected_components", "fresh", "map_rows", "materialize", "rows_per_batch", "shared_dir", "shared_path", "table", "words"]


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of one of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def broadcast_if_small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """A broadcast hint only where the counted rows stay under ``limit``."""
    return F.broadcast(df) if rows <= limit else df


def fresh(*taken: list[str]) -> Callable[[str], str]:
    """Makes column names that no column in the lists ``taken`` has, whatever its case."""
    used = {name.lower() for names in taken for name in names}

    def name(stem: str) -> str:
        while stem.lower() in used:
            stem = f"_{stem}"
        used.add(stem.lower())
        return stem

    return name


def map_rows(df: DataFrame, id_col: str, run: Callable, schema: str) -> DataFrame:
    """``mapInPandas`` of rows whose id passes through; ids travel as text, because pandas turns
    longs beside nulls into floats. ``schema`` is that of the other columns."""
    kind = df.schema[id_col].dataType
    out = df.withColumn(id_col, F.col(id_col).cast("string")).mapInPandas(run, f"{id_col} string, {schema}")
    return out.withColumn(id_col, F.col(id_col).cast(kind))


#: Writer's options for tables whose rows are some MB: pages and groups of rows are closed by their bytes after any row,
#: not after the hundred rows that the writer holds else before it looks.
LARGE_ROWS = {"parquet.block.size": str(16 * 2**20), "parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1"}


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int, read: int | None = None) -> Iterator[None]:
    """Jobs started inside hand Python workers at most so many rows at once, and Parquet readers decode at most
    ``read`` (as set, if None): for tables whose rows are large."""
    sizes = {"spark.sql.execution.arrow.maxRecordsPerBatch": rows} | ({} if read is None else {"spark.sql.parquet.columnarReaderBatchSize": read})
    before = {name: spark.conf.get(name) for name in sizes}
    for name, size in sizes.items():
        spark.conf.set(name, str(size))
    try:
        yield
    finally:
        for name, size in before.items():
            spark.conf.set(name, size)


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
