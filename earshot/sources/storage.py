"""Tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a fresh folder on one machine and an error on a cluster."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="earshot-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back. It cuts
    the lineage, so a lost executor costs one stage, and gives the next join a
    side that is a plain scan, which adaptive execution can split when a key is hot.
    ``options`` are the Parquet writer's."""
    path = shared_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
