"""Every registered query of the coverage engine and its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.plans.fixtures import fixture, oracle
from earshot.sources.storage import materialize

FLAGSHIP = "x01_general_coverage"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


#: Stage tables of this process: (application, folder of the tables, state of its files, name) -> table.
_STAGES: dict[tuple[str, str, str, str], DataFrame] = {}


def forget_stages() -> None:
    """Later queries compute their stages anew."""
    _STAGES.clear()


class Tables:
    """The tables and fixtures of one call, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._state = spark, sf_dir, None

    def state(self) -> str:
        """Tells the table files' names, sizes and times, so that stages of tables that have changed are made anew."""
        if self._state is None:
            found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(self.sf_dir)
            sums = found.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")))
            self._state = str(tuple(sums.first()))
        return self._state

    def stage(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A step that several later ones read: written once as a stage table, as a
        chain of jobs would leave it, and read by every query of the application."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self.state(), name)
        if key not in _STAGES:
            _STAGES[key] = materialize(make(), name)
        return _STAGES[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            return fixture(self.spark, self.sf_dir, name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None, *fixtures: str):
    """Registers ``f(tables)`` under ``name`` with its oracle."""

    def register(f: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = name, f.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = oracle(sql, *fixtures)
        return f

    return register


from earshot.plans import queries_audit, queries_changes, queries_coverage, queries_exposure, queries_polygons, queries_results, queries_scalars, queries_sources  # noqa: E402, F401
