"""Regression tests of the reviewer's findings of round 1 on the engine."""

from pyspark.sql import functions as F

from earshot.operators import recommend
from earshot.plans import queries_results


def test_gap_sample_takes_the_reports_whole_top(spark, monkeypatch):
    seed = F.when(F.col("id") == 2_900, "new_siren_likely").otherwise("modernizacja_or_new")
    gaps = spark.range(3_000).select(F.col("id").alias("gap_id"), (-F.col("id")).cast("double").alias("score"), F.lit(1.0).alias("pop_night"), seed.alias("seed"))
    monkeypatch.setattr(queries_results.E, "gaps", lambda t: gaps)
    assert {r.gap_id for r in queries_results.sample(None).collect()} == {*range(recommend.TOP_GAPS), 2_900} and recommend.TOP_GAPS == 2_500
