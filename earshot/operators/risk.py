"""Risk x exposure x coverage: gaps, exposure measures, scores and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import scalars as S
from earshot.operators import ranks
from earshot.operators.grid import on_cells
from earshot.operators.quantiles import quantile

MEASURES = ["night", "night_in", "night_out", "day", "day_in", "day_out"]


def gap_cells(risk: DataFrame, covered: DataFrame) -> DataFrame:
    """Risk cells without coverage."""
    return on_cells(risk.where("risk > 0"), covered.select("cx", "cy"), ["cx", "cy"], "left_anti")


def gap_table(labels: DataFrame, risk: DataFrame, cell: int = 100) -> DataFrame:
    """Per gap: cells, area and highest risk."""
    met = on_cells(labels, risk, ["cx", "cy"])
    n = F.count(F.lit(1))
    return met.groupBy("gap_id").agg(n.alias("cells"), (n * cell * cell / 1e4).alias("area_ha"), F.max("risk").alias("risk"))


def exposed(points: DataFrame) -> DataFrame:
    """Points in a risk zone and a unit that hold people."""
    return points.where("risk > 0 and unit_no is not null and (pop_night > 0 or pop_day > 0)")


def exposure_measures() -> list[Column]:
    """Night and day people: all, within coverage, outside."""
    out = []
    for p in ("night", "day"):
        c = F.col(f"pop_{p}")
        out += [F.sum(c).alias(p), F.sum(F.when(F.col("db") > 0, c).otherwise(0.0)).alias(f"{p}_in"), F.sum(F.when(F.col("db") > 0, 0.0).otherwise(c)).alias(f"{p}_out")]
    return out


def exposure(points: DataFrame) -> DataFrame:
    """The six measures by risk class for the country, provinces, counties and communes, in one grouping."""
    keyed = points.withColumns({"woj": F.substring("gmi", 1, 2), "pow": F.substring("gmi", 1, 4)})
    sets = [["risk"], ["risk", "woj"], ["risk", "pow"], ["risk", "gmi"]]
    cube = keyed.groupingSets(sets, "risk", "woj", "pow", "gmi").agg(*exposure_measures(), F.grouping_id().alias("g"))
    level = F.when(F.col("g") == 7, "country").when(F.col("g") == 3, "woj").when(F.col("g") == 5, "pow").otherwise("gmi")
    return cube.select(level.alias("level"), F.coalesce("gmi", "pow", "woj", F.lit("PL")).alias("code"), "risk", *MEASURES)


def gap_population(points: DataFrame) -> DataFrame:
    """People of every gap, points without a unit too."""
    return points.where("gap_id is not null").groupBy("gap_id").agg(F.sum("pop_night").alias("pop_night"), F.sum("pop_day").alias("pop_day"))


def gap_units(points: DataFrame) -> DataFrame:
    """The unit with most night people of each gap, ties to the smaller code."""
    sums = points.where("gap_id is not null and gmi is not null").groupBy("gap_id", "gmi").agg(F.round(F.sum("pop_night"), 6).alias("n"))
    return sums.groupBy("gap_id").agg(F.min(F.struct((-F.col("n")).alias("neg"), "gmi")).alias("b")).select("gap_id", "b.gmi")


def percentile_ref(df: DataFrame, column: str) -> float:
    """The 95th percentile of positive values, 1 at least; 0 without any."""
    found = quantile(df.where(F.col(column) > 0), column, 0.95)
    return 0.0 if found is None else max(1.0, found)


def priority_score(people: Column, ref: Column, risk: Column, share: Column, area_ha: Column) -> Column:
    mass = F.when(ref > 0, 40 * F.least(F.lit(1.0), F.log1p(people) / F.log1p(F.greatest(F.lit(1.0), ref)))).otherwise(0.0)
    danger = F.when(risk == 2, 25.0).when(risk == 1, 12.5).otherwise(0.0)
    clamp = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(share, F.lit(0.0))))
    dense = F.least(F.lit(1.0), F.coalesce(F.try_divide(people, area_ha), F.lit(0.0)) / 50)
    return S.half_even(F.round(mass + danger + 20 * clamp + 15 * dense, 6), 2)


def priority_class(score: Column) -> Column:
    return F.when(score >= 80, "A").when(score >= 60, "B").when(score >= 40, "C").otherwise("niski")


def action_seed(score: Column, people: Column, area_ha: Column) -> Column:
    likely = (score >= 60) & (people >= 100) & (F.coalesce(F.try_divide(people, area_ha), F.lit(0.0)) >= 5)
    return F.when(likely, "new_siren_likely").otherwise("modernizacja_or_new")


def unit_base(points: DataFrame) -> DataFrame:
    """Per unit: risk people, inside, outside, share outside, highest risk."""
    inside = F.sum(F.when(F.col("db") > 0, F.col("pop_night")).otherwise(0.0))
    out = points.groupBy("gmi").agg(F.sum("pop_night").alias("people"), inside.alias("inside"), F.max("risk").alias("risk"))
    out = out.withColumn("outside", F.round(F.col("people") - F.col("inside"), 6))
    return out.withColumn("share", F.round(S.safe_div(F.col("outside"), F.col("people")), 6))


def select_gaps(gaps: DataFrame, people: DataFrame, least: float = 1.0) -> DataFrame:
    """Gaps with at least ``least`` people by night or by day."""
    met = on_cells(gaps, people, ["gap_id"]).where((F.col("pop_night") >= least) | (F.col("pop_day") >= least))
    return met.withColumns({"pop_night": F.round("pop_night", 6), "pop_day": F.round("pop_day", 6)})


def priority_gaps(selected: DataFrame, gap_unit: DataFrame, base: DataFrame) -> DataFrame:
    """Selected gaps with unit, score, class and action; the reference percentile is one row."""
    ref = F.lit(percentile_ref(selected, "pop_night"))
    met = on_cells(on_cells(selected, gap_unit, ["gap_id"], "left"), base.select("gmi", "share"), ["gmi"], "left")
    score = priority_score(F.col("pop_night"), ref, F.col("risk"), F.col("share"), F.col("area_ha"))
    out = met.withColumn("score", score)
    return out.withColumns({"priority_class": priority_class(F.col("score")), "seed": action_seed(F.col("score"), F.col("pop_night"), F.col("area_ha"))})


def unit_ranking(base: DataFrame, gaps: DataFrame) -> DataFrame:
    """Units with the area of their gaps, score and rank."""
    area = gaps.where("gmi is not null").groupBy("gmi").agg(F.sum("area_ha").alias("gap_ha"), F.count(F.lit(1)).alias("gaps"))
    met = on_cells(base, area, ["gmi"], "left").na.fill(0, ["gap_ha", "gaps"])
    ref = F.lit(percentile_ref(base, "outside"))
    score = priority_score(F.col("outside"), ref, F.col("risk"), F.col("share"), F.col("gap_ha"))
    out = met.withColumn("score", score)
    return ranks.row_number(out, [F.desc("score"), F.desc("outside"), F.col("gmi")], "rank")
