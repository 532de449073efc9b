"""Recommendations: candidate sites, critical sites, purchase list and result tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import scalars as S
from earshot.functions.geo import to_degrees
from earshot.operators import ranks
from earshot.operators.grid import on_cells
from earshot.operators.costs import INTEGRATION_PLN, NEW_SITE_PLN
from earshot.operators.quantiles import quantile
from earshot.operators.risk import priority_class
from earshot.operators.spatial_join import nearest

# fixed values
PUBLIC_TYPES = {
    "school": "edukacja",
    "kindergarten": "edukacja",
    "college": "edukacja",
    "university": "edukacja",
    "hospital": "zdrowie_i_opieka",
    "clinic": "zdrowie_i_opieka",
    "doctors": "zdrowie_i_opieka",
    "nursing_home": "zdrowie_i_opieka",
    "social_facility": "zdrowie_i_opieka",
    "fire_station": "bezpieczenstwo",
    "public": "administracja_i_publiczne",
    "civic": "administracja_i_publiczne",
    "city_hall": "administracja_i_publiczne",
    "office": "administracja_i_publiczne",
    "government": "administracja_i_publiczne",
    "sports_centre": "inne_publiczne",
    "stadium": "inne_publiczne",
    "transportation": "transport",
    "train_station": "transport",
}
MOUNT_TYPES = ["fire_station", "public", "civic", "city_hall", "office", "government", "school", "kindergarten", "sports_centre", "transportation"]
TOP_GAPS, MOUNT_RADIUS_M, PUBLIC_BONUS, MISSING_LINK_SCORE = 2500, 2000, 5.0, 55.0
RISK_LABELS = {1: "niskie ryzyko", 2: "wysokie ryzyko"}
PURCHASE = [
    "candidate_id",
    "nr_ref",
    "wojewodztwo",
    "powiat",
    "gmina",
    "teryt_gmi",
    "recommended_action",
    "priority_class",
    "priority_score_v13",
    "risk_class",
    "recommended_power_class_w",
    "new_pop_ge65_proxy",
    "flood_risk_pop_ge65_gain_proxy",
    "redundancy_gain_pop_proxy",
    "failure_loss_pop_night_proxy",
    "estimated_cost_pln",
    "cost_per_new_person_ge65_pln",
    "candidate_lat",
    "candidate_lon",
    "candidate_source",
    "candidate_type",
    "effect_method",
]


def sensitive_objects(buildings: DataFrame) -> DataFrame:
    groups = F.create_map(*(F.lit(v) for kv in PUBLIC_TYPES.items() for v in kv))
    rows = buildings.where(F.col("bldg").isin(list(PUBLIC_TYPES)))
    return rows.select("bldg_id", "bldg", F.element_at(groups, F.col("bldg")).alias("object_group"), F.col("bldg").isin(MOUNT_TYPES).cast("int").alias("mount"), "x", "y")


def gap_sample(gaps: DataFrame, top: int = TOP_GAPS) -> DataFrame:
    """The top gaps by score and every gap where a new site is likely. The top is a
    distributed take; its ids come back by a semi join."""
    best = gaps.orderBy(F.desc("score"), F.desc("pop_night"), "gap_id").limit(top).select("gap_id", F.lit(True).alias("top"))
    return gaps.join(best, "gap_id", "left").where("top or seed = 'new_siren_likely'").drop("top")


def power_class(people: Column, area_ha: Column) -> Column:
    step = lambda p, a: (people >= p) | (area_ha >= a)
    return F.when(step(1000, 100), 1200).when(step(300, 25), 900).when(step(100, 5), 600).otherwise(300)


def candidate_sites(sample: DataFrame, gap_points: DataFrame, objects: DataFrame, radius: int = MOUNT_RADIUS_M) -> DataFrame:
    """Sampled gaps with the nearest mount site in reach, else the gap's own point."""
    at = on_cells(sample, gap_points, ["gap_id"])
    mounts = objects.where("mount = 1").select(F.col("bldg_id").alias("mount_id"), "bldg", "object_group", "x", "y")
    near = nearest(at, mounts, radius, "gap_id", "mount_id").groupBy("gap_id").agg(F.min("mount_id").alias("mount_id"), F.min("distance").alias("distance"))
    place = mounts.select("mount_id", "bldg", "object_group", F.col("x").alias("mx"), F.col("y").alias("my"))
    out = on_cells(on_cells(at, near, ["gap_id"]), place, ["mount_id"], "left")
    has = F.col("mount_id").isNotNull()
    return out.withColumns(
        {
            "source": F.when(has, "nearest_public_osm_object").otherwise("gap_representative_point"), "type": F.coalesce("bldg", F.lit("gap_centroid")),
            "object_group": F.coalesce("object_group", F.lit("brak_obiektu_publicznego_w_promieniu")), "x": F.coalesce("mx", "x"), "y": F.coalesce("my", "y"), "distance": F.round("distance", 2),
        }
    ).drop("mx", "my", "bldg")


def scored_candidates(candidates: DataFrame, cost: int = NEW_SITE_PLN) -> DataFrame:
    bonus = F.when(F.col("mount_id").isNotNull(), PUBLIC_BONUS).otherwise(0.0)
    action = F.when(F.col("seed") == "new_siren_likely", "nowa_syrena").otherwise("walidacja_terenowa")
    out = candidates.withColumns({"score_v13": S.half_even(F.least(F.lit(100.0), F.col("score") + bonus), 2), "action": action, "power_w": power_class(F.col("pop_night"), F.col("area_ha"))})
    out = out.withColumn("cost_pln", F.when(F.col("action") == "nowa_syrena", cost).otherwise(0).cast("bigint"))
    return out.withColumn("pln_per_person", S.cost_per_person(F.col("cost_pln"), F.col("pop_night")))


def collapse_sites(rows: DataFrame) -> DataFrame:
    """Per site the largest cumulative population over its class rows."""
    return rows.groupBy("site_uid").agg(F.max("pop_night_ge").alias("pop_night"), F.max("pop_day_ge").alias("pop_day"))


def site_action(gsm: Column, sk: Column, kind: Column, power: Column) -> Column:
    return F.when(gsm == 0, "integracja").when((kind == "analogowa") | (power <= 300), "modernizacja").when(sk == 0, "walidacja_terenowa").otherwise("brak_dzialania")


def critical_sites(collapsed: DataFrame, sites: DataFrame, cost: int = INTEGRATION_PLN) -> DataFrame:
    """Sites by the people who would lose coverage, with action, cost and rank."""
    action = site_action(F.col("gsm_flag"), F.col("sk_flag"), F.col("kind"), F.col("moc_w"))
    out = on_cells(sites, collapsed, ["site_uid"], "left").na.fill(0.0, ["pop_night", "pop_day"]).withColumns({"loss": S.half_even(F.col("pop_night"), 2), "action": action})
    out = out.withColumn("cost_pln", F.when(F.col("action") == "integracja", cost).otherwise(0).cast("bigint"))
    return ranks.row_number(out, [F.desc("loss"), F.col("site_uid")], "rank")


def existing_recommendations(critical: DataFrame) -> DataFrame:
    """Sites that need action: 45 + 35 by loss against its 95th percentile + 10 where a link is missing."""
    rows = critical.where("action <> 'brak_dzialania'")
    ref = max(1.0, quantile(rows, "loss", 0.95) or 0.0)
    part = F.least(F.lit(1.0), F.log1p("loss") / F.log1p(F.lit(ref)))
    score = F.least(F.lit(100.0), 45 + 35 * part + F.when(F.col("action") == "integracja", 10.0).otherwise(0.0))
    out = rows.withColumn("score", S.half_even(F.round(score, 6), 2))
    return out.withColumns({"priority_class": priority_class(F.col("score")), "candidate_id": F.concat(F.lit("EXIST-"), "nr_ref")})


def missing_link_recommendations(register: DataFrame, listed: DataFrame, cost: int = INTEGRATION_PLN) -> DataFrame:
    """Records without link that no other recommendation lists; fixed score."""
    rows = on_cells(register.where("gsm_flag = 0"), listed.select("nr_ref").distinct(), ["nr_ref"], "left_anti")
    score = F.lit(MISSING_LINK_SCORE)
    return rows.withColumns({"score": score, "priority_class": priority_class(score), "action": F.lit("integracja"), "cost_pln": F.lit(cost).cast("bigint"), "candidate_id": F.concat(F.lit("GSM-"), "nr_ref")})


def purchase_list(new: DataFrame, existing: DataFrame, missing: DataFrame, units: DataFrame) -> DataFrame:
    """All recommendations in one schema, best score first, then most new people, then the greatest loss.

    ``units`` (unit_no, gmi, wojewodztwo, powiat, gmina) names places: a new site's by the code of its gap, the
    others' by their unit. New sites keep the class of their gap's score before the bonus."""
    c = F.col
    blank, zero = F.lit(""), F.lit(0.0)
    place = ["wojewodztwo", "powiat", "gmina"]

    def rows(df: DataFrame, **columns: Column) -> DataFrame:
        lat, lon = to_degrees(c("x"), c("y"))
        columns |= {"candidate_lat": F.round(lat, 7), "candidate_lon": F.round(lon, 7), **{p: F.coalesce(c(p), blank) for p in place}}
        return df.select(*(columns[name].alias(name) for name in PURCHASE))

    people = S.half_even(F.col("pop_night"), 2)
    a = rows(
        on_cells(new, units.drop("unit_no"), ["gmi"], "left"),
        candidate_id=F.concat(F.lit("NEW-"), c("gap_id").cast("string")),
        nr_ref=blank,
        teryt_gmi=F.coalesce("gmi", blank),
        recommended_action=c("action"),
        priority_class=c("priority_class"),
        priority_score_v13=c("score_v13"),
        risk_class=F.when(c("risk") == 1, RISK_LABELS[1]).when(c("risk") == 2, RISK_LABELS[2]).otherwise("brak"),
        recommended_power_class_w=c("power_w").cast("bigint"),
        new_pop_ge65_proxy=people,
        flood_risk_pop_ge65_gain_proxy=people,
        redundancy_gain_pop_proxy=zero,
        failure_loss_pop_night_proxy=zero,
        estimated_cost_pln=c("cost_pln"),
        cost_per_new_person_ge65_pln=c("pln_per_person"),
        candidate_source=c("source"),
        candidate_type=c("type"),
        effect_method=F.lit("gap_population_proxy"),
    )

    def present(df: DataFrame, loss: Column) -> DataFrame:
        return rows(
            on_cells(df, units.drop("gmi"), ["unit_no"], "left"),
            candidate_id=c("candidate_id"),
            nr_ref=c("nr_ref"),
            teryt_gmi=blank,
            recommended_action=c("action"),
            priority_class=c("priority_class"),
            priority_score_v13=c("score"),
            risk_class=blank,
            recommended_power_class_w=c("moc_w").cast("bigint"),
            new_pop_ge65_proxy=zero,
            flood_risk_pop_ge65_gain_proxy=zero,
            redundancy_gain_pop_proxy=zero,
            failure_loss_pop_night_proxy=loss,
            estimated_cost_pln=c("cost_pln"),
            cost_per_new_person_ge65_pln=zero,
            candidate_source=F.lit("existing_siren_V9_V10"),
            candidate_type=c("kind"),
            effect_method=F.lit("existing_siren_primary_coverage_proxy"),
        )

    out = reduce(DataFrame.unionByName, (a, present(existing, c("loss")), present(missing, zero)))
    return out.orderBy(*purchase_order())


def purchase_order() -> list[Column]:
    """Best score, most new people, greatest loss; the id tells the rest apart."""
    return [F.desc("priority_score_v13"), F.desc("new_pop_ge65_proxy"), F.desc("failure_loss_pop_night_proxy"), F.asc("candidate_id")]


def action_summary(purchases: DataFrame) -> DataFrame:
    people = F.col("new_pop_ge65_proxy") + F.col("failure_loss_pop_night_proxy")
    return purchases.groupBy(F.col("recommended_action").alias("action")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("estimated_cost_pln").alias("cost_pln"), F.round(F.sum(people), 3).alias("people")
    )


def lookup_value(rows: DataFrame, scenario: str, default: int = 0) -> DataFrame:
    return rows.agg(F.coalesce(F.max(F.when(F.col("scenario") == scenario, F.col("cost_pln"))), F.lit(default)).alias("cost_pln"))


def pct_columns(units: DataFrame) -> DataFrame:
    return units.withColumns({"pct_in": S.pct(F.col("inside"), F.col("people")), "pct_out": S.pct(F.col("outside"), F.col("people"))})


def top(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows: the limit is the report's."""
    return df.orderBy(*order).limit(n)
