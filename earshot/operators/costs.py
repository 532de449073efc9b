"""Costs and scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import scalars as S
from earshot.operators.grid import on_cells

# fixed values
NEW_SITE_PLN, INTEGRATION_PLN = 40_000, 5_000


def _unlinked_sites(register: DataFrame) -> DataFrame:
    """One row per coordinate without any link: its first record by lp and the record count."""
    sites = register.groupBy("x", "y").agg(F.max("gsm_flag").alias("link"), F.min(F.struct("lp", "nr_ref", "unit_no")).alias("first"), F.count(F.lit(1)).alias("records"))
    return sites.where("link = 0").select("x", "y", "first.lp", "first.nr_ref", "first.unit_no", "records")


def inventory_counts(register: DataFrame) -> DataFrame:
    """One row: records, with and without link, unique sites, sites with and without any link."""
    sites = register.groupBy("x", "y").agg(F.max("gsm_flag").alias("link"), F.count(F.lit(1)).alias("n"), F.sum("gsm_flag").alias("linked"))
    return sites.agg(
        F.sum("n").alias("records"), F.sum("linked").alias("records_linked"), (F.sum("n") - F.sum("linked")).alias("records_unlinked"),
        F.count(F.lit(1)).alias("sites"), F.count_if(F.col("link") == 1).alias("sites_linked"), F.count_if(F.col("link") == 0).alias("sites_unlinked"),
    )


def unlinked_records(register: DataFrame, cost: int = INTEGRATION_PLN) -> DataFrame:
    return register.where("gsm_flag = 0").withColumn("cost_pln", F.lit(cost).cast("bigint"))


def unlinked_sites(register: DataFrame, cost: int = INTEGRATION_PLN) -> DataFrame:
    return _unlinked_sites(register).withColumn("cost_pln", F.lit(cost).cast("bigint"))


def link_costs_by_unit(register: DataFrame, cost: int = INTEGRATION_PLN) -> DataFrame:
    """Records and sites without link per unit, outer-joined, zeros filled."""
    records = unlinked_records(register).groupBy("unit_no").agg(F.count(F.lit(1)).alias("records"))
    sites = _unlinked_sites(register).groupBy("unit_no").agg(F.count(F.lit(1)).alias("sites"))
    out = on_cells(records, sites, ["unit_no"], "full_outer").na.fill(0, ["records", "sites"])
    return out.withColumns({"records_pln": F.col("records") * cost, "sites_pln": F.col("sites") * cost})


def gap_costs(gaps: DataFrame, cost: int = NEW_SITE_PLN) -> DataFrame:
    action = F.when(F.col("seed") == "new_siren_likely", "new_large_siren").otherwise("not_priced_as_integration")
    out = gaps.withColumn("action", action).withColumn("cost_pln", F.when(F.col("action") == "new_large_siren", cost).otherwise(0).cast("bigint"))
    return out.withColumn("pln_per_person", S.cost_per_person(F.col("cost_pln"), F.col("pop_night")))


def unit_costs(costed: DataFrame, ranking: DataFrame) -> DataFrame:
    """Ranking with gap counts by action and the cost sum."""
    actions = ["new_large_siren", "not_priced_as_integration"]
    wide = costed.where("gmi is not null").groupBy("gmi").pivot("action", actions).count()
    sums = costed.where("gmi is not null").groupBy("gmi").agg(F.sum("cost_pln").alias("cost_pln"))
    return on_cells(on_cells(ranking, wide, ["gmi"], "left"), sums, ["gmi"], "left").na.fill(0, [*actions, "cost_pln"])


def scenarios(counts: DataFrame, active_sites: DataFrame, covering: DataFrame, costed: DataFrame, new: int = NEW_SITE_PLN, link: int = INTEGRATION_PLN) -> DataFrame:
    """(scenario, quantity, cost_pln): eleven budgets from four one-row tables."""
    g = costed.agg(F.count(F.lit(1)).alias("gaps"), F.count_if(F.col("action") == "new_large_siren").alias("likely"), F.coalesce(F.sum("cost_pln"), F.lit(0)).alias("likely_pln"))
    one = counts.join(active_sites, F.lit(True)).join(covering, F.lit(True)).join(g, F.lit(True))
    q = F.col
    rows = [
        ("integracja_wszystkich_syren_z_inwentaryzacji", q("records"), q("records") * link),
        ("integracja_wszystkich_aktywnych_lokalizacji", q("active"), q("active") * link),
        ("integracja_syren_bez_gsm", q("records_unlinked"), q("records_unlinked") * link),
        ("integracja_lokalizacji_bez_gsm_po_deduplikacji", q("sites_unlinked"), q("sites_unlinked") * link),
        ("integracja_lokalizacji_z_zasiegiem", q("covering"), q("covering") * link),
        ("wszystkie_luki_v12_jako_nowe_duze_syreny", q("gaps"), q("gaps") * new),
        ("tylko_luki_new_siren_likely", q("likely"), q("likely_pln")),
        ("integracja_syren_bez_gsm_plus_new_siren_likely", q("records_unlinked") + q("likely"), q("records_unlinked") * link + q("likely_pln")),
        ("integracja_lokalizacji_bez_gsm_plus_new_siren_likely", q("sites_unlinked") + q("likely"), q("sites_unlinked") * link + q("likely_pln")),
        ("integracja_aktywnych_lokalizacji_plus_new_siren_likely", q("active") + q("likely"), q("active") * link + q("likely_pln")),
        ("integracja_aktywnych_lokalizacji_plus_wszystkie_luki_jako_nowe", q("active") + q("gaps"), q("active") * link + q("gaps") * new),
    ]
    return one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("scenario"), a.alias("quantity"), b.cast("bigint").alias("cost_pln")) for n, a, b in rows))).alias("s")).select("s.*")


def costs_by_class(costed: DataFrame) -> DataFrame:
    return costed.groupBy("priority_class", "action").agg(F.count(F.lit(1)).alias("n"), F.sum("cost_pln").alias("cost_pln"), F.round(F.sum("pop_night"), 4).alias("people"))
