"""K, R, X, U, V: costs, recommendations, published analytics, unit packages, checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import scalars as S
from earshot.operators import costs as K
from earshot.operators import grid as G
from earshot.operators import population as P
from earshot.operators import ranks
from earshot.operators import recommend as R
from earshot.plans import queries_exposure as E
from earshot.plans.queries_coverage import DB, UNITS, _degrees_sql, covered, sites, units
from earshot.plans.queries_exposure import AF, CF, COVERED_POINTS, EXPOSURE, POINTS, PRIORITY
from earshot.plans.registry import query

c = F.col
COSTED = PRIORITY + ", kg AS (SELECT *, CASE WHEN seed = 'new_siren_likely' THEN 'new_large_siren' ELSE 'not_priced_as_integration' END AS action, CASE WHEN seed = 'new_siren_likely' THEN 40000 ELSE 0 END::BIGINT AS cost_pln FROM pg)"
_PPP = "CASE WHEN pop_night <= 0 THEN 0 ELSE round_even(cost_pln / pop_night, 2) END"
_CNT = "ic AS (SELECT sum(n)::BIGINT AS records, sum(l)::BIGINT AS records_linked, (sum(n) - sum(l))::BIGINT AS records_unlinked, count(*) AS sites, count(*) FILTER (m = 1) AS sites_linked, count(*) FILTER (m = 0) AS sites_unlinked FROM (SELECT x, y, count(*) AS n, sum(gsm_flag) AS l, max(gsm_flag) AS m FROM fx_sites GROUP BY x, y))"
_US = "us AS (SELECT x, y, arg_min(lp, lp) AS lp, arg_min(nr_ref, lp) AS nr_ref, arg_min(unit_no, lp) AS unit_no, count(*) AS records FROM fx_sites GROUP BY x, y HAVING max(gsm_flag) = 0)"


@query("k01_inventory_counts", _CNT + " SELECT * FROM ic", "fx_sites")
def k01(t):
    return K.inventory_counts(t.fx_sites)


@query("k02_unlinked_records", "SELECT nr_ref, 5000::BIGINT AS cost_pln FROM fx_sites WHERE gsm_flag = 0", "fx_sites")
def k02(t):
    return K.unlinked_records(t.fx_sites).select("nr_ref", "cost_pln")


@query("k03_unlinked_sites", _US + " SELECT *, 5000::BIGINT AS cost_pln FROM us", "fx_sites")
def k03(t):
    return K.unlinked_sites(t.fx_sites)


@query(
    "k04_link_costs_by_unit",
    _US + """, a AS (SELECT unit_no, count(*) AS records FROM fx_sites WHERE gsm_flag = 0 GROUP BY ALL), b AS (SELECT unit_no, count(*) AS sites FROM us GROUP BY ALL)
    SELECT unit_no, coalesce(records, 0) AS records, coalesce(sites, 0) AS sites, coalesce(records, 0) * 5000 AS records_pln, coalesce(sites, 0) * 5000 AS sites_pln FROM a FULL JOIN b USING (unit_no)""",
    "fx_sites",
)
def k04(t):
    return K.link_costs_by_unit(t.fx_sites)


def costed(t):
    return K.gap_costs(E.gaps(t))


@query("k05_gap_costs", COSTED + f" SELECT gap_id, action, cost_pln, {_PPP} AS pln_per_person FROM kg", *AF)
def k05(t):
    return costed(t).select("gap_id", "action", "cost_pln", "pln_per_person")


@query(
    "k06_unit_costs",
    COSTED + """, kc AS (SELECT gmi, count(*) FILTER (action = 'new_large_siren') AS new_large_siren, count(*) FILTER (action = 'not_priced_as_integration') AS not_priced_as_integration, sum(cost_pln)::BIGINT AS cost_pln FROM kg WHERE gmi IS NOT NULL GROUP BY gmi)
    SELECT gmi, rank, coalesce(new_large_siren, 0) AS new_large_siren, coalesce(not_priced_as_integration, 0) AS not_priced_as_integration, coalesce(cost_pln, 0) AS cost_pln FROM ur LEFT JOIN kc USING (gmi)""",
    *AF,
)
def k06(t):
    return K.unit_costs(costed(t), E.ranking(t)).select("gmi", c("rank").cast("bigint").alias("rank"), "new_large_siren", "not_priced_as_integration", "cost_pln")


SCEN = COSTED + ", " + _CNT + """, o AS (SELECT ic.*, (SELECT count(*) FROM sd) AS active, (SELECT count(DISTINCT site_uid) FROM co) AS covering, count(*) AS gaps, count(*) FILTER (action = 'new_large_siren') AS likely, coalesce(sum(cost_pln), 0)::BIGINT AS lp FROM kg, ic GROUP BY ALL),
sc AS (SELECT unnest([('integracja_wszystkich_syren_z_inwentaryzacji', records, records * 5000), ('integracja_wszystkich_aktywnych_lokalizacji', active, active * 5000), ('integracja_syren_bez_gsm', records_unlinked, records_unlinked * 5000),
 ('integracja_lokalizacji_bez_gsm_po_deduplikacji', sites_unlinked, sites_unlinked * 5000), ('integracja_lokalizacji_z_zasiegiem', covering, covering * 5000), ('wszystkie_luki_v12_jako_nowe_duze_syreny', gaps, gaps * 40000), ('tylko_luki_new_siren_likely', likely, lp),
 ('integracja_syren_bez_gsm_plus_new_siren_likely', records_unlinked + likely, records_unlinked * 5000 + lp), ('integracja_lokalizacji_bez_gsm_plus_new_siren_likely', sites_unlinked + likely, sites_unlinked * 5000 + lp),
 ('integracja_aktywnych_lokalizacji_plus_new_siren_likely', active + likely, active * 5000 + lp), ('integracja_aktywnych_lokalizacji_plus_wszystkie_luki_jako_nowe', active + gaps, active * 5000 + gaps * 40000)]) AS r FROM o)"""


def scenario_rows(t):
    active = sites(t).agg(F.count(F.lit(1)).alias("active"))
    covering = covered(t).agg(F.count_distinct("site_uid").alias("covering"))
    return K.scenarios(K.inventory_counts(t.fx_sites), active, covering, costed(t))


@query("k07_scenarios", SCEN + " SELECT r[1] AS scenario, r[2]::BIGINT AS quantity, r[3]::BIGINT AS cost_pln FROM sc", *AF)
def k07(t):
    return scenario_rows(t)


@query("k08_costs_by_class", COSTED + " SELECT priority_class, action, count(*) AS n, sum(cost_pln)::BIGINT AS cost_pln, round(sum(pop_night), 4) AS people FROM kg GROUP BY ALL", *AF)
def k08(t):
    return K.costs_by_class(costed(t))


# recommendations

_SENS = "so AS (SELECT bldg_id, bldg, CASE bldg WHEN 'school' THEN 'edukacja' ELSE 'administracja_i_publiczne' END AS object_group, 1 AS mount, x, y FROM fx_buildings WHERE bldg IN ('school', 'office'))"


@query("r01_sensitive_objects", _SENS + " SELECT * FROM so", "fx_buildings")
def r01(t):
    return R.sensitive_objects(t.fx_buildings)


SAMPLE = COSTED + ", gs AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY score DESC, pop_night DESC, gap_id) AS k FROM kg) WHERE k <= 2500 OR seed = 'new_siren_likely')"


def sample(t):
    return R.gap_sample(E.gaps(t))


@query("r02_gap_sample", SAMPLE + " SELECT gap_id, score, seed FROM gs", *AF)
def r02(t):
    return sample(t).select("gap_id", "score", "seed")


CAND = SAMPLE + ", " + _SENS + """, gr AS (SELECT gap_id, cy, min(cx) AS start, count(*) AS n FROM (SELECT *, cx - row_number() OVER (PARTITION BY gap_id, cy ORDER BY cx) AS g FROM lb) GROUP BY gap_id, cy, g),
gpt AS (SELECT gap_id, (start + n / 2e0) * 100 AS x, (cy + 0.5e0) * 100 AS y FROM (SELECT *, row_number() OVER (PARTITION BY gap_id ORDER BY abs(cy * 2 - lo - hi), cy, n DESC, start) AS k FROM
  (SELECT *, min(cy) OVER (PARTITION BY gap_id) AS lo, max(cy) OVER (PARTITION BY gap_id) AS hi FROM gr)) WHERE k = 1),
nm AS (SELECT gap_id, bldg_id, (p.x - so.x) ** 2 + (p.y - so.y) ** 2 AS d FROM gs JOIN gpt p USING (gap_id) JOIN so ON abs(p.x - so.x) <= 2000 AND abs(p.y - so.y) <= 2000),
nb AS (SELECT gap_id, arg_min(bldg_id, (d, bldg_id)) AS mount_id, min(d) AS d FROM nm WHERE d <= 4000000 GROUP BY gap_id),
cd AS (SELECT gs.*, mount_id, round(sqrt(d), 2) AS distance, CASE WHEN mount_id IS NULL THEN 'gap_representative_point' ELSE 'nearest_public_osm_object' END AS source, coalesce(so.bldg, 'gap_centroid') AS type, coalesce(so.object_group, 'brak_obiektu_publicznego_w_promieniu') AS object_group,
  coalesce(so.x, p.x) AS x, coalesce(so.y, p.y) AS y, round_even(least(100, score + CASE WHEN mount_id IS NULL THEN 0 ELSE 5 END), 2) AS score_v13,
  CASE WHEN seed = 'new_siren_likely' THEN 'nowa_syrena' ELSE 'walidacja_terenowa' END AS act,
  CASE WHEN pop_night >= 1000 OR area_ha >= 100 THEN 1200 WHEN pop_night >= 300 OR area_ha >= 25 THEN 900 WHEN pop_night >= 100 OR area_ha >= 5 THEN 600 ELSE 300 END AS power_w
  FROM gs JOIN gpt p USING (gap_id) LEFT JOIN nb USING (gap_id) LEFT JOIN so ON so.bldg_id = mount_id)"""


def candidates(t):
    at = G.representative_points(E.gap_labels(t).select("gap_id", "cx", "cy"), "gap_id")
    return R.candidate_sites(sample(t), at, R.sensitive_objects(t.fx_buildings))


@query("r03_candidate_sites", CAND + " SELECT gap_id, mount_id, distance, source, type, object_group, x, y FROM cd", *AF)
def r03(t):
    return candidates(t).select("gap_id", "mount_id", "distance", "source", "type", "object_group", "x", "y")


@query("r04_power_classes", CAND + " SELECT gap_id, power_w FROM cd", *AF)
def r04(t):
    return R.scored_candidates(candidates(t)).select("gap_id", "power_w")


@query("r05_scored_candidates", CAND + f" SELECT gap_id, score_v13, act AS action, cost_pln, {_PPP} AS pln_per_person FROM cd", *AF)
def r05(t):
    return R.scored_candidates(candidates(t)).select("gap_id", "score_v13", "action", "cost_pln", "pln_per_person")


SITEPOP = COVERED_POINTS + ", cs AS (SELECT site_uid, sum(pop_night) AS pop_night, sum(pop_day) AS pop_day FROM pc WHERE db > 0 GROUP BY site_uid)"


def collapsed(t):
    return R.collapse_sites(P.by_site(E.covered_points(t), sites(t), DB))


@query("r06_site_population", SITEPOP + " SELECT site_uid, round(coalesce(pop_night, 0), 6) AS pop_night, round(coalesce(pop_day, 0), 6) AS pop_day FROM sd LEFT JOIN cs USING (site_uid)", *CF)
def r06(t):
    return collapsed(t).select("site_uid", E.r6("pop_night"), E.r6("pop_day"))


_ACT = "CASE WHEN gsm_flag = 0 THEN 'integracja' WHEN kind = 'analogowa' OR moc_w <= 300 THEN 'modernizacja' WHEN sk_flag = 0 THEN 'walidacja_terenowa' ELSE 'brak_dzialania' END"


@query("r07_site_actions", f"SELECT nr_ref, {_ACT} AS action FROM fx_sites", "fx_sites")
def r07(t):
    return t.fx_sites.select("nr_ref", R.site_action(c("gsm_flag"), c("sk_flag"), c("kind"), c("moc_w")).alias("action"))


CRIT = SITEPOP + f""", cr AS (SELECT *, CASE WHEN action = 'integracja' THEN 5000 ELSE 0 END::BIGINT AS cost, row_number() OVER (ORDER BY loss DESC, site_uid) AS rank FROM
 (SELECT sd.site_uid, sd.nr_ref, round_even(coalesce(cs.pop_night, 0), 2) AS loss, {_ACT} AS action, sd.kind, sd.moc_w, sd.unit_no, sd.x, sd.y FROM sd LEFT JOIN cs USING (site_uid))),
er AS (SELECT *, round_even(round(least(100, 45 + 35 * least(1, ln(1 + loss) / ln(1 + ref)) + CASE WHEN action = 'integracja' THEN 10 ELSE 0 END), 6), 2) AS escore FROM (SELECT * FROM cr WHERE action <> 'brak_dzialania'),
 (SELECT greatest(1, quantile_cont(loss, 0.95)) AS ref FROM cr WHERE action <> 'brak_dzialania'))"""
_CLS = "CASE WHEN {0} >= 80 THEN 'A' WHEN {0} >= 60 THEN 'B' WHEN {0} >= 40 THEN 'C' ELSE 'niski' END"


def critical(t):
    return t.stage("critical", lambda: R.critical_sites(collapsed(t), sites(t)))


@query("r08_critical_sites", CRIT + " SELECT site_uid, nr_ref, loss, action, cost AS cost_pln, rank FROM cr", *CF)
def r08(t):
    return critical(t).select("site_uid", "nr_ref", "loss", "action", "cost_pln", c("rank").cast("bigint").alias("rank"))


@query("r09_existing_recommendations", CRIT + f" SELECT 'EXIST-' || nr_ref AS candidate_id, escore AS score, {_CLS.format('escore')} AS priority_class FROM er", *CF)
def r09(t):
    return R.existing_recommendations(critical(t)).select("candidate_id", "score", "priority_class")


@query("r10_missing_link_records", CRIT + " SELECT 'GSM-' || nr_ref AS candidate_id, 55::DOUBLE AS score, 5000::BIGINT AS cost_pln FROM fx_sites WHERE gsm_flag = 0 AND nr_ref NOT IN (SELECT nr_ref FROM er)", *CF)
def r10(t):
    return R.missing_link_recommendations(t.fx_sites, R.existing_recommendations(critical(t))).select("candidate_id", "score", "cost_pln")


def _present_sql(source: str, candidate: str, score: str, action: str, cost: str, loss: str) -> str:
    return f"""SELECT {candidate}, e.nr_ref, coalesce(un.wojewodztwo, ''), coalesce(un.powiat, ''), coalesce(un.gmina, ''), '', {action}, {_CLS.format(score)}, {score}, '', e.moc_w::BIGINT, 0, 0, 0, {loss}, {cost}, 0,
   round(g.lat, 7), round(g.lon, 7), 'existing_siren_V9_V10', e.kind, 'existing_siren_primary_coverage_proxy'
   FROM {source} e LEFT JOIN nm1 un USING (unit_no) JOIN (SELECT nr_ref, lat, lon FROM {_degrees_sql('x', 'y', source, 'nr_ref')}) g ON g.nr_ref = e.nr_ref"""


PURCHASES = CAND + CRIT[len(COVERED_POINTS):] + f""", nm1 AS (SELECT unit_no, gmi, 'Province ' || substr(gmi, 1, 2) AS wojewodztwo, 'County ' || substr(gmi, 1, 4) AS powiat, name AS gmina FROM fx_admin),
 ms AS (SELECT * FROM fx_sites WHERE gsm_flag = 0 AND nr_ref NOT IN (SELECT nr_ref FROM er)),
 pl AS (SELECT 'NEW-' || gap_id::VARCHAR AS candidate_id, '' AS nr_ref, coalesce(un.wojewodztwo, '') AS wojewodztwo, coalesce(un.powiat, '') AS powiat, coalesce(un.gmina, '') AS gmina, coalesce(cd.gmi, '') AS teryt_gmi,
   act AS recommended_action, priority_class, score_v13 AS priority_score_v13, CASE cd.risk WHEN 1 THEN 'niskie ryzyko' WHEN 2 THEN 'wysokie ryzyko' ELSE 'brak' END AS risk_class, power_w::BIGINT AS recommended_power_class_w, round_even(pop_night, 2) AS new_pop_ge65_proxy,
   round_even(pop_night, 2) AS flood_risk_pop_ge65_gain_proxy, 0::DOUBLE AS redundancy_gain_pop_proxy, 0::DOUBLE AS failure_loss_pop_night_proxy, cost_pln AS estimated_cost_pln, ({_PPP})::DOUBLE AS cost_per_new_person_ge65_pln,
   round(lat, 7) AS candidate_lat, round(lon, 7) AS candidate_lon, source AS candidate_source, type AS candidate_type, 'gap_population_proxy' AS effect_method
   FROM cd LEFT JOIN nm1 un ON un.gmi = cd.gmi JOIN (SELECT gap_id, lat, lon FROM {_degrees_sql('x', 'y', 'cd', 'gap_id')}) USING (gap_id)
 UNION ALL {_present_sql("er", "'EXIST-' || e.nr_ref", "escore", "action", "cost", "loss")}
 UNION ALL {_present_sql("ms", "'GSM-' || e.nr_ref", "55::DOUBLE", "'integracja'", "5000", "0")})"""


def unit_names(t):
    """unit_no, gmi and the names of province, county and commune."""
    code = lambda n, word: F.concat(F.lit(word), F.substring("gmi", 1, n))
    return t.fx_admin.select("unit_no", "gmi", code(2, "Province ").alias("wojewodztwo"), code(4, "County ").alias("powiat"), c("name").alias("gmina"))


def purchases(t):
    existing = R.existing_recommendations(critical(t))
    rows = lambda: R.purchase_list(R.scored_candidates(candidates(t)), existing, R.missing_link_recommendations(t.fx_sites, existing), unit_names(t))
    return t.stage("purchases", rows)


@query("r11_purchase_list", PURCHASES + " SELECT * FROM pl", *AF)
def r11(t):
    return purchases(t)


@query("r12_enriched_gaps", CAND + " SELECT pg.gap_id, pg.score, p.x, p.y, pg.pop_night, pg.pop_night AS people FROM pg JOIN gpt p USING (gap_id)", *AF)
def r12(t):
    at = G.representative_points(E.gap_labels(t).select("gap_id", "cx", "cy"), "gap_id")
    return G.on_cells(E.gaps(t), at, ["gap_id"]).select("gap_id", "score", "x", "y", "pop_night", c("pop_night").alias("people"))


@query("r13_stacked_exposure", EXPOSURE + " SELECT level, count(*) AS n, round(sum(night), 3) AS night FROM xp GROUP BY level", *AF)
def r13(t):
    return E.measures(t).groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("night"), 3).alias("night"))


@query(
    "r14_country_summary",
    PURCHASES + """ SELECT 'gaps' AS metric, count(*)::DOUBLE AS value FROM pg UNION ALL SELECT 'units', count(*)::DOUBLE FROM ub UNION ALL SELECT 'risk_people', round(sum(people), 4) FROM ub
    UNION ALL SELECT 'risk_outside', round(sum(outside), 4) FROM ub UNION ALL SELECT 'purchases', count(*)::DOUBLE FROM pl UNION ALL SELECT 'purchase_cost', sum(estimated_cost_pln)::DOUBLE FROM pl""",
    *AF,
)
def r14(t):
    n = F.count(F.lit(1)).cast("double")
    g = E.gaps(t).agg(n.alias("gaps"))
    u = E.base(t).agg(n.alias("units"), F.round(F.sum("people"), 4).alias("risk_people"), F.round(F.sum("outside"), 4).alias("risk_outside"))
    p = purchases(t).agg(n.alias("purchases"), F.sum("estimated_cost_pln").cast("double").alias("purchase_cost"))
    one = g.join(u, F.lit(True)).join(p, F.lit(True))
    return one.unpivot([], one.columns, "metric", "value")


@query("r15_unit_percentages", PRIORITY + " SELECT gmi, CASE WHEN people = 0 THEN 0 ELSE round_even(inside * 100 / people, 2) END AS pct_in, CASE WHEN people = 0 THEN 0 ELSE round_even(outside * 100 / people, 2) END AS pct_out FROM (SELECT gmi, round(people, 4) AS people, round(inside, 4) AS inside, outside FROM ub)", *AF)
def r15(t):
    b = E.base(t).withColumns({"people": F.round("people", 4), "inside": F.round("inside", 4)})
    return R.pct_columns(b).select("gmi", "pct_in", "pct_out")


@query("r16_outside_ranking", PRIORITY + " SELECT gmi, outside, row_number() OVER (ORDER BY outside DESC, gmi) AS place FROM ub", *AF)
def r16(t):
    return ranks.row_number(E.base(t).select("gmi", "outside"), [F.desc("outside"), c("gmi")], "place")


@query("r17_action_summary", PURCHASES + " SELECT recommended_action AS action, count(*) AS n, sum(estimated_cost_pln)::BIGINT AS cost_pln, round(sum(new_pop_ge65_proxy + failure_loss_pop_night_proxy), 3) AS people FROM pl GROUP BY ALL", *AF)
def r17(t):
    return R.action_summary(purchases(t))


@query("r18_scenario_value", SCEN + " SELECT coalesce(max(r[3]::BIGINT) FILTER (r[1] = 'integracja_lokalizacji_bez_gsm_po_deduplikacji'), 0) AS cost_pln FROM sc", *AF)
def r18(t):
    return R.lookup_value(scenario_rows(t), "integracja_lokalizacji_bez_gsm_po_deduplikacji")


@query("r19_decision_lists", PURCHASES + """, a AS (SELECT 'units' AS list, gmi AS key FROM ub ORDER BY outside DESC, gmi LIMIT 15), b AS (SELECT 'purchases' AS list, candidate_id AS key FROM pl ORDER BY priority_score_v13 DESC, new_pop_ge65_proxy DESC, failure_loss_pop_night_proxy DESC, candidate_id LIMIT 25),
 d AS (SELECT 'critical' AS list, nr_ref AS key FROM cr ORDER BY rank LIMIT 20) SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM d""", *AF)
def r19(t):
    item = lambda name, col: [F.lit(name).alias("list"), c(col).alias("key")]
    a = R.top(E.base(t), 15, F.desc("outside"), "gmi").select(*item("units", "gmi"))
    b = R.top(purchases(t), 25, *R.purchase_order()).select(*item("purchases", "candidate_id"))
    d = R.top(critical(t), 20, "rank").select(*item("critical", "nr_ref"))
    return a.unionByName(b).unionByName(d)


# analytics

GENERAL = POINTS + ", gu1 AS (SELECT *, substr(gmi, 1, 2) AS woj, substr(gmi, 1, 4) AS pow FROM pu)" + ", gn AS (" + " UNION ALL ".join(
    f"SELECT '{lv}' AS level, {code} AS code, round(sum(pop_night), 3) AS pop_total, " + ", ".join(f"round(sum(CASE WHEN db >= {d} THEN pop_night ELSE 0 END), 3) AS pop_ge{d}" for d in DB)
    + f", round(sum(CASE WHEN db >= {DB[0]} THEN 0 ELSE pop_night END), 3) AS pop_outside FROM gu1 {where} GROUP BY ALL"
    for lv, code, where in (("country", "'PL'", ""), ("woj", "woj", "WHERE gmi IS NOT NULL"), ("pow", "pow", "WHERE gmi IS NOT NULL"), ("gmi", "gmi", "WHERE gmi IS NOT NULL"))
) + ")"


def general_coverage(t):
    """People in all, at or above each level and outside, for every unit of every level, from one rollup."""
    p = E.unit_points(t).withColumns({"woj": F.substring("gmi", 1, 2), "pow": F.substring("gmi", 1, 4)})
    at = lambda test: F.round(F.sum(F.when(test, c("pop_night")).otherwise(0.0)), 3)
    cube = p.rollup("woj", "pow", "gmi").agg(
        F.round(F.sum("pop_night"), 3).alias("pop_total"), *(at(c("db") >= d).alias(f"pop_ge{d}") for d in DB), at(c("db") < DB[0]).alias("pop_outside"), F.grouping_id().alias("g")
    )
    level = F.when(c("g") == 7, "country").when(c("g") == 3, "woj").when(c("g") == 1, "pow").otherwise("gmi")
    rows = cube.where("g = 7 or woj is not null")
    return rows.select(level.alias("level"), F.coalesce("gmi", "pow", "woj", F.lit("PL")).alias("code"), "pop_total", *(f"pop_ge{d}" for d in DB), "pop_outside")


@query("x01_general_coverage", GENERAL + " SELECT *, CASE WHEN pop_total = 0 THEN 0 ELSE round_even(pop_ge80 * 100 / pop_total, 2) END AS pct_in FROM gn", *AF)
def x01(t):
    g = general_coverage(t)
    return g.withColumn("pct_in", S.pct(c("pop_ge80"), c("pop_total")))


@query("x02_gaps_by_class", PRIORITY + " SELECT priority_class, count(*) AS n FROM pg GROUP BY ALL", *AF)
def x02(t):
    return E.gaps(t).groupBy("priority_class").agg(F.count(F.lit(1)).alias("n"))


@query("x03_pareto", PRIORITY + " SELECT gap_id, row_number() OVER w AS place, round(sum(pop_night) OVER (ORDER BY pop_night DESC, gap_id ROWS UNBOUNDED PRECEDING) / (SELECT sum(pop_night) FROM pg), 5) AS share FROM pg WINDOW w AS (ORDER BY pop_night DESC, gap_id)", *AF)
def x03(t):
    gaps, order = E.gaps(t).select("gap_id", "pop_night"), [F.desc("pop_night"), c("gap_id")]
    total = gaps.agg(F.sum("pop_night").alias("total"))
    summed = ranks.running(ranks.row_number(gaps, order, "place"), order, "pop_night", "run")
    return summed.join(F.broadcast(total), F.lit(True)).select("gap_id", "place", F.round(c("run") / c("total"), 5).alias("share"))


@query("x04_top_gaps", PRIORITY + " SELECT gap_id, pop_night, score FROM pg ORDER BY pop_night DESC, gap_id LIMIT 100", *AF)
def x04(t):
    return R.top(E.gaps(t), 100, F.desc("pop_night"), "gap_id").select("gap_id", "pop_night", "score")


@query("x05_fleet_profile", "SELECT unit_no // 20 AS woj, count(*) FILTER (kind = 'cyfrowa') AS cyfrowa, count(*) FILTER (kind = 'analogowa') AS analogowa, CASE WHEN count(*) FILTER (kind = 'cyfrowa') > count(*) FILTER (kind = 'analogowa') THEN 'cyfrowa' ELSE 'analogowa' END AS dominant FROM fx_sites GROUP BY ALL", "fx_sites")
def x05(t):
    wide = t.fx_sites.groupBy(F.floor(c("unit_no") / 20).cast("bigint").alias("woj")).pivot("kind", ["cyfrowa", "analogowa"]).count().na.fill(0)
    return wide.withColumn("dominant", F.when(c("cyfrowa") > c("analogowa"), "cyfrowa").otherwise("analogowa"))


@query("x06_hot_zones", PRIORITY + " SELECT gap_id, pop_night FROM (SELECT *, ntile(20) OVER (ORDER BY pop_night DESC, gap_id) AS k FROM pg WHERE risk = 2) WHERE k = 1", *AF)
def x06(t):
    placed = ranks.row_number(E.gaps(t).where("risk = 2").select("gap_id", "pop_night"), [F.desc("pop_night"), c("gap_id")], "place")
    total = placed.agg(F.count(F.lit(1)).alias("n"))
    return placed.join(F.broadcast(total), F.lit(True)).where(ranks.ntile(c("place"), c("n"), 20) == 1).select("gap_id", "pop_night")


@query("x07_risk_shares", EXPOSURE + " SELECT risk, night, round(night / (SELECT sum(night) FROM xp WHERE level = 'country'), 5) AS share FROM xp WHERE level = 'country'", *AF)
def x07(t):
    rows = E.measures(t).where("level = 'country'")
    total = rows.agg(F.sum("night").alias("total"))
    return rows.join(F.broadcast(total), F.lit(True)).select("risk", "night", F.round(c("night") / c("total"), 5).alias("share"))


@query(
    "x08_sensitive_near_gaps",
    CAND + """, n2 AS (SELECT DISTINCT gmi, so.bldg_id FROM pg JOIN gpt p USING (gap_id) JOIN so ON abs(p.x - so.x) <= 1000 AND abs(p.y - so.y) <= 1000 WHERE priority_class IN ('A', 'B') AND gmi IS NOT NULL AND (p.x - so.x) ** 2 + (p.y - so.y) ** 2 <= 1000000)
    SELECT gmi, count(*) AS objects FROM n2 GROUP BY gmi ORDER BY objects DESC, gmi LIMIT 20""",
    *AF,
)
def x08(t):
    """Distinct objects within 1 km of urgent gaps, by bins, then the largest units."""
    at = G.representative_points(E.gap_labels(t).select("gap_id", "cx", "cy"), "gap_id")
    urgent = E.gaps(t).where("priority_class in ('A', 'B') and gmi is not null").select("gap_id", "gmi")
    urgent = G.on_cells(urgent, at, ["gap_id"])
    boxes = urgent.select("gmi", c("x").alias("xmin"), c("y").alias("ymin"), F.lit(0).alias("w"), F.lit(0).alias("h"))
    met = G.within_box(R.sensitive_objects(t.fx_buildings).select("bldg_id", "x", "y"), boxes, 1000, 2000)
    return R.top(met.groupBy("gmi").agg(F.count_distinct("bldg_id").alias("objects")), 20, F.desc("objects"), "gmi")


@query("x09_top_units", PRIORITY + " SELECT gmi, outside FROM ub ORDER BY outside DESC, gmi LIMIT 20", *AF)
def x09(t):
    return R.top(E.base(t), 20, F.desc("outside"), "gmi").select("gmi", "outside")


# unit packages

@query("u01_unit_rows", PURCHASES + " SELECT gmi, candidate_id, estimated_cost_pln AS cost_pln FROM pl JOIN fx_admin ON gmi = teryt_gmi", *AF)
def u01(t):
    """Every unit's rows at once: a join to the unit dimension, ready for partitionBy."""
    return purchases(t).join(t.fx_admin.select("gmi").hint("merge"), c("gmi") == c("teryt_gmi")).select("gmi", "candidate_id", c("estimated_cost_pln").alias("cost_pln"))


@query(
    "u02_unit_metrics",
    PURCHASES + GENERAL[len(POINTS):] + """ SELECT g.code, round(pop_total)::BIGINT AS pop_total, round(pop_ge80)::BIGINT AS pop_ge, round(pop_outside)::BIGINT AS pop_outside, coalesce(k.n, 0) AS gaps, coalesce(k.cost, 0)::BIGINT AS gap_cost
    FROM gn g LEFT JOIN (SELECT gmi, count(*) AS n, sum(cost_pln) AS cost FROM kg GROUP BY gmi) k ON k.gmi = g.code WHERE level = 'gmi'""",
    *AF,
)
def u02(t):
    g = general_coverage(t).where("level = 'gmi'")
    k = costed(t).groupBy("gmi").agg(F.count(F.lit(1)).alias("gaps"), F.sum("cost_pln").alias("gap_cost")).withColumnRenamed("gmi", "code")
    whole = lambda n, out: F.round(n).cast("bigint").alias(out)
    return G.on_cells(g, k, ["code"], "left").na.fill(0, ["gaps", "gap_cost"]).select("code", whole("pop_total", "pop_total"), whole("pop_ge80", "pop_ge"), whole("pop_outside", "pop_outside"), "gaps", "gap_cost")


@query("u03_coverage_rows", GENERAL + " SELECT level, code, coalesce(name, code) AS name, pop_total, pop_outside FROM gn LEFT JOIN fx_admin ON gmi = code", *AF)
def u03(t):
    names = t.fx_admin.select(c("gmi").alias("code"), "name")
    return G.on_cells(general_coverage(t), names, ["code"], "left").select("level", "code", F.coalesce("name", "code").alias("name"), "pop_total", "pop_outside")


_D = "sqrt(greatest(xmin - {0}.x, 0, {0}.x - xmin - w) ** 2 + greatest(ymin - {0}.y, 0, {0}.y - ymin - h) ** 2) <= 10000"


@query("u04_context_counts", UNITS + f" SELECT un.unit_no, 'sites' AS layer, count(*) AS n FROM un JOIN fx_sites s ON {_D.format('s')} GROUP BY ALL UNION ALL SELECT un.unit_no, 'sensitive', count(*) FROM un JOIN (SELECT * FROM fx_buildings WHERE bldg IN ('school', 'office')) s ON {_D.format('s')} GROUP BY ALL", "fx_sites", "fx_admin", "fx_buildings")
def u04(t):
    boxes = units(t).select("unit_no", "xmin", "ymin", "w", "h")
    layer = lambda name, df: G.within_box(df, boxes, 10_000).groupBy("unit_no").agg(F.count(F.lit(1)).alias("n")).select("unit_no", F.lit(name).alias("layer"), "n")
    return layer("sites", t.fx_sites.select("nr_ref", "x", "y")).unionByName(layer("sensitive", R.sensitive_objects(t.fx_buildings).select("bldg_id", "x", "y")))


@query("u05_unit_balance", GENERAL + " SELECT code, abs(pop_total - pop_ge80 - pop_outside) < 0.05 AS balanced, pop_total >= 0 AND pop_outside >= 0 AS non_negative FROM gn WHERE level = 'gmi'", *AF)
def u05(t):
    g = general_coverage(t).where("level = 'gmi'")
    return g.select("code", (F.abs(c("pop_total") - c("pop_ge80") - c("pop_outside")) < 0.05).alias("balanced"), ((c("pop_total") >= 0) & (c("pop_outside") >= 0)).alias("non_negative"))


# validation

@query("v01_national_acceptance", PURCHASES + """ SELECT 'records' AS name, count(*) AS actual, count(*) > 0 AS ok FROM fx_sites UNION ALL SELECT 'active_sites', count(*), count(*) <= (SELECT count(*) FROM fx_sites) FROM sd
 UNION ALL SELECT 'purchases', count(*), count(*) = count(DISTINCT candidate_id) FROM pl UNION ALL SELECT 'units', count(*), count(*) = count(DISTINCT gmi) FROM fx_admin""", *AF)
def v01(t):
    n = F.count(F.lit(1))
    row = lambda name, df, ok: df.agg(n.alias("actual"), ok.alias("ok")).select(F.lit(name).alias("name"), "actual", "ok")
    records = row("records", t.fx_sites, n > 0)
    active = sites(t).agg(n.alias("actual")).join(t.fx_sites.agg(n.alias("all")), F.lit(True)).select(F.lit("active_sites").alias("name"), "actual", (c("actual") <= c("all")).alias("ok"))
    bought = row("purchases", purchases(t), n == F.count_distinct("candidate_id"))
    return records.unionByName(active).unionByName(bought).unionByName(row("units", t.fx_admin, n == F.count_distinct("gmi")))


@query("v02_percent_ranges", PRIORITY + ", u AS (SELECT gmi, CASE WHEN people = 0 THEN 0 ELSE inside * 100 / people END AS pct_in, CASE WHEN people = 0 THEN 0 ELSE outside * 100 / people END AS pct_out FROM ub) SELECT 'pct_in' AS field, bool_and(pct_in BETWEEN -0.004 AND 100.004) AS ok FROM u UNION ALL SELECT 'pct_out', bool_and(pct_out BETWEEN -0.004 AND 100.004) FROM u", *AF)
def v02(t):
    one = r15(t).agg(*(F.bool_and(c(n).between(0, 100)).alias(n) for n in ("pct_in", "pct_out")))
    return one.unpivot([], one.columns, "field", "ok")


@query("v03_night_balance", EXPOSURE + " SELECT bool_and(abs(night - night_in - night_out) <= 0.05) AS ok, count(*) AS n FROM xp", *AF)
def v03(t):
    return E.measures(t).agg(F.bool_and(F.abs(c("night") - c("night_in") - c("night_out")) <= 0.05).alias("ok"), F.count(F.lit(1)).alias("n"))


@query(
    "v04_action_recount",
    PURCHASES + """, q AS (SELECT action, sum(n)::BIGINT AS n2, sum(k)::BIGINT AS k2 FROM (
      SELECT act AS action, count(*) AS n, sum(cost_pln) AS k FROM cd GROUP BY act UNION ALL SELECT action, count(*), sum(cost) FROM er GROUP BY action UNION ALL SELECT 'integracja', count(*), count(*) * 5000 FROM ms) GROUP BY action HAVING sum(n) > 0)
    SELECT q.action, q.n2 AS n, q.k2 AS cost_pln, q.n2 = count(pl.candidate_id) AND q.k2 = sum(estimated_cost_pln) AS equal FROM q LEFT JOIN pl ON recommended_action = q.action GROUP BY q.action, q.n2, q.k2""",
    *AF,
)
def v04(t):
    """Counts and costs of each action, from the three sources of the list, held against the written list."""
    existing = R.existing_recommendations(critical(t))
    sources = (R.scored_candidates(candidates(t)), existing, R.missing_link_recommendations(t.fx_sites, existing))
    rows = reduce(DataFrame.unionByName, (s.select("action", "cost_pln") for s in sources))
    parts = rows.groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.sum("cost_pln").alias("cost_pln"))
    listed = R.action_summary(purchases(t)).select("action", c("n").alias("n2"), c("cost_pln").alias("k2"))
    equal = F.coalesce((c("n") == c("n2")) & (c("cost_pln") == c("k2")), F.lit(False))
    return parts.join(listed, "action", "left").select("action", "n", "cost_pln", equal.alias("equal"))
