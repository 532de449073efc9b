"""C: corrections, registry, overlay and imputation over projections of ``part`` and ``customer``."""

from __future__ import annotations

from pyspark.sql import functions as F


from earshot.operators import changes as C
from earshot.plans.queries_audit import REG, _num, _reg
from earshot.plans.registry import query

FIELDS = ["name", "brand", "size", "grade"]


@query("c01_duplicate_keys", "SELECT nr_ref, count(*) AS n FROM fx_register GROUP BY nr_ref HAVING count(*) > 1", "fx_register")
def c01(t):
    return C.duplicate_keys(t.fx_register, "nr_ref")


@query("c02_conflicting_corrections", "SELECT nr_ref, field, count(*) AS n FROM (SELECT replace(nr_ref, '0', '') AS nr_ref, field FROM fx_corrections) GROUP BY ALL HAVING count(*) > 1", "fx_corrections")
def c02(t):
    return C.duplicate_keys(t.fx_corrections.withColumn("nr_ref", F.replace("nr_ref", F.lit("0"), F.lit(""))), "nr_ref", "field")


CLASSIFIED = """cells AS (UNPIVOT (SELECT nr_ref, name, brand, size, grade FROM fx_v1) ON name, brand, size, grade INTO NAME field VALUE before),
cl AS (SELECT c.nr_ref, c.field, x.before, c.suggested, c.confidence, c.method, CASE WHEN c.confidence < 0.5 THEN 'below_confidence' WHEN b.nr_ref IS NULL THEN 'unknown_record'
  WHEN c.field NOT IN ('name', 'brand', 'size', 'grade') THEN 'unknown_column' ELSE 'applied' END AS outcome, x.before IS NOT DISTINCT FROM c.expected AS matched
  FROM fx_corrections c LEFT JOIN fx_v1 b USING (nr_ref) LEFT JOIN cells x ON x.nr_ref = c.nr_ref AND x.field = c.field)"""


@query("c03_classify_corrections", CLASSIFIED + " SELECT nr_ref, field, before, suggested, confidence, outcome, matched FROM cl", "fx_v1", "fx_corrections")
def c03(t):
    return C.classify_corrections(t.fx_v1, t.fx_corrections)


def _applied(t):
    return C.classify_corrections(t.fx_v1, t.fx_corrections).where("outcome = 'applied'")


@query(
    "c04_apply_corrections",
    CLASSIFIED + ", ap AS (SELECT * FROM cl WHERE outcome = 'applied') SELECT b.nr_ref, "
    + ", ".join(f"CASE WHEN c{i}.nr_ref IS NOT NULL THEN c{i}.suggested ELSE b.{f} END AS {f}" for i, f in enumerate(FIELDS))
    + " FROM fx_v1 b " + " ".join(f"LEFT JOIN ap c{i} ON c{i}.nr_ref = b.nr_ref AND c{i}.field = '{f}'" for i, f in enumerate(FIELDS)),
    "fx_v1", "fx_corrections",
)
def c04(t):
    return C.apply_cells(t.fx_v1, _applied(t))


@query("c05_outcome_counts", CLASSIFIED + " SELECT outcome, matched, count(*) AS n FROM cl GROUP BY ALL", "fx_v1", "fx_corrections")
def c05(t):
    return C.counts_by(C.classify_corrections(t.fx_v1, t.fx_corrections), "outcome", "matched")


SNAPSHOT = {
    "fx_v5": ["gmina", "moc_w", "robocza", "wlasciciel", "wysokosc_nad_terenem_m"],
    "fx_v6": ["gmina", "moc_w", "wlasciciel", "wysokosc_nad_terenem_m"],
    "fx_v9": ["gmina", "moc_w", "npm_m", "wlasciciel", "wysokosc_nad_terenem_m"],
}


def _diff_sql(a: str, b: str, removed: bool = False) -> str:
    """Registry rows of a step, written after the register's own rules: values, reasons, ids and sources."""
    old, new = a[3:].upper(), b[3:].upper()
    stage = f"{old}→{new}"
    value = lambda f: f"coalesce(a.{f}, '')" if f in SNAPSHOT[a] else "''"
    rows = [f"SELECT 'update' AS operation, a.nr_ref, '{f}' AS field, {value(f)} AS before, coalesce(b.{f}, '') AS after FROM {a} a JOIN {b} b USING (nr_ref) WHERE {value(f)} <> coalesce(b.{f}, '')" for f in SNAPSHOT[b]]
    record = ", ".join(f"CASE WHEN coalesce({f}, '') <> '' THEN '\"{f}\": ' || to_json({f})::VARCHAR END" for f in sorted([*SNAPSHOT[b], "nr_ref"]))
    rows.append(f"SELECT 'add', nr_ref, 'record_json', '', '{{' || array_to_string([{record}], ', ') || '}}' FROM {b} WHERE nr_ref NOT IN (SELECT nr_ref FROM {a})")
    rows.append(f"SELECT 'disable', nr_ref, 'record', 'active', 'disabled' FROM {a} WHERE nr_ref NOT IN (SELECT nr_ref FROM {b})")
    if removed:
        rows += [f"SELECT 'remove_field', '*', '{f}', 'column present', 'column removed'" for f in SNAPSHOT[a] if f not in SNAPSHOT[b]]
    power = "Ujednolicenie mocy modelowej, w tym analogowej SAD do odpowiednika DSE V9." if "V9" in stage else "Korekta jednostki lub wartości mocy po kontroli jakości."
    return f"""SELECT 'CORR-' || upper(substr(sha256('{stage}|' || operation || '|' || nr_ref || '|' || field), 1, 12)) AS rule_id, '{stage}' AS stage, operation, nr_ref, field, before, after,
      CASE WHEN operation = 'add' THEN 'Rekord dodany między snapshotami.' WHEN operation = 'disable' THEN 'Rekord usunięty z aktywnego snapshotu.'
           WHEN operation = 'remove_field' THEN 'Usunięcie technicznej kolumny roboczej ze schematu kolejnego snapshotu.'
           WHEN field = 'wysokosc_nad_terenem_m' THEN 'Korekta wysokości montażu zgodnie z kontrolami domenowymi V5–V8.' WHEN field = 'moc_w' THEN '{power}'
           WHEN field = 'npm_m' THEN 'Uzupełnienie wysokości n.p.m. z danych SRTM.' ELSE 'Zmiana zarejestrowana między zatwierdzonymi snapshotami pipeline.' END AS reason,
      CASE WHEN operation IN ('add', 'disable') THEN '{new}.csv' ELSE '{old}.csv -> {new}.csv' END AS source,
      CASE WHEN operation = 'update' AND (before = '' OR after = '') THEN 0.9 ELSE 1.0 END::DOUBLE AS confidence
    FROM ({" UNION ALL ".join(rows)})"""


CHAIN = _diff_sql("fx_v5", "fx_v6", True) + " UNION ALL " + _diff_sql("fx_v6", "fx_v9")


def chain(t):
    return C.diff_chain([("V5", t.fx_v5), ("V6", t.fx_v6), ("V9", t.fx_v9)])


@query("c06_diff_snapshots", _diff_sql("fx_v5", "fx_v6"), "fx_v5", "fx_v6")
def c06(t):
    return C.diff(t.fx_v5, t.fx_v6, ("V5", "V6"))


@query("c07_diff_chain", CHAIN, "fx_v5", "fx_v6", "fx_v9")
def c07(t):
    return chain(t)


@query(
    "c08_removed_columns",
    f"SELECT r.*, (SELECT count(*) FROM fx_v5 WHERE robocza <> '') AS filled FROM ({_diff_sql('fx_v5', 'fx_v6', True)}) r WHERE operation = 'remove_field'",
    "fx_v5", "fx_v6",
)
def c08(t):
    return C.removed_columns(t.fx_v5, t.fx_v6, ("V5", "V6"))


@query("c09_rule_ids", "SELECT nr_ref, 'CORR-' || upper(substr(sha256('V8→V9|update|' || nr_ref || '|' || field), 1, 12)) AS rule_id FROM fx_corrections", "fx_corrections")
def c09(t):
    return t.fx_corrections.select("nr_ref", C.rule_id(F.lit("V8→V9"), F.lit("update"), F.col("nr_ref"), F.col("field")).alias("rule_id"))


@query("c10_reasons", f"SELECT stage, reason, confidence, count(*) AS n FROM ({CHAIN}) GROUP BY ALL", "fx_v5", "fx_v6", "fx_v9")
def c10(t):
    return C.counts_by(chain(t), "stage", "reason", "confidence")


@query("c11_replay", "SELECT * FROM fx_v9", "fx_v9")
def c11(t):
    """The first snapshot with the whole registry applied: the last snapshot."""
    return C.replay(t.fx_v5, chain(t), ["V5→V6", "V6→V9"])


@query(
    "c12_replay_guard",
    f"""rg AS ({_diff_sql('fx_v5', 'fx_v6')}), cells AS (UNPIVOT (SELECT * FROM fx_v9) ON COLUMNS(* EXCLUDE nr_ref) INTO NAME field VALUE found),
    j AS (SELECT rg.rule_id, rg.nr_ref, rg.field, rg.before, c.found, CASE WHEN b.nr_ref IS NULL THEN 'missing_record' WHEN rg.before <> coalesce(c.found, '') THEN 'before_differs' END AS violation
      FROM rg LEFT JOIN fx_v9 b USING (nr_ref) LEFT JOIN cells c ON c.nr_ref = rg.nr_ref AND c.field = rg.field WHERE operation = 'update')
    SELECT * FROM j WHERE violation IS NOT NULL""",
    "fx_v5", "fx_v6", "fx_v9",
)
def c12(t):
    """The registry of the first step held against a later snapshot: what it no longer fits."""
    return C.replay_violations(t.fx_v9, C.diff(t.fx_v5, t.fx_v6, ("V5", "V6")))


@query("c13_snapshot_difference", "SELECT *, 'left' AS side FROM (SELECT * FROM fx_v2 EXCEPT ALL SELECT * FROM fx_v3) UNION ALL SELECT *, 'right' FROM (SELECT * FROM fx_v3 EXCEPT ALL SELECT * FROM fx_v2)", "fx_v2", "fx_v3")
def c13(t):
    return C.snapshot_difference(t.fx_v2, t.fx_v3)


@query(
    "c14_validation_metrics",
    REG + """one AS (SELECT 1) SELECT count(*) AS records, count(*) FILTER (height > 30) AS height_over_30, count(*) FILTER (moc_w = '') AS power_blank,
      count(*) FILTER (lower(moc_w) = 'nan') AS power_nan, count(DISTINCT power) AS powers, count(*) FILTER (height IS NULL) AS height_missing FROM reg""",
    "fx_register",
)
def c14(t):
    n = F.count_if
    return _reg(t).agg(
        F.count(F.lit(1)).alias("records"), n(F.col("height") > 30).alias("height_over_30"), n(F.col("moc_w") == "").alias("power_blank"),
        n(F.lower("moc_w") == "nan").alias("power_nan"), F.count_distinct("power").alias("powers"), n(F.col("height").isNull()).alias("height_missing"),
    )


@query("c15_table_digest", "SELECT count(*) AS n, sum(('0x' || substr(sha256(concat_ws('|', brand, grade, name, nr_ref, size)), 1, 8))::BIGINT)::BIGINT AS digest FROM fx_v2", "fx_v2")
def c15(t):
    return C.table_digest(t.fx_v2)


_BLANK = "coalesce(operation, '') || coalesce(nr_ref, '') || unit || kind || moc_w || height || lat || lon || gsm"


@query("c16_overlay_rows", f"SELECT * FROM fx_overlay WHERE trim({_BLANK}) <> ''", "fx_overlay")
def c16(t):
    return C.overlay_rows(t.fx_overlay)


def _m(n: str) -> str:
    return _num(f"coalesce(nullif(o.{n}, ''), b.{n})")


_SETS = "(o.kind <> '' OR o.moc_w <> '' OR o.height <> '' OR o.lat <> '' OR o.lon <> '' OR o.gsm <> '')"
REJECTS = f"""ov AS (SELECT * FROM fx_overlay WHERE trim({_BLANK}) <> ''), tw AS (SELECT nr_ref, count(*) AS times FROM ov GROUP BY nr_ref),
rj AS (SELECT o.row_no, o.nr_ref, o.operation, CASE WHEN times > 1 THEN 'duplicate_key' WHEN o.operation NOT IN ('add', 'update', 'disable') THEN 'bad_operation'
  WHEN o.operation = 'add' AND b.nr_ref IS NOT NULL THEN 'add_exists' WHEN o.operation IN ('update', 'disable') AND b.nr_ref IS NULL THEN 'missing_record'
  WHEN o.operation = 'disable' AND {_SETS} THEN 'disable_with_data' WHEN o.operation = 'update' AND NOT {_SETS} THEN 'empty_update'
  WHEN o.operation = 'add' AND o.unit NOT IN (SELECT gmi FROM fx_admin) THEN 'unknown_unit'
  WHEN NOT coalesce({_m('lat')} BETWEEN 48.5 AND 55.2 AND {_m('lon')} BETWEEN 13.5 AND 24.5 AND {_m('moc_w')} BETWEEN 300 AND 5500 AND {_m('height')} BETWEEN 3 AND 30, false)
  THEN 'value_out_of_range' END AS reject FROM ov o JOIN tw USING (nr_ref) LEFT JOIN fx_base b USING (nr_ref))"""


@query("c17_overlay_rejects", REJECTS + " SELECT * FROM rj", "fx_overlay", "fx_base", "fx_admin")
def c17(t):
    return C.overlay_rejects(t.fx_base, C.overlay_rows(t.fx_overlay), t.fx_admin)


@query("c18_overlay_ranges", REJECTS + " SELECT coalesce(reject, 'sound') AS reject, count(*) AS n FROM rj GROUP BY ALL", "fx_overlay", "fx_base", "fx_admin")
def c18(t):
    rejects = C.overlay_rejects(t.fx_base, C.overlay_rows(t.fx_overlay), t.fx_admin)
    return C.counts_by(rejects.withColumn("reject", F.coalesce("reject", F.lit("sound"))), "reject")


def _sound(t):
    rows = C.overlay_rows(t.fx_overlay)
    return rows.join(C.overlay_rejects(t.fx_base, rows, t.fx_admin).where("reject is null").select("row_no"), "row_no", "left_semi")


SOUND = REJECTS + ", so AS (SELECT * FROM ov WHERE row_no IN (SELECT row_no FROM rj WHERE reject IS NULL))"
_SETF = ["kind", "moc_w", "height", "lat", "lon", "gsm"]


@query(
    "c19_apply_overlay",
    SOUND + " SELECT b.nr_ref, " + ", ".join(f"CASE WHEN s.operation = 'update' THEN coalesce(nullif(s.{c}, ''), b.{c}) ELSE b.{c} END AS {c}" for c in _SETF)
    + ", CASE WHEN s.operation = 'disable' THEN '0' ELSE b.active END AS active FROM fx_base b LEFT JOIN so s USING (nr_ref) UNION ALL SELECT nr_ref, " + ", ".join(_SETF) + ", '1' FROM so WHERE operation = 'add'",
    "fx_overlay", "fx_base", "fx_admin",
)
def c19(t):
    return C.apply_overlay(t.fx_base, _sound(t))


def _audit(part: str) -> str:
    return "array_to_string(list_filter([" + ", ".join(f"CASE WHEN s.{c} <> '' AND s.{c} IS DISTINCT FROM b.{c} THEN {part.replace('@', c)} END" for c in _SETF) + "], lambda x: x IS NOT NULL), '; ')"


@query(
    "c20_overlay_audit",
    SOUND + f" SELECT s.row_no, s.operation, s.nr_ref, {_audit(chr(39) + '@' + chr(39))} AS field, {_audit('coalesce(b.@, ' + chr(39) * 2 + ')')} AS before, {_audit('s.@')} AS after FROM so s LEFT JOIN fx_base b USING (nr_ref)",
    "fx_overlay", "fx_base", "fx_admin",
)
def c20(t):
    return C.overlay_audit(t.fx_base, _sound(t))


@query("c21_active_sites", "SELECT nr_ref FROM fx_base WHERE upper(coalesce(nullif(trim(active), ''), '1')) NOT IN ('0', 'FALSE', 'NIE')", "fx_base")
def c21(t):
    return t.fx_base.where(C.active(F.col("active"))).select("nr_ref")


IMPUTED = REG + """pe AS (SELECT kind, power AS p, sum(height) AS h, count(*) AS n FROM reg WHERE height > 8 AND power IS NOT NULL GROUP BY ALL),
mn AS (SELECT r.lp, sum(h / (1 + abs(power - p) / 100)) / sum(n / (1 + abs(power - p) / 100)) AS m, coalesce(sum(n) FILTER (p = power), 0)::BIGINT AS exact_peers, sum(n)::BIGINT AS peers
  FROM reg r JOIN pe ON pe.kind IS NOT DISTINCT FROM r.kind WHERE r.height <= 8 AND power IS NOT NULL GROUP BY r.lp),
im AS (SELECT nr_ref, lp, kind, power, height, round_even(round(m, 6) / 0.5e0, 0) * 0.5e0 AS imputed, exact_peers, peers FROM reg JOIN mn USING (lp))"""


@query("c22_impute_heights", IMPUTED + " SELECT * FROM im", "fx_register")
def c22(t):
    return C.impute_heights(_reg(t), highest=8.0, above=8.0)


@query("c23_imputation_report", IMPUTED + " SELECT kind, count(*) AS n, min(imputed) AS low, max(imputed) AS high, round(avg(imputed), 6) AS mean, median(imputed) AS median FROM im GROUP BY kind", "fx_register")
def c23(t):
    return C.imputation_report(C.impute_heights(_reg(t), highest=8.0, above=8.0))


@query(
    "c24_add_elevation",
    """el AS (SELECT floor(x / 1000e0)::BIGINT AS cx, floor(y / 1000e0)::BIGINT AS cy, avg(height_m) AS npm FROM fx_buildings GROUP BY ALL)
    SELECT nr_ref, round_even(coalesce(npm, 0), 1) AS npm_m FROM fx_sites LEFT JOIN el ON cx = floor(x / 1000e0)::BIGINT AND cy = floor(y / 1000e0)::BIGINT""",
    "fx_sites", "fx_buildings",
)
def c24(t):
    cells = t.fx_buildings.groupBy(F.floor(F.col("x") / 1000).alias("cx"), F.floor(F.col("y") / 1000).alias("cy")).agg(F.avg("height_m").alias("npm"))
    return C.add_elevation(t.fx_sites, cells).select("nr_ref", "npm_m")



