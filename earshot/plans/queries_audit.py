"""Q: the register audit over the register projection of ``customer``."""

from __future__ import annotations

from pyspark.sql import functions as F

from earshot.operators import audit as A
from earshot.operators.grid import deal
from earshot.plans.queries_scalars import CLEAN, ND, NULLS, NUMBER, TOKEN, WS, flag, shown, slug, tri
from earshot.plans.registry import query


def _clean(name: str) -> str:
    return CLEAN.replace("{0}", name)


def _num(name: str) -> str:
    return NUMBER.replace("{0}", f"replace(regexp_replace({name}, '{WS}', '', 'g'), ',', '.')")


def _nullish(name: str) -> str:
    """Blank, a word for nothing, or N/D."""
    t = TOKEN.replace("{0}", f"{name}::VARCHAR")
    return f"({t} IN {NULLS} OR {t} IN {ND})"


def _gap(name: str) -> str:
    """What is to be filled in: N/D in a signal column of an analogue unit is an answer."""
    t = TOKEN.replace("{0}", f"{name}::VARCHAR")
    if name in ("sygn_osp", "sygn_ol", "wgr_sygn"):
        return f"({t} IN {NULLS} OR ({t} IN {ND} AND kind IS DISTINCT FROM 'analogowa'))"
    return _nullish(name)


def _label(name: str) -> str:
    return f"nullif(lower(trim(regexp_replace(coalesce({name}, ''), '{WS}', ' ', 'g'))), '')"


REG = f"""
reg0 AS (SELECT *, {_label("wojewodztwo")} AS woj_key, {_label("powiat")} AS pow_key, {_label("wlasciciel")} AS owner, {_label("rodzaj_syreny")} AS kind,
  {_num("moc_w")} AS power, {_num("wysokosc")} AS height, {_num("lat")} AS lat_n, {_num("lon")} AS lon_n,
  {", ".join(f"{tri(s)} AS st_{s}" for s in A.STATUSES)} FROM fx_register),
reg AS (SELECT *, coalesce(CASE WHEN kind = 'analogowa' THEN power BETWEEN 2000 AND 5000 ELSE power BETWEEN 300 AND 5000 END, false) AS power_ok,
  coalesce(height BETWEEN 3 AND 60, false) AS height_ok FROM reg0),
"""


def _near(value: str) -> str:
    ok = f"{value}_ok"
    return f"""(SELECT r.*, coalesce(a.m, b.m) AS m, CASE WHEN a.m IS NOT NULL THEN 'powiat+rodzaj' WHEN b.m IS NOT NULL THEN 'wojewodztwo+rodzaj' END AS scope FROM reg r
      LEFT JOIN (SELECT woj_key, pow_key, kind, avg({value}) AS m FROM reg WHERE {ok} GROUP BY ALL HAVING count(*) >= 3) a USING (woj_key, pow_key, kind)
      LEFT JOIN (SELECT woj_key, kind, avg({value}) AS m FROM reg WHERE {ok} GROUP BY ALL HAVING count(*) >= 3) b USING (woj_key, kind))"""


def _mode(keys: str, value: str) -> str:
    return f"""(SELECT {keys}, arg_min(v, (-n, v)) AS v, max(n) AS n, max(n) / sum(n) AS share FROM
      (SELECT {keys}, {value} AS v, count(*) AS n FROM reg WHERE {value} IS NOT NULL GROUP BY ALL) GROUP BY ALL
      HAVING max(n) >= 5 AND max(n) / sum(n) >= 0.8)"""


def _mad(keys: str, value: str) -> str:
    return f"""(SELECT {keys}, any_value(med) AS med, median(abs({value} - med)) AS mad, count(*) AS n FROM
      (SELECT *, median({value}) OVER (PARTITION BY {keys}) AS med FROM reg WHERE {value}_ok) GROUP BY {keys} HAVING count(*) >= 10)"""


def _anomaly(rule: str, field: str, raw: str, value: str, category: str, severity: str, confidence: float, reason: str, source: str) -> str:
    return (
        f"SELECT 'anomaly' AS kind, '{rule}' AS rule, lp, nr_ref, '{field}' AS field, {raw} AS raw, {value} AS value, '{category}' AS category, '{severity}' AS severity, "
        f"{confidence}::DOUBLE AS confidence, NULL::VARCHAR AS method, NULL::VARCHAR AS scope, {reason} AS reason FROM {source}"
    )


def _correct(rule: str, field: str, raw: str, value: str, method: str, confidence: str, scope: str, reason: str, source: str) -> str:
    return (
        f"SELECT 'correction' AS kind, '{rule}' AS rule, lp, nr_ref, '{field}' AS field, {raw} AS raw, {value} AS value, NULL::VARCHAR AS category, NULL::VARCHAR AS severity, "
        f"round_even({confidence}, 2)::DOUBLE AS confidence, '{method}' AS method, {scope} AS scope, {reason} AS reason FROM {source}"
    )


def _raw(*names: str) -> str:
    return " || ' / ' || ".join(f"coalesce({n}::VARCHAR, '')" for n in names)


def _step(x: str, step: str) -> str:
    return shown(f"round_even({x} / {step}, 0) * {step}")


_HEAD = {"moc_w": "Moc [W]", "wysokosc": "Wysokość nad terenem [m]", "lat": "Lat", "lon": "Long", "jednostka_psp": "Jednostka PSP", "kod_swd": "Kod SWD"}
_STATUS_HEAD = {"gsm": "GSM", "sk_psp": "SK PSP", "sygn_osp": "Sygn. OSP", "sygn_ol": "Sygn. OL", "wgr_sygn": "Wgr. sygn."}
_LOCAL = "'Uzupelnienie brakujacej {} na podstawie sredniej lokalnej dla rodzaju syreny.'"
GLOBAL = """(SELECT avg(power) FILTER (kind = 'analogowa' AND power_ok) AS ga, avg(height) FILTER (height_ok) AS gh,
  avg(height) FILTER (height_ok AND kind = 'analogowa') AS gha, avg(height) FILTER (height_ok AND kind = 'cyfrowa') AS ghd FROM reg)"""
_KIND_HEIGHT = "(SELECT r.*, k.m AS km, gh FROM reg r LEFT JOIN (SELECT kind, avg(height) AS m FROM reg WHERE height_ok AND kind IS NOT NULL GROUP BY kind) k USING (kind), " + GLOBAL + ")"


def _missing(rule: str, name: str, number: str, step: str, text: str, reason: str) -> list[str]:
    none = f"{number} IS NULL AND {_gap(name)}"
    return [
        _anomaly(rule, _HEAD[name], _raw(name), "''", "technical", "high", 1.0, f"'{text}'", f"reg WHERE {none}"),
        _correct(rule, _HEAD[name], _raw(name), _step("m", step), "srednia lokalna", "0.55", "scope", _LOCAL.format(reason), f"{_near(number)} WHERE m IS NOT NULL AND {none}"),
    ]


def _dominant(rule: str, head: str, name: str, source: str, most: str, text: str) -> str:
    return _correct(rule, head, _raw(name), "v", "dominanta lokalna", f"least({most}::DOUBLE, share)", "scope",
                    f"'Uzupelnienie na podstawie {text} w grupie (' || n || ' rekordow).'", f"{source} WHERE v IS NOT NULL AND {_gap(name)}")


_NO_LAT, _NO_LON = f"(lat_n IS NULL AND {_gap('lat')})", f"(lon_n IS NULL AND {_gap('lon')})"
_BOTH = f"lat_n IS NOT NULL AND lon_n IS NOT NULL AND NOT (lat_n BETWEEN 49 AND 55 AND lon_n BETWEEN 14 AND 24)"
_SWAP = "(lon_n BETWEEN 49 AND 55 AND lat_n BETWEEN 14 AND 24)"
_STATUS_MODES = {
    n: f"(SELECT r.*, coalesce(a.v, b.v) AS v, CASE WHEN a.v IS NOT NULL THEN a.n ELSE b.n END AS n, CASE WHEN a.v IS NOT NULL THEN a.share ELSE b.share END AS share, "
    f"CASE WHEN a.v IS NOT NULL THEN 'powiat+rodzaj' ELSE 'wojewodztwo+rodzaj' END AS scope FROM reg r "
    f"LEFT JOIN {_mode('woj_key, pow_key, kind', f'st_{n}')} a USING (woj_key, pow_key, kind) LEFT JOIN {_mode('woj_key, kind', f'st_{n}')} b USING (woj_key, kind))"
    for n in A.STATUSES
}
_UNIT_MODES = {n: f"(SELECT r.*, v, n, share, 'wojewodztwo+powiat' AS scope FROM reg r LEFT JOIN {_mode('woj_key, pow_key', n)} USING (woj_key, pow_key))" for n in ("jednostka_psp", "kod_swd")}


def _outlier(rule: str, name: str, number: str, severity: str, confidence: float, word: str) -> str:
    pick = lambda c: f"CASE WHEN a.med IS NOT NULL THEN a.{c} WHEN b.med IS NOT NULL THEN b.{c} ELSE c.{c} END AS {c}"
    source = (
        f"(SELECT r.*, {pick('med')}, {pick('mad')}, {pick('n')}, CASE WHEN a.med IS NOT NULL THEN 'powiat+rodzaj' WHEN b.med IS NOT NULL THEN 'wojewodztwo+rodzaj' ELSE 'rodzaj' END AS scope FROM reg r "
        f"LEFT JOIN {_mad('woj_key, pow_key, kind', number)} a USING (woj_key, pow_key, kind) LEFT JOIN {_mad('woj_key, kind', number)} b USING (woj_key, kind) LEFT JOIN {_mad('kind', number)} c USING (kind))"
    )
    reason = f"'{word} odbiega od mediany grupy (' || scope || ', n=' || n || ') o wiecej niz 2.5 MAD.'"
    return _anomaly(rule, _HEAD[name], _raw(name), shown(number), "relational", severity, confidence, reason, f"{source} WHERE {number}_ok AND mad > 0 AND abs({number} - med) / mad > 2.5")


RULE_SQL = {
    "duplicates": [
        _anomaly("duplicate_id", head, _raw(n), f"coalesce({_clean(f'{n}::VARCHAR')}, '')", "administrative", "high", 1.0, f"'Duplikat identyfikatora {head}'", f"(SELECT *, count(*) OVER (PARTITION BY {_clean(f'{n}::VARCHAR')}) AS c FROM reg) WHERE c > 1")
        for n, head in (("lp", "Lp."), ("nr_ref", "Nr ref."))
    ],
    "status_form": [
        _correct("status_form", h, _raw(s), f"st_{s}", "standaryzacja TAK/NIE/N/D", "1", "'regula logiczna'", "'Ujednolicenie wariantu zapisu wartosci logicznej.'", f"reg WHERE {_clean(s)} IS NOT NULL AND st_{s} IS NOT NULL AND {_clean(s)} <> st_{s}")
        for s, h in _STATUS_HEAD.items()
    ],
    "parse_errors": [
        _anomaly("parse_error", _HEAD[n], _raw(n), "''", "technical", "high", 1.0, "'Nie udalo sie sparsowac wartosci liczbowej.'", f"reg WHERE {_clean(n)} IS NOT NULL AND {TOKEN.replace('{0}', n)} NOT IN {ND} AND ({_num(n)}) IS NULL")
        for n in ("moc_w", "wysokosc", "lat", "lon")
    ],
    "missing_power": _missing("missing_power", "moc_w", "power", "100", "Brak mocy syreny.", "mocy"),
    "missing_height": _missing("missing_height", "wysokosc", "height", "0.5e0", "Brak wysokosci montazu syreny.", "wysokosci"),
    "analogue_power": [
        _anomaly("analogue_power", "Moc [W]", _raw("moc_w"), shown("power"), "technical", "high", 1.0, "'Moc syreny analogowej poza dopuszczalnym zakresem 2000-5000 W.'", "reg WHERE kind = 'analogowa' AND (power < 2000 OR power > 5000)"),
        _correct("analogue_power", "Moc [W]", _raw("moc_w"), _step("ga", "100"), "srednia analogowych", "0.9", "'global analogowa'", "'Korekta na podstawie sredniej innych poprawnych syren analogowych.'", f"reg, {GLOBAL} WHERE ga IS NOT NULL AND kind = 'analogowa' AND (power < 2000 OR power > 5000)"),
    ],
    "digital_power": [
        _anomaly("digital_power", "Moc [W]", _raw("moc_w"), shown("power"), "technical", "medium", 0.75, "'Moc syreny cyfrowej poza typowym zakresem 300-5000 W.'", "reg WHERE kind IS DISTINCT FROM 'analogowa' AND (power < 300 OR power > 5000)"),
        _correct("digital_power", "Moc [W]", _raw("moc_w"), _step("m", "100"), "srednia lokalna", "0.45", "scope", "'Niska pewnosc: korekta cyfrowej mocy do sredniej lokalnej dla rodzaju syreny.'", f"{_near('power')} WHERE m IS NOT NULL AND kind IS DISTINCT FROM 'analogowa' AND (power < 300 OR power > 5000)"),
    ],
    "height_range": [
        _anomaly("height_sea_level", _HEAD["wysokosc"], _raw("wysokosc"), shown("height"), "technical", "high", 0.98, "'Prawdopodobnie wpisano wysokosc npm zamiast wysokosci montazu nad terenem.'", "reg WHERE height >= 100"),
        _correct("height_sea_level", _HEAD["wysokosc"], _raw("wysokosc"), _step("coalesce(km, gh)", "0.5e0"), "srednia montazu nad terenem", "0.88", "CASE WHEN km IS NULL THEN 'global wszystkie rodzaje' ELSE 'rodzaj=' || kind END",
                 "'Korekta na podstawie sredniej poprawnych wysokosci montazu nad terenem.'", f"{_KIND_HEIGHT} WHERE coalesce(km, gh) IS NOT NULL AND height >= 100"),
        _anomaly("height_review", _HEAD["wysokosc"], _raw("wysokosc"), shown("height"), "technical", "medium", 0.55, "'Wysokosc montazu w zakresie 61-99 m wymaga przegladu.'", "reg WHERE height BETWEEN 61 AND 99"),
        _anomaly("height_low", _HEAD["wysokosc"], _raw("wysokosc"), shown("height"), "technical", "high", 0.95, "'Wysokosc montazu ponizej typowego minimum 3 m.'", "reg WHERE height < 3"),
    ],
    "coordinates": [
        _anomaly("coordinates_missing", head, _raw(*names), "''", "geographic", "high", 1.0, "'Brak wspolrzednych geograficznych.'", f"reg WHERE {where}")
        for head, names, where in (("Lat", ["lat"], f"{_NO_LAT} AND NOT {_NO_LON}"), ("Long", ["lon"], f"{_NO_LON} AND NOT {_NO_LAT}"), ("Lat|Long", ["lat", "lon"], f"{_NO_LAT} AND {_NO_LON}"))
    ] + [
        _anomaly("coordinates_swapped", "Lat|Long", "coalesce(lat, '') || ', ' || coalesce(lon, '')", f"{shown('lat_n')} || ', ' || {shown('lon_n')}", "geographic", "high", 0.99, "'Wspolrzedne wygladaja na zamienione miejscami Lat/Long.'", f"reg WHERE {_BOTH} AND {_SWAP}"),
        _correct("swap_lat", "Lat", _raw("lat"), shown("lon_n"), "regula logiczna", "0.99", "'lat/long swap'", "'Zamiana Lat na wartosc z pola Long.'", f"reg WHERE {_BOTH} AND {_SWAP}"),
        _correct("swap_lon", "Long", _raw("lon"), shown("lat_n"), "regula logiczna", "0.99", "'lat/long swap'", "'Zamiana Long na wartosc z pola Lat.'", f"reg WHERE {_BOTH} AND {_SWAP}"),
        _anomaly("latitude_outside", "Lat", _raw("lat"), shown("lat_n"), "geographic", "high", 1.0, "'Szerokosc geograficzna poza zakresem Polski 49-55.'", f"reg WHERE {_BOTH} AND NOT {_SWAP} AND lat_n NOT BETWEEN 49 AND 55"),
        _anomaly("longitude_outside", "Long", _raw("lon"), shown("lon_n"), "geographic", "high", 1.0, "'Dlugosc geograficzna poza zakresem Polski 14-24.'", f"reg WHERE {_BOTH} AND NOT {_SWAP} AND lon_n NOT BETWEEN 14 AND 24"),
    ],
    "missing_unit": [
        one for n in ("jednostka_psp", "kod_swd") for one in (
            _anomaly("missing_unit", _HEAD[n], _raw(n), "''", "administrative", "high", 1.0, f"'Brak wartosci w kolumnie {_HEAD[n]}.'", f"reg WHERE {_gap(n)}"),
            _dominant("missing_unit", _HEAD[n], n, _UNIT_MODES[n], "0.95", "dominujacej wartosci"),
        )
    ],
    "status_logic": [
        _anomaly("digital_without_gsm", "GSM", _raw("gsm"), _raw("st_gsm"), "logical", "medium", 0.75, "'Syrena cyfrowa bez potwierdzonego GSM.'", "reg WHERE kind = 'cyfrowa' AND coalesce(st_gsm, '') <> 'TAK'"),
        _anomaly("group_without_paths", "Wgr. sygn.|Sygn. OSP|Sygn. OL", _raw("wgr_sygn", "sygn_osp", "sygn_ol"), _raw("st_wgr_sygn", "st_sygn_osp", "st_sygn_ol"), "logical", "high", 0.95,
                 "'Wgr. sygn. = TAK, ale brak aktywnego Sygn. OSP i Sygn. OL.'", "reg WHERE st_wgr_sygn = 'TAK' AND coalesce(st_sygn_osp, '') <> 'TAK' AND coalesce(st_sygn_ol, '') <> 'TAK'"),
        _anomaly("osp_owner_without_signal", "Właściciel|Sygn. OSP", _raw("wlasciciel", "sygn_osp"), _raw("owner", "st_sygn_osp"), "logical", "medium", 0.7, "'Wlasciciel OSP, ale Sygn. OSP = NIE.'", "reg WHERE owner = 'osp' AND st_sygn_osp = 'NIE'"),
        _anomaly("no_control", "GSM|SK PSP", _raw("gsm", "sk_psp"), _raw("st_gsm", "st_sk_psp"), "logical", "low", 0.6,
                 "'Brak GSM i brak SK PSP - rekord do przegladu pod katem lacznosci lub analogowego sterowania.'", "reg WHERE coalesce(st_gsm, '') <> 'TAK' AND coalesce(st_sk_psp, '') <> 'TAK'"),
    ],
    "missing_status": [
        one for n, h in _STATUS_HEAD.items() for one in (
            _anomaly("missing_status", h, _raw(n), _raw(f"st_{n}"), "technical", "medium", 0.8, "'Brak wartosci logicznej wymagajacej standaryzacji lub uzupelnienia.'", f"reg WHERE {_gap(n)}"),
            _dominant("missing_status", h, n, _STATUS_MODES[n], "0.9", "dominujacego wzorca"),
        )
    ],
    "outliers": [_outlier("power_outlier", "moc_w", "power", "medium", 0.72, "Moc"), _outlier("height_outlier", "wysokosc", "height", "low", 0.68, "Wysokosc")],
}
RULE_SQL = {name: " UNION ALL ".join(parts) for name, parts in RULE_SQL.items()}
FIRED = REG + "fired AS (" + " UNION ALL ".join(RULE_SQL.values()) + ")"
FOUND = FIRED + ", an AS (SELECT DISTINCT nr_ref, category, severity, confidence, field, raw, value, reason FROM fired WHERE kind = 'anomaly')"
PROPOSED = "co AS (SELECT DISTINCT nr_ref, field, raw, value AS suggested, method, confidence, scope, reason FROM fired WHERE kind = 'correction')"
_IDS = dict(zip(RULE_SQL, "16 17 18 19 20 21 22 23 24 25 26 27".split(), strict=False))


def _reg(t):
    return A.prepare(t.fx_register)


def _gaps(t):
    return t.stage("audit-register", lambda: A.with_gaps(A.prepare(deal(t.fx_register))))


def _evidence(t):
    return t.stage("audit-evidence", lambda: deal(A.evidence(_gaps(t))))


def _fired(t):
    return t.stage("audit-fired", lambda: A.fired_rules(_evidence(t)))


def _anomalies(t):
    return t.stage("audit-anomalies", lambda: A.anomalies(_fired(t)))


def _corrections(t):
    return t.stage("audit-corrections", lambda: A.corrections(_fired(t)))


for _name in _IDS:
    query(f"q{_IDS[_name]}_rule_{_name}", REG + "one AS (SELECT 1) " + f"SELECT * FROM ({RULE_SQL[_name]})", "fx_register")(lambda t, rule=_name: A.fired_rules(_evidence(t), rule))

_TEXTS = ("wojewodztwo", "powiat", "gmina", "wlasciciel", "rodzaj_syreny", "jednostka_psp")
_COLUMNS = ["moc_w", "wysokosc", "lat", "lon", "kod_swd", "jednostka_psp", *A.STATUSES]


@query("q01_required_columns", f"SELECT nr_ref, {', '.join(_COLUMNS)} FROM fx_register", "fx_register")
def q01(t):
    return A.require_columns(t.fx_register, ["nr_ref", *_COLUMNS]).select("nr_ref", *_COLUMNS)


@query("q02_missing_counts", " UNION ALL ".join(f"SELECT '{n}' AS field, count(*) FILTER ({_nullish(n)}) AS missing, count(*) AS total FROM fx_register" for n in _COLUMNS), "fx_register")
def q02(t):
    return A.missing_counts(t.fx_register, _COLUMNS)


@query("q03_actionable_missing", REG + "one AS (SELECT 1) " + " UNION ALL ".join(f"SELECT '{n}' AS field, count(*) FILTER ({_gap(n)}) AS missing, count(*) AS total FROM reg" for n in _COLUMNS), "fx_register")
def q03(t):
    return A.missing_counts(_reg(t), _COLUMNS, A.actionable_missing)


@query("q04_duplicate_keys", "SELECT count(*) FILTER (c > 1) AS duplicate_rows, count(*) AS n FROM (SELECT count(*) OVER (PARTITION BY nr_ref) AS c FROM fx_register)", "fx_register")
def q04(t):
    return A.repeated_flag(t.fx_register.select("nr_ref"), F.col("nr_ref"), "d").agg(F.count_if("d").alias("duplicate_rows"), F.count(F.lit(1)).alias("n"))


@query("q05_frequencies", "SELECT rodzaj_syreny, wlasciciel, count(*) AS n FROM (SELECT nullif(rodzaj_syreny, '') AS rodzaj_syreny, wlasciciel FROM fx_register) GROUP BY ALL", "fx_register")
def q05(t):
    return A.frequency(t.fx_register.withColumn("rodzaj_syreny", F.nullif("rodzaj_syreny", F.lit(""))), "rodzaj_syreny", "wlasciciel")


@query("q06_crosstab", REG + "one AS (SELECT 1) SELECT kind, count(*) FILTER (s = 'TAK') AS TAK, count(*) FILTER (s = 'NIE') AS NIE, count(*) FILTER (s = 'BRAK') AS BRAK FROM (SELECT kind, coalesce(st_gsm, 'BRAK') AS s FROM reg) GROUP BY kind", "fx_register")
def q06(t):
    wide = _reg(t).withColumn("s", F.coalesce("st_gsm", F.lit("BRAK"))).groupBy("kind").pivot("s", ["TAK", "NIE", "BRAK"]).count()
    return wide.na.fill(0)


_PROFILE = ["kind", "st_gsm", "st_sk_psp", "st_sygn_osp", "st_sygn_ol", "st_wgr_sygn", "wojewodztwo"]


@query(
    "q07_typical_profiles",
    REG + f"p AS (SELECT {', '.join(_PROFILE)}, count(*) AS n, round_even(count(*) * 100 / (SELECT count(*) FROM reg), 2) AS share FROM reg GROUP BY ALL) "
    f"SELECT * FROM p WHERE n >= 4 ORDER BY n DESC, {', '.join(f'{c} NULLS FIRST' for c in _PROFILE)} LIMIT 20",
    "fx_register",
)
def q07(t):
    return A.profiles(_reg(t), _PROFILE, least=4)


@query("q08_pearson", "SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r, count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 1 AND 45 GROUP BY ALL")
def q08(t):
    rows = t.lineitem.where("l_quantity between 1 and 45")
    return rows.groupBy("l_returnflag").agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"), F.count(F.lit(1)).alias("n"))


@query(
    "q09_spearman",
    """r AS (SELECT (rank() OVER (ORDER BY l_quantity) + rank() OVER (ORDER BY l_quantity) + count(*) OVER (PARTITION BY l_quantity) - 1) / 2 AS a,
      (rank() OVER (ORDER BY l_extendedprice) * 2 + count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2 AS b FROM lineitem)
    SELECT round(corr(a, b), 6) AS rho, count(*) AS n FROM r""",
)
def q09(t):
    return A.spearman(t.lineitem, "l_quantity", "l_extendedprice").withColumn("rho", F.round("rho", 6))


@query("q10_mode_lookup", REG + f"one AS (SELECT 1) SELECT woj_key, pow_key, v AS value, n AS support, share FROM {_mode('woj_key, pow_key', 'kod_swd')}", "fx_register")
def q10(t):
    return A.mode_lookup(_reg(t), ["woj_key", "pow_key"], "kod_swd")


@query("q11_mean_lookup", "SELECT l_returnflag, l_linestatus, round(avg(l_extendedprice), 4) AS mean, count(*) AS support FROM lineitem WHERE l_quantity > 10 GROUP BY ALL HAVING count(*) >= 3")
def q11(t):
    return A.mean_lookup(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", F.col("l_quantity") > 10).withColumn("mean", F.round("mean", 4))


@query("q12_scope_fallback", REG + f"one AS (SELECT 1) SELECT lp, m FROM {_near('power')}", "fx_register")
def q12(t):
    return A.local_mean(_reg(t), "power", "power_ok", "near").select("lp", F.col("near_mean").alias("m"))


@query("q13_median_mad", REG + f"one AS (SELECT 1) SELECT woj_key, kind, med, mad, n AS support FROM {_mad('woj_key, kind', 'power')}", "fx_register")
def q13(t):
    return A.mad_stats(_reg(t).where("power_ok"), ["woj_key", "kind"], "power").select("woj_key", "kind", F.col("median").alias("med"), "mad", "support")


@query("q14_outliers", REG + "one AS (SELECT 1) " + f"SELECT lp, nr_ref, rule, raw, reason FROM ({RULE_SQL['outliers']})", "fx_register")
def q14(t):
    return A.fired_rules(_evidence(t), "outliers").select("lp", "nr_ref", "rule", "raw", "reason")


@query("q15_global_means", REG + f"one AS (SELECT 1) SELECT ga AS analogue_power, gh AS height, gha AS height_analogue, ghd AS height_digital FROM {GLOBAL}", "fx_register")
def q15(t):
    return A.global_means(_reg(t))


@query("q28_anomalies", FOUND + " SELECT *, CASE severity WHEN 'high' THEN 1 WHEN 'medium' THEN 2 ELSE 3 END::BIGINT AS severity_rank FROM an", "fx_register")
def q28(t):
    return _anomalies(t)


@query("q29_corrections", FIRED + f", {PROPOSED} SELECT * FROM co", "fx_register")
def q29(t):
    return _corrections(t)


_ALL_COLUMNS = list(A.HEADERS)
_RAW_MISSING = " + ".join(f"{_nullish(n)}::BIGINT" for n in _ALL_COLUMNS)
_ACTIONABLE = " + ".join(f"{_gap(n)}::BIGINT" for n in _ALL_COLUMNS)


@query(
    "q30_audit_summary",
    FOUND + f""", {PROPOSED},
      r AS (SELECT count(*) AS n, sum({_RAW_MISSING}) AS raw, sum({_ACTIONABLE}) AS act FROM reg),
      a AS (SELECT count(*) AS n, count(DISTINCT nr_ref) AS k FROM an), c AS (SELECT count(*) AS n, count(DISTINCT nr_ref) AS k, count(*) FILTER (confidence < 0.5) AS low FROM co),
      v AS (SELECT unnest([
        {{'section': 'size', 'name': 'records', 'value': r.n::DOUBLE}}, {{'section': 'size', 'name': 'columns', 'value': 19::DOUBLE}},
        {{'section': 'missing', 'name': 'raw_total', 'value': raw::DOUBLE}}, {{'section': 'missing', 'name': 'raw_pct_cells', 'value': round_even(raw * 100 / (r.n * 19), 2)::DOUBLE}},
        {{'section': 'missing', 'name': 'actionable_total', 'value': act::DOUBLE}}, {{'section': 'missing', 'name': 'actionable_pct_cells', 'value': round_even(act * 100 / (r.n * 19), 2)::DOUBLE}},
        {{'section': 'anomalies', 'name': 'total_entries', 'value': a.n::DOUBLE}}, {{'section': 'anomalies', 'name': 'records_with_anomalies', 'value': a.k::DOUBLE}},
        {{'section': 'anomalies', 'name': 'records_with_anomalies_pct', 'value': round_even(a.k * 100 / r.n, 2)::DOUBLE}},
        {{'section': 'anomalies', 'name': 'entries_pct_cells', 'value': round_even(a.n * 100 / (r.n * 19), 2)::DOUBLE}},
        {{'section': 'corrections', 'name': 'total_entries', 'value': c.n::DOUBLE}}, {{'section': 'corrections', 'name': 'records_with_corrections', 'value': c.k::DOUBLE}},
        {{'section': 'corrections', 'name': 'records_with_corrections_pct', 'value': round_even(c.k * 100 / r.n, 2)::DOUBLE}},
        {{'section': 'corrections', 'name': 'low_confidence_count', 'value': c.low::DOUBLE}}]) AS e FROM r, a, c)
      SELECT e.section AS section, e.name AS name, e.value AS value FROM v
      UNION ALL SELECT 'anomalies by category', category, count(*)::DOUBLE FROM an GROUP BY ALL
      UNION ALL SELECT 'anomalies by severity', severity, count(*)::DOUBLE FROM an GROUP BY ALL
      UNION ALL SELECT * FROM (SELECT 'anomalies by reason', reason, count(*)::DOUBLE AS k FROM an GROUP BY ALL ORDER BY k DESC, reason LIMIT 10)
      UNION ALL SELECT 'corrections by method', method, count(*)::DOUBLE FROM co GROUP BY ALL""",
    "fx_register",
)
def q30(t):
    return A.audit_summary(_gaps(t), _anomalies(t), _corrections(t))


_COUNTED = ["anomaly_count", "anomaly_high_count", "anomaly_medium_count", "anomaly_low_count"]
_HAS = [f"has_{n}_anomaly" for n in ("logical", "technical", "geographic", "relational")]
FLAGS = (
    FOUND
    + """, fl AS (SELECT nr_ref, count(*) AS anomaly_count, """
    + ", ".join(f"count(*) FILTER (severity = '{s}') AS anomaly_{s}_count" for s in ("high", "medium", "low"))
    + ", "
    + ", ".join(f"max((category = '{n}')::BIGINT) AS has_{n}_anomaly" for n in ("logical", "technical", "geographic", "relational"))
    + ", CASE WHEN bool_or(severity = 'high') THEN 'high' WHEN bool_or(severity = 'medium') THEN 'medium' ELSE 'low' END AS max_anomaly_severity, 'REVIEW' AS record_status FROM an GROUP BY nr_ref)"
)


def _normal(t):
    return A.normalise(_reg(t), A.quality_flags(_anomalies(t)))


@query("q31_quality_flags", FLAGS + " SELECT * FROM fl", "fx_register")
def q31(t):
    return A.quality_flags(_anomalies(t))


def _text(n: str) -> str:
    return f"trim(regexp_replace(coalesce({n}, ''), '{WS}', ' ', 'g'))"


def _zero(x: str) -> str:
    return f"coalesce(nullif({x}, ''), '0')"


def _plain(n: str) -> str:
    """A number in which a comma may stand for the point, but no blank may stand."""
    return NUMBER.replace("{0}", f"replace({_text(n)}, ',', '.')")


NORMAL = (
    FLAGS
    + f""", nm AS (SELECT r.lp, {_zero(_text("r.nr_ref"))} AS nr_ref,
  {_zero(f"strftime(coalesce(try_strptime(trim(data), '%d.%m.%Y'), try_strptime(trim(data), '%d/%m/%Y'), try_strptime(trim(data), '%d-%m-%Y'), try_strptime(trim(data), '%Y-%m-%d')), '%Y-%m-%d')")} AS data_iso,
  {", ".join(f"{_zero(_text(n))} AS {n}, {_zero(slug(n))} AS {n}_key" for n in _TEXTS)}, {_zero(_text("kod_swd"))} AS kod_swd,
  coalesce(round_even({_plain("r.moc_w")}, 0)::BIGINT, 0) AS moc_w, coalesce({_plain("r.wysokosc")}, 0) AS wysokosc_nad_terenem_m, coalesce({_plain("r.lat")}, 0) AS lat, coalesce({_plain("r.lon")}, 0) AS lon,
  {", ".join(f"{_zero(f'upper({_text(s)})')} AS {s}_status, coalesce({flag(s)}, 0) AS {s}_flag" for s in A.STATUSES)},
  {", ".join(f"coalesce({n}, 0) AS {n}" for n in _COUNTED + _HAS)},
  coalesce(max_anomaly_severity, '0') AS max_anomaly_severity, coalesce(record_status, 'OK') AS record_status, (record_status IS NULL)::BIGINT AS is_clean_record
  FROM reg r LEFT JOIN fl ON fl.nr_ref = {_text("r.nr_ref")})"""
)


@query("q32_normalised_register", NORMAL + " SELECT * FROM nm", "fx_register")
def q32(t):
    return _normal(t)


@query(
    "q33_quality_table",
    REG
    + f"""o AS (SELECT 'owners' AS category, {_clean("wlasciciel")} AS metric, count(*) AS value FROM reg GROUP BY ALL ORDER BY value DESC, metric LIMIT 12)
    SELECT 'V9' AS category, 'records' AS metric, count(*) AS value FROM reg UNION ALL SELECT 'V9', 'columns', 41 UNION ALL SELECT 'V9', 'analog_records', count(*) FILTER (kind = 'analogowa') FROM reg
    UNION ALL SELECT 'quality', 'raw_missing_total', sum({_RAW_MISSING})::BIGINT FROM reg UNION ALL SELECT 'quality', 'actionable_missing_total', sum({_ACTIONABLE})::BIGINT FROM reg
    UNION ALL SELECT 'quality', 'duplicate_nr_ref', coalesce(sum(c), 0)::BIGINT FROM (SELECT count(*) AS c FROM reg GROUP BY {_clean("nr_ref")} HAVING count(*) > 1) UNION ALL SELECT * FROM o""",
    "fx_register",
)
def q33(t):
    return A.quality_table(_gaps(t), len(_normal(t).columns))
