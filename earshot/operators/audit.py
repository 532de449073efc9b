"""Register quality audit: lookups, rules, anomaly and correction tables.

The register is read twice: once for counts of values per county and kind, from
which every lookup (dominant values, means, medians, deviations) is summed up at
its scope, and once with those lookups joined on (``evidence``). Each rule then
is a list of row expressions that are an anomaly, a correction or null, and all
rules are unpacked in one pass.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import scalars as S
from earshot.operators.quantiles import grouped
from earshot.operators.ranks import running
from earshot.sources.storage import materialize

# fixed values
ANALOGUE_POWER, DIGITAL_POWER = (2000, 5000), (300, 5000)
HEIGHT, REVIEW_HEIGHT, SEA_LEVEL = (3, 60), (61, 99), 100
LAT, LON = (49, 55), (14, 24)
MODE_SUPPORT, MODE_SHARE, MEAN_SUPPORT, MAD_SUPPORT, MAD_Z = 5, 0.8, 3, 10, 2.5
SEVERITIES = ["high", "medium", "low", "info"]
STATUSES = ["gsm", "sk_psp", "sygn_osp", "sygn_ol", "wgr_sygn"]
SIGNALS = ["sygn_osp", "sygn_ol", "wgr_sygn"]
NUMBERS = ["moc_w", "wysokosc", "lat", "lon"]
HEADERS = {
    "lp": "Lp.",
    "nr_ref": "Nr ref.",
    "data": "Data",
    "wojewodztwo": "Województwo",
    "powiat": "Powiat",
    "gmina": "Gmina",
    "wlasciciel": "Właściciel",
    "rodzaj_syreny": "Rodzaj syreny",
    "moc_w": "Moc [W]",
    "wysokosc": "Wysokość nad terenem [m]",
    "gsm": "GSM",
    "sk_psp": "SK PSP",
    "sygn_osp": "Sygn. OSP",
    "sygn_ol": "Sygn. OL",
    "wgr_sygn": "Wgr. sygn.",
    "lat": "Lat",
    "lon": "Long",
    "jednostka_psp": "Jednostka PSP",
    "kod_swd": "Kod SWD",
}
#: Category, severity, confidence and reason of each anomaly.
ANOMALIES = {
    "duplicate_id": ("administrative", "high", 1.0, "Duplikat identyfikatora {}."),
    "parse_error": ("technical", "high", 1.0, "Nie udalo sie sparsowac wartosci liczbowej."),
    "missing_power": ("technical", "high", 1.0, "Brak mocy syreny."),
    "missing_height": ("technical", "high", 1.0, "Brak wysokosci montazu syreny."),
    "analogue_power": ("technical", "high", 1.0, "Moc syreny analogowej poza dopuszczalnym zakresem 2000-5000 W."),
    "digital_power": ("technical", "medium", 0.75, "Moc syreny cyfrowej poza typowym zakresem 300-5000 W."),
    "height_sea_level": ("technical", "high", 0.98, "Prawdopodobnie wpisano wysokosc npm zamiast wysokosci montazu nad terenem."),
    "height_review": ("technical", "medium", 0.55, "Wysokosc montazu w zakresie 61-99 m wymaga przegladu."),
    "height_low": ("technical", "high", 0.95, "Wysokosc montazu ponizej typowego minimum 3 m."),
    "coordinates_missing": ("geographic", "high", 1.0, "Brak wspolrzednych geograficznych."),
    "coordinates_swapped": ("geographic", "high", 0.99, "Wspolrzedne wygladaja na zamienione miejscami Lat/Long."),
    "latitude_outside": ("geographic", "high", 1.0, "Szerokosc geograficzna poza zakresem Polski 49-55."),
    "longitude_outside": ("geographic", "high", 1.0, "Dlugosc geograficzna poza zakresem Polski 14-24."),
    "missing_unit": ("administrative", "high", 1.0, "Brak wartosci w kolumnie {}."),
    "digital_without_gsm": ("logical", "medium", 0.75, "Syrena cyfrowa bez potwierdzonego GSM."),
    "group_without_paths": ("logical", "high", 0.95, "Wgr. sygn. = TAK, ale brak aktywnego Sygn. OSP i Sygn. OL."),
    "osp_owner_without_signal": ("logical", "medium", 0.7, "Wlasciciel OSP, ale Sygn. OSP = NIE."),
    "no_control": ("logical", "low", 0.6, "Brak GSM i brak SK PSP - rekord do przegladu pod katem lacznosci lub analogowego sterowania."),
    "missing_status": ("technical", "medium", 0.8, "Brak wartosci logicznej wymagajacej standaryzacji lub uzupelnienia."),
    "power_outlier": ("relational", "medium", 0.72, "Moc odbiega od mediany grupy ({}, n={}) o wiecej niz 2.5 MAD."),
    "height_outlier": ("relational", "low", 0.68, "Wysokosc odbiega od mediany grupy ({}, n={}) o wiecej niz 2.5 MAD."),
}
#: Method and reason of each correction.
CORRECTIONS = {
    "status_form": ("standaryzacja TAK/NIE/N/D", "Ujednolicenie wariantu zapisu wartosci logicznej."),
    "missing_power": ("srednia lokalna", "Uzupelnienie brakujacej mocy na podstawie sredniej lokalnej dla rodzaju syreny."),
    "missing_height": ("srednia lokalna", "Uzupelnienie brakujacej wysokosci na podstawie sredniej lokalnej dla rodzaju syreny."),
    "analogue_power": ("srednia analogowych", "Korekta na podstawie sredniej innych poprawnych syren analogowych."),
    "digital_power": ("srednia lokalna", "Niska pewnosc: korekta cyfrowej mocy do sredniej lokalnej dla rodzaju syreny."),
    "height_sea_level": ("srednia montazu nad terenem", "Korekta na podstawie sredniej poprawnych wysokosci montazu nad terenem."),
    "swap_lat": ("regula logiczna", "Zamiana Lat na wartosc z pola Long."),
    "swap_lon": ("regula logiczna", "Zamiana Long na wartosc z pola Lat."),
    "missing_unit": ("dominanta lokalna", "Uzupelnienie na podstawie dominujacej wartosci w grupie ({} rekordow)."),
    "missing_status": ("dominanta lokalna", "Uzupelnienie na podstawie dominujacego wzorca w grupie ({} rekordow)."),
}

COUNTY, PROVINCE, AREA = ["woj_key", "pow_key", "kind"], ["woj_key", "kind"], ["woj_key", "pow_key"]
SCOPE_NAMES = {"county": "powiat+rodzaj", "province": "wojewodztwo+rodzaj", "kind_stats": "rodzaj", "area": "wojewodztwo+powiat"}


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` itself; raises at once where a required column is missing."""
    if missing := [n for n in names if n not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def _key(c: Column) -> Column:
    return F.nullif(S.label_key(c), F.lit(""))


def prepare(register: DataFrame) -> DataFrame:
    """The register with keys (null where blank), parsed numbers, normalised statuses and validity flags."""
    c = F.col
    df = register.withColumns(
        {
            "woj_key": _key(c("wojewodztwo")),
            "pow_key": _key(c("powiat")),
            "owner": _key(c("wlasciciel")),
            "kind": _key(c("rodzaj_syreny")),
            "power": S.parse_number(c("moc_w")),
            "height": S.parse_number(c("wysokosc")),
            "lat_n": S.parse_number(c("lat")),
            "lon_n": S.parse_number(c("lon")),
            **{f"st_{s}": S.yes_no_nd(c(s)) for s in STATUSES},
        }
    )
    power = F.when(c("kind").eqNullSafe("analogowa"), c("power").between(*ANALOGUE_POWER)).otherwise(c("power").between(*DIGITAL_POWER))
    return df.withColumns({"power_ok": F.coalesce(power, F.lit(False)), "height_ok": F.coalesce(c("height").between(*HEIGHT), F.lit(False))})


def with_gaps(df: DataFrame) -> DataFrame:
    """The prepared register with ``gap_*`` of each column (whether a value is to be filled in) and ``raw_gaps``, the number of blank or N/D cells."""
    raw = reduce(Column.__add__, (S.is_null_like(F.col(n).cast("string")).cast("int") for n in HEADERS))
    return df.withColumns({**{f"gap_{n}": actionable_missing(n) for n in HEADERS}, "raw_gaps": raw})


def missing_counts(df: DataFrame, columns: list[str], missing=None) -> DataFrame:
    """(field, missing, total) in one pass; ``missing`` may give a predicate per column."""
    test = missing or (lambda name: S.is_null_like(F.col(name)))
    one = df.agg(F.count(F.lit(1)).alias("total"), *(F.count_if(test(n)).alias(n) for n in columns))
    return one.unpivot(["total"], columns, "field", "missing").select("field", "missing", "total")


def actionable_missing(name: str) -> Column:
    """Blank, a null token or N/D; N/D in a signal column of an analogue unit is an answer."""
    if name not in SIGNALS:
        return S.is_null_like(F.col(name).cast("string"))
    return S.is_null_token(F.col(name)) | S.is_nd(F.col(name)) & ~F.col("kind").eqNullSafe("analogowa")


def repeated_flag(df: DataFrame, key: Column, name: str) -> DataFrame:
    """``df`` with ``name``: whether other rows have the row's key, too; null is a key like any other. Only keys that
    are repeated are joined, and nulls, which may be a third of all rows, not even those: their count is one row."""
    keyed = df.withColumn("__key", key)
    counts = keyed.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    again = counts.where("__key is not null").select("__key", F.lit(True).alias("__again"))
    blanks = counts.where("__key is null").agg((F.count(F.lit(1)) > 0).alias("__blanks"))
    out = keyed.join(again, "__key", "left").join(F.broadcast(blanks), F.lit(True))
    return out.withColumn(name, F.when(F.col("__key").isNull(), F.col("__blanks")).otherwise(F.coalesce("__again", F.lit(False)))).drop("__key", "__again", "__blanks")


def frequency(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def profiles(df: DataFrame, columns: list[str], least: int = 50, top: int = 20) -> DataFrame:
    """The most frequent attribute combinations with their share of all rows."""
    counts = frequency(df, *columns)
    total = counts.agg(F.sum("n").alias("total"))
    share = F.bround(F.col("n") * 100 / F.col("total"), 2)
    kept = counts.join(total, F.lit(True)).where(F.col("n") >= least).withColumn("share", share).drop("total")
    return kept.orderBy(F.desc("n"), *columns).limit(top)


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation with average ranks on ties. Ranks come from counts per
    distinct value, summed up over blocks of the value range."""
    rows = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b)

    def ranks(column: str) -> DataFrame:
        counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        summed = running(counts, [F.col(column)], "n", "upto")
        return summed.select(column, (F.col("upto") - F.col("n") + (F.col("n") + 1) / 2).alias(f"rank_{column}"))

    return rows.join(ranks(a), a).join(ranks(b), b).agg(F.corr(f"rank_{a}", f"rank_{b}").alias("rho"), F.count(F.lit(1)).alias("n"))


def _dominant(counts: DataFrame, keys: list[str], support: int, share: float) -> DataFrame:
    """(keys, value, support, share) of the most frequent value, ties by value; ``counts`` has keys, value, n."""
    best = counts.groupBy(*keys).agg(F.sum("n").alias("all"), F.min(F.struct((-F.col("n")).alias("neg"), "value")).alias("best"))
    out = best.select(*keys, "best.value", (-F.col("best.neg")).alias("support"), (-F.col("best.neg") / F.col("all")).alias("share"))
    return out.where((F.col("support") >= support) & (F.col("share") >= share))


def mode_lookup(df: DataFrame, keys: list[str], value: str, support: int = MODE_SUPPORT, share: float = MODE_SHARE) -> DataFrame:
    """(keys, value, support, share): the dominant value of a group; ``support`` counts that value's rows."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return _dominant(counts, keys, support, share)


def mean_lookup(df: DataFrame, keys: list[str], value: str, valid: Column, support: int = MEAN_SUPPORT) -> DataFrame:
    return df.where(valid).groupBy(*keys).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("support")).where(F.col("support") >= support)


def mad_stats(df: DataFrame, keys: list[str], value: str, support: int = MAD_SUPPORT) -> DataFrame:
    """(keys, median, mad, support) per group, from counts per distinct value."""
    named = [f"__{k}" for k in keys]
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))  # a blank key is a group too
    aside = lambda table: table.withColumnsRenamed(dict(zip(keys, named, strict=True)))
    counts = materialize(df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n")), "mad-counts")
    large = counts.groupBy(*keys).agg(F.sum("n").alias("support")).where(F.col("support") >= support)
    medians = large.join(aside(grouped(counts, keys, "v", "n", 0.5, "median")), same).drop(*named)
    away = counts.join(aside(medians), same).select(*keys, F.abs(F.col("v") - F.col("median")).alias("away"), "n")
    mads = grouped(away.groupBy(*keys, "away").agg(F.sum("n").alias("n")), keys, "away", "n", 0.5, "mad")
    return medians.join(aside(mads), same).select(*keys, "median", "support", "mad")


def first_hit(df: DataFrame, lookups: list[tuple[list[str], DataFrame]], fields: list[str], prefix: str) -> DataFrame:
    """Adds ``prefix``_field from the first lookup that has the row's group."""
    for i, (keys, lookup) in enumerate(lookups):
        df = df.join(lookup.select(*keys, F.struct(*fields).alias(f"__{i}")), keys, "left")
    hit = F.coalesce(*(F.col(f"__{i}") for i in range(len(lookups))))
    df = df.withColumns({f"{prefix}_{f}": hit[f] for f in fields})
    return df.drop(*(f"__{i}" for i in range(len(lookups))))


def local_mean(df: DataFrame, value: str, valid: str, prefix: str) -> DataFrame:
    return first_hit(df, [(k, mean_lookup(df, k, value, F.col(valid))) for k in (COUNTY, PROVINCE)], ["mean", "support"], prefix)


def outliers(df: DataFrame, value: str, valid: str, z: float = MAD_Z) -> DataFrame:
    """Valid values that lie more than ``z`` MADs from the median of the valid values of their group."""
    lookups = [(k, mad_stats(df.where(valid), k, value)) for k in (COUNTY, PROVINCE, ["kind"])]
    rows = first_hit(df.where(valid), lookups, ["median", "mad", "support"], "stat")
    return rows.where((F.col("stat_mad") > 0) & (F.abs(F.col(value) - F.col("stat_median")) / F.col("stat_mad") > z))


def global_means(df: DataFrame) -> DataFrame:
    """One row: mean analogue power, mean height, and mean height per kind as a map."""
    analogue = F.avg(F.when((F.col("kind") == "analogowa") & F.col("power_ok"), F.col("power"))).alias("analogue_power")
    return df.agg(
        analogue,
        F.avg(F.when(F.col("height_ok"), F.col("height"))).alias("height"),
        F.avg(F.when(F.col("height_ok") & (F.col("kind") == "analogowa"), F.col("height"))).alias("height_analogue"),
        F.avg(F.when(F.col("height_ok") & (F.col("kind") == "cyfrowa"), F.col("height"))).alias("height_digital"),
    )


def _metric_lookup(values: DataFrame, keys: list[str], scope: str) -> DataFrame:
    """(keys, scope): struct with means, medians and MADs of power and height, from counts per value."""
    known = values.where(reduce(Column.__and__, (F.col(k).isNotNull() for k in keys)))
    counts = known.groupBy(*keys, "metric", "v").agg(F.sum("n").alias("n"))
    both = [*keys, "metric"]
    sums = counts.groupBy(*both).agg(F.sum("n").alias("count"), F.sum(F.col("v") * F.col("n")).alias("sum"))
    medians = grouped(counts, both, "v", "n", 0.5, "median")
    away = counts.join(medians, both).groupBy(*both, F.abs(F.col("v") - F.col("median")).alias("away")).agg(F.sum("n").alias("n"))
    mads = grouped(away, both, "away", "n", 0.5, "mad")
    rows = sums.join(medians, both).join(mads, both)
    name = F.lit(SCOPE_NAMES[scope]).alias("scope")
    mean = F.when(F.col("count") >= MEAN_SUPPORT, F.struct((F.col("sum") / F.col("count")).alias("value"), name))
    stat = F.when(F.col("count") >= MAD_SUPPORT, F.struct("median", "mad", F.col("count").alias("n"), name))
    of = lambda m, c: F.max(F.when(F.col("metric") == m, c))
    parts = [of(m, c).alias(f"{m}_{kind}") for m in ("power", "height") for kind, c in (("mean", mean), ("stat", stat))]
    return rows.groupBy(*keys).agg(F.struct(*parts).alias(scope))


def _mode_lookup_of_all(texts: DataFrame, keys: list[str], fields: list[str], scope: str) -> DataFrame:
    """(keys, scope): struct with the dominant value of each of ``fields``, from counts per value."""
    counts = texts.where(F.col("field").isin(fields)).groupBy(*keys, "field", "value").agg(F.sum("n").alias("n"))
    best = _dominant(counts, [*keys, "field"], MODE_SUPPORT, MODE_SHARE)
    hit = F.struct("value", "share", F.col("support").alias("n"), F.lit(SCOPE_NAMES[scope.removesuffix("_mode")]).alias("scope"))
    one = best.groupBy(*keys).agg(*(F.max(F.when(F.col("field") == f, hit)).alias(f) for f in fields))
    return one.select(*keys, F.struct(*fields).alias(scope))


def evidence(df: DataFrame) -> DataFrame:
    """The prepared register (``with_gaps``) with all that the rules look at: ``mean_*`` and ``stat_*`` of power and
    height and ``mode_*`` of statuses and units (first scope that has enough rows), global means and
    duplicate flags. Blank keys belong to no group."""
    unit_fields = ["jednostka_psp", "kod_swd"]
    metric = F.explode(
        F.array(
            F.struct(F.lit("power").alias("metric"), F.when(F.col("power_ok"), F.col("power")).alias("v")),
            F.struct(F.lit("height").alias("metric"), F.when(F.col("height_ok"), F.col("height")).alias("v")),
        )
    )
    # every lookup is summed up from these two tables of counts
    values = df.select(*COUNTY, metric.alias("e")).where("e.v is not null").groupBy(*COUNTY, "e.metric", "e.v").agg(F.count(F.lit(1)).alias("n"))
    values = materialize(values, "audit-values")
    text = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(c).alias("value")) for f, c in [*((s, f"st_{s}") for s in STATUSES), *((u, u) for u in unit_fields)])))
    texts = df.select(*COUNTY, text.alias("e")).where("e.value is not null").groupBy(*COUNTY, "e.field", "e.value").agg(F.count(F.lit(1)).alias("n"))
    texts = materialize(texts, "audit-texts")
    means = values.agg(
        F.expr("sum(v * n) filter (where metric = 'power' and kind = 'analogowa') / sum(n) filter (where metric = 'power' and kind = 'analogowa')").alias("analogue_mean"),
        F.expr("sum(v * n) filter (where metric = 'height') / sum(n) filter (where metric = 'height')").alias("height_mean"),
    )
    by_kind = values.where("metric = 'height' and kind is not null").groupBy("kind").agg((F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("kind_height_mean"))
    out = df
    for key in ("lp", "nr_ref"):
        out = repeated_flag(out, S.clean_or_null(F.col(key).cast("string")), f"twice_{key}")
    for keys, scope in ((COUNTY, "county"), (PROVINCE, "province"), (["kind"], "kind_stats")):
        out = out.join(_metric_lookup(values, keys, scope), keys, "left")
    for keys, fields, scope in ((COUNTY, STATUSES, "county_mode"), (PROVINCE, STATUSES, "province_mode"), (AREA, unit_fields, "area_mode")):
        out = out.join(_mode_lookup_of_all(texts, keys, fields, scope), keys, "left")
    out = out.join(by_kind, "kind", "left").join(F.broadcast(means), F.lit(True))
    return out.withColumns(
        {
            **{f"mean_{m}": F.coalesce(F.col(f"county.{m}_mean"), F.col(f"province.{m}_mean")) for m in ("power", "height")},
            **{f"stat_{m}": F.coalesce(F.col(f"county.{m}_stat"), F.col(f"province.{m}_stat"), F.col(f"kind_stats.{m}_stat")) for m in ("power", "height")},
            **{f"mode_{s}": F.coalesce(F.col(f"county_mode.{s}"), F.col(f"province_mode.{s}")) for s in STATUSES},
            **{f"mode_{u}": F.col(f"area_mode.{u}") for u in unit_fields},
        }
    ).drop("county", "province", "kind_stats", "county_mode", "province_mode", "area_mode")


def _lit(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _shown(*names: str) -> Column:
    """Raw or normalised texts side by side, null as ''."""
    return F.concat_ws(" / ", *(F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names))


def _fields(*names: str) -> str:
    return "|".join(HEADERS[n] for n in names)


def _row(kind: str, rule: str, field, raw, value, category, severity, confidence, method, scope, reason) -> Column:
    parts = {
        "kind": kind, "rule": rule, "field": field, "raw": raw, "value": value, "category": category, "severity": severity,
        "confidence": F.bround(_lit(confidence).cast("double"), 2), "method": method, "scope": scope, "reason": reason,
    }
    return F.struct(*((c if k == "confidence" else _lit(c).cast("string")).alias(k) for k, c in parts.items()))


def _anomaly(when: Column, rule: str, field, raw: Column, value: Column | str = "", reason: Column | str | None = None) -> Column:
    category, severity, confidence, text = ANOMALIES[rule]
    row = _row("anomaly", rule, field, raw, value, category, severity, confidence, None, None, text if reason is None else reason)
    return F.when(F.coalesce(when, F.lit(False)), row)


def _correction(when: Column, rule: str, field: str, raw: Column, value: Column, confidence, scope, reason: Column | None = None) -> Column:
    method, text = CORRECTIONS[rule]
    row = _row("correction", rule, field, raw, value, None, None, confidence, method, scope, text if reason is None else reason)
    return F.when(F.coalesce(when, F.lit(False)), row)


def rule_duplicates() -> list[Column]:
    texts = {n: F.col(n).cast("string") for n in ("lp", "nr_ref")}
    return [
        _anomaly(F.col(f"twice_{n}"), "duplicate_id", HEADERS[n], _shown(n), F.coalesce(S.clean_or_null(c), F.lit("")), ANOMALIES["duplicate_id"][3].format(HEADERS[n].removesuffix(".")))
        for n, c in texts.items()
    ]


def rule_status_form() -> list[Column]:
    differs = lambda s: S.clean_or_null(F.col(s)).isNotNull() & (S.clean_or_null(F.col(s)) != F.col(f"st_{s}"))
    return [_correction(differs(s), "status_form", HEADERS[s], _shown(s), F.col(f"st_{s}"), 1.0, "regula logiczna") for s in STATUSES]


def rule_parse_errors() -> list[Column]:
    return [_anomaly(S.parse_failed(F.col(n)), "parse_error", HEADERS[n], _shown(n)) for n in NUMBERS]


def _missing_number(rule: str, name: str, number: str, step: float) -> list[Column]:
    none, mean = F.col(number).isNull() & F.col(f"gap_{name}"), F.col(f"mean_{number}")
    value = S.display_value(S.round_step(mean["value"], step))
    return [
        _anomaly(none, rule, HEADERS[name], _shown(name)),
        _correction(none & mean.isNotNull(), rule, HEADERS[name], _shown(name), value, 0.55, mean["scope"]),
    ]


def rule_missing_power() -> list[Column]:
    return _missing_number("missing_power", "moc_w", "power", 100.0)


def rule_missing_height() -> list[Column]:
    return _missing_number("missing_height", "wysokosc", "height", 0.5)


def rule_analogue_power() -> list[Column]:
    out = F.col("kind").eqNullSafe("analogowa") & ~F.col("power").between(*ANALOGUE_POWER)
    mean = F.col("analogue_mean")
    return [
        _anomaly(out, "analogue_power", HEADERS["moc_w"], _shown("moc_w"), S.display_value(F.col("power"))),
        _correction(out & mean.isNotNull(), "analogue_power", HEADERS["moc_w"], _shown("moc_w"), S.display_value(S.round_step(mean, 100.0)), 0.9, "global analogowa"),
    ]


def rule_digital_power() -> list[Column]:
    out = ~F.col("kind").eqNullSafe("analogowa") & ~F.col("power").between(*DIGITAL_POWER)
    mean = F.col("mean_power")
    return [
        _anomaly(out, "digital_power", HEADERS["moc_w"], _shown("moc_w"), S.display_value(F.col("power"))),
        _correction(out & mean.isNotNull(), "digital_power", HEADERS["moc_w"], _shown("moc_w"), S.display_value(S.round_step(mean["value"], 100.0)), 0.45, mean["scope"]),
    ]


def rule_height_range() -> list[Column]:
    h, name, shown = F.col("height"), HEADERS["wysokosc"], S.display_value(F.col("height"))
    own = F.col("kind_height_mean")
    mean = F.coalesce(own, F.col("height_mean"))
    scope = F.when(own.isNotNull(), F.concat(F.lit("rodzaj="), F.col("kind"))).otherwise("global wszystkie rodzaje")
    return [
        _anomaly(h >= SEA_LEVEL, "height_sea_level", name, _shown("wysokosc"), shown),
        _correction((h >= SEA_LEVEL) & mean.isNotNull(), "height_sea_level", name, _shown("wysokosc"), S.display_value(S.round_step(mean, 0.5)), 0.88, scope),
        _anomaly(h.between(*REVIEW_HEIGHT), "height_review", name, _shown("wysokosc"), shown),
        _anomaly(h < HEIGHT[0], "height_low", name, _shown("wysokosc"), shown),
    ]


def rule_coordinates() -> list[Column]:
    lat, lon = F.col("lat_n"), F.col("lon_n")
    no_lat, no_lon = lat.isNull() & F.col("gap_lat"), lon.isNull() & F.col("gap_lon")
    known = ~no_lat & ~no_lon & lat.isNotNull() & lon.isNotNull()
    lat_ok, lon_ok = lat.between(*LAT), lon.between(*LON)
    swapped = known & ~(lat_ok & lon_ok) & lon.between(*LAT) & lat.between(*LON)
    outside = known & ~(lon.between(*LAT) & lat.between(*LON))
    pair = lambda a, b: F.concat_ws(", ", a, b)
    none = F.concat_ws("|", F.when(no_lat, HEADERS["lat"]), F.when(no_lon, HEADERS["lon"]))
    raw = F.concat_ws(" / ", F.when(no_lat, _shown("lat")), F.when(no_lon, _shown("lon")))
    return [
        _anomaly(no_lat | no_lon, "coordinates_missing", none, raw),
        _anomaly(swapped, "coordinates_swapped", _fields("lat", "lon"), pair(_shown("lat"), _shown("lon")), pair(S.display_value(lat), S.display_value(lon))),
        _correction(swapped, "swap_lat", HEADERS["lat"], _shown("lat"), S.display_value(lon), 0.99, "lat/long swap"),
        _correction(swapped, "swap_lon", HEADERS["lon"], _shown("lon"), S.display_value(lat), 0.99, "lat/long swap"),
        _anomaly(outside & ~lat_ok, "latitude_outside", HEADERS["lat"], _shown("lat"), S.display_value(lat)),
        _anomaly(outside & ~lon_ok, "longitude_outside", HEADERS["lon"], _shown("lon"), S.display_value(lon)),
    ]


def _dominant_correction(rule: str, name: str, most: float) -> Column:
    hit = F.col(f"mode_{name}")
    before, after = CORRECTIONS[rule][1].split("{}")
    reason = F.concat(F.lit(before), hit["n"].cast("string"), F.lit(after))
    return _correction(F.col(f"gap_{name}") & hit.isNotNull(), rule, HEADERS[name], _shown(name), hit["value"], F.least(F.lit(most), hit["share"]), hit["scope"], reason)


def rule_missing_unit() -> list[Column]:
    out = []
    for name in ("jednostka_psp", "kod_swd"):
        reason = ANOMALIES["missing_unit"][3].format(HEADERS[name])
        out += [_anomaly(F.col(f"gap_{name}"), "missing_unit", HEADERS[name], _shown(name), "", reason), _dominant_correction("missing_unit", name, 0.95)]
    return out


def rule_status_logic() -> list[Column]:
    is_ = lambda n, v: F.col(f"st_{n}").eqNullSafe(v)
    tests = [
        ("digital_without_gsm", ["gsm"], ["st_gsm"], F.col("kind").eqNullSafe("cyfrowa") & ~is_("gsm", "TAK")),
        ("group_without_paths", ["wgr_sygn", "sygn_osp", "sygn_ol"], ["st_wgr_sygn", "st_sygn_osp", "st_sygn_ol"], is_("wgr_sygn", "TAK") & ~is_("sygn_osp", "TAK") & ~is_("sygn_ol", "TAK")),
        ("osp_owner_without_signal", ["wlasciciel", "sygn_osp"], ["owner", "st_sygn_osp"], F.col("owner").eqNullSafe("osp") & is_("sygn_osp", "NIE")),
        ("no_control", ["gsm", "sk_psp"], ["st_gsm", "st_sk_psp"], ~is_("gsm", "TAK") & ~is_("sk_psp", "TAK")),
    ]
    return [_anomaly(test, rule, _fields(*raw), _shown(*raw), _shown(*shown)) for rule, raw, shown, test in tests]


def rule_missing_status() -> list[Column]:
    out = []
    for name in STATUSES:
        out += [_anomaly(F.col(f"gap_{name}"), "missing_status", HEADERS[name], _shown(name), _shown(f"st_{name}")), _dominant_correction("missing_status", name, 0.9)]
    return out


def rule_outliers() -> list[Column]:
    out = []
    for rule, name, number in (("power_outlier", "moc_w", "power"), ("height_outlier", "wysokosc", "height")):
        stat, value = F.col(f"stat_{number}"), F.col(number)
        far = F.col(f"{number}_ok") & (stat["mad"] > 0) & (F.abs(value - stat["median"]) / stat["mad"] > MAD_Z)
        a, b, c = ANOMALIES[rule][3].split("{}")
        reason = F.concat(F.lit(a), stat["scope"], F.lit(b), stat["n"].cast("string"), F.lit(c))
        out.append(_anomaly(far, rule, HEADERS[name], _shown(name), S.display_value(value), reason))
    return out


RULES: dict[str, Callable[[], list[Column]]] = {
    "duplicates": rule_duplicates,
    "status_form": rule_status_form,
    "parse_errors": rule_parse_errors,
    "missing_power": rule_missing_power,
    "missing_height": rule_missing_height,
    "analogue_power": rule_analogue_power,
    "digital_power": rule_digital_power,
    "height_range": rule_height_range,
    "coordinates": rule_coordinates,
    "missing_unit": rule_missing_unit,
    "status_logic": rule_status_logic,
    "missing_status": rule_missing_status,
    "outliers": rule_outliers,
}


def fired_rules(rows: DataFrame, *names: str) -> DataFrame:
    """lp, nr_ref and the firings of the named rules, or of all, over ``evidence`` rows."""
    found = [c for name in names or RULES for c in RULES[name]()]
    fired = F.filter(F.array(*found), lambda x: x.isNotNull())
    return rows.select("lp", F.coalesce(F.col("nr_ref").cast("string"), F.lit("")).alias("nr_ref"), F.inline(fired))


def anomalies(fired: DataFrame) -> DataFrame:
    """One row per distinct anomaly of a record, with the rank to sort by (high first)."""
    rank = F.array_position(F.array(*map(F.lit, SEVERITIES)), F.col("severity"))
    found = fired.where("kind = 'anomaly'").select("nr_ref", "category", "severity", "confidence", "field", "raw", "value", "reason")
    return found.distinct().withColumn("severity_rank", rank)


def corrections(fired: DataFrame) -> DataFrame:
    """One row per distinct proposal."""
    found = fired.where("kind = 'correction'")
    return found.select("nr_ref", "field", "raw", F.col("value").alias("suggested"), "method", "confidence", "scope", "reason").distinct()


def audit_summary(df: DataFrame, found: DataFrame, proposed: DataFrame, top: int = 10) -> DataFrame:
    """(section, name, value): the numbers of the audit report.

    Percentages are of all cells or all records, two decimals; the ``top`` most
    frequent reasons come with ties by text. ``df`` is the prepared register
    ``with_gaps``, ``found`` and ``proposed`` its anomalies and corrections.
    """
    names = list(HEADERS)
    one = df.agg(
        F.count(F.lit(1)).alias("records"),
        F.sum("raw_gaps").alias("raw"),
        F.sum(reduce(Column.__add__, (F.col(f"gap_{n}").cast("int") for n in names))).alias("actionable"),
    )
    a = found.agg(F.count(F.lit(1)).alias("a_n"), F.count_distinct("nr_ref").alias("a_records"))
    c = proposed.agg(F.count(F.lit(1)).alias("c_n"), F.count_distinct("nr_ref").alias("c_records"), F.count_if(F.col("confidence") < 0.5).alias("c_low"))
    numbers = one.join(a, F.lit(True)).join(c, F.lit(True))
    cells = F.col("records") * len(names)
    pct = lambda n, of: F.coalesce(F.bround(F.try_divide(n * 100, of), 2), F.lit(0.0))
    col = F.col
    rows = {
        ("size", "records"): col("records"), ("size", "columns"): F.lit(len(names)),
        ("missing", "raw_total"): F.coalesce("raw", F.lit(0)), ("missing", "raw_pct_cells"): pct(col("raw"), cells),
        ("missing", "actionable_total"): F.coalesce("actionable", F.lit(0)), ("missing", "actionable_pct_cells"): pct(col("actionable"), cells),
        ("anomalies", "total_entries"): col("a_n"), ("anomalies", "records_with_anomalies"): col("a_records"),
        ("anomalies", "records_with_anomalies_pct"): pct(col("a_records"), col("records")), ("anomalies", "entries_pct_cells"): pct(col("a_n"), cells),
        ("corrections", "total_entries"): col("c_n"), ("corrections", "records_with_corrections"): col("c_records"),
        ("corrections", "records_with_corrections_pct"): pct(col("c_records"), col("records")), ("corrections", "low_confidence_count"): col("c_low"),
    }
    entries = F.array(*(F.struct(F.lit(s).alias("section"), F.lit(n).alias("name"), v.cast("double").alias("value")) for (s, n), v in rows.items()))

    def by(of: DataFrame, section: str, column: str) -> DataFrame:
        return of.groupBy(F.lit(section).alias("section"), F.col(column).alias("name")).agg(F.count(F.lit(1)).cast("double").alias("value"))

    reasons = by(found, "anomalies by reason", "reason").orderBy(F.desc("value"), "name").limit(top)
    parts = [numbers.select(F.inline(entries)), by(found, "anomalies by category", "category"), by(found, "anomalies by severity", "severity"), reasons]
    return reduce(DataFrame.unionByName, [*parts, by(proposed, "corrections by method", "method")])


def quality_flags(found: DataFrame) -> DataFrame:
    """Per record: counts by severity, any of each category, highest severity."""
    top = F.min("severity_rank")
    has = lambda name: F.max(F.when(F.col("category") == name, 1).otherwise(0)).cast("bigint").alias(f"has_{name}_anomaly")
    return found.groupBy("nr_ref").agg(
        F.count(F.lit(1)).alias("anomaly_count"),
        *(F.count_if(F.col("severity") == s).alias(f"anomaly_{s}_count") for s in SEVERITIES[:3]),
        *(has(n) for n in ("logical", "technical", "geographic", "relational")),
        F.element_at(F.array(*map(F.lit, SEVERITIES)), top.cast("int")).alias("max_anomaly_severity"),
        F.lit("REVIEW").alias("record_status"),
    )


def normalise(df: DataFrame, flags: DataFrame) -> DataFrame:
    """The typed register of 41 columns with its quality flags: blank texts are '0', missing numbers and flags 0."""
    blank = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("0"))
    keyed = ("wojewodztwo", "powiat", "gmina", "wlasciciel", "rodzaj_syreny", "jednostka_psp")
    texts = {n: v for k in keyed for n, v in ((k, S.clean_text(F.col(k))), (f"{k}_key", S.ascii_key(F.col(k))))}
    statuses = {f"{s}_status": F.upper(S.clean_text(F.col(s))) for s in STATUSES}
    counted = [f for f in flags.columns if f.startswith(("anomaly_", "has_"))]
    zero = F.lit(0)
    whole = lambda n: F.bround(S.plain_number(F.col(n).cast("string"))).cast("bigint")
    decimal = lambda n: F.coalesce(S.plain_number(F.col(n)), F.lit(0.0))
    out = df.join(flags.withColumnRenamed("nr_ref", "__ref"), S.clean_text(F.col("nr_ref")) == F.col("__ref"), "left")
    return out.select(
        F.coalesce(whole("lp"), zero).alias("lp"),
        blank(S.clean_text(F.col("nr_ref"))).alias("nr_ref"), blank(S.date_iso(F.col("data"))).alias("data_iso"),
        *(blank(v).alias(n) for n, v in texts.items()), blank(S.clean_text(F.col("kod_swd"))).alias("kod_swd"),
        F.coalesce(whole("moc_w"), zero).alias("moc_w"), decimal("wysokosc").alias("wysokosc_nad_terenem_m"),
        decimal("lat").alias("lat"), decimal("lon").alias("lon"),
        *(blank(v).alias(n) for n, v in statuses.items()),
        *(F.coalesce(S.status_flag(F.col(s)), zero).alias(f"{s}_flag") for s in STATUSES),
        *(F.coalesce(F.col(n), zero).alias(n) for n in counted),
        F.coalesce("max_anomaly_severity", F.lit("0")).alias("max_anomaly_severity"), F.coalesce("record_status", F.lit("OK")).alias("record_status"),
        F.col("record_status").isNull().cast("bigint").alias("is_clean_record"),
    )


def quality_table(df: DataFrame, columns: int, top: int = 12) -> DataFrame:
    """(category, metric, value): size, missing cells and duplicate ids of the prepared register ``with_gaps``, and its largest owners.
    ``columns`` is the column count of the normalised register."""
    names = list(HEADERS)
    ids = frequency(df.select(S.clean_or_null(F.col("nr_ref").cast("string")).alias("id")), "id").agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("twice"))
    one = df.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("kind") == "analogowa").alias("analogue"),
        F.coalesce(F.sum("raw_gaps"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum(reduce(Column.__add__, (F.col(f"gap_{n}").cast("int") for n in names))), F.lit(0)).alias("actionable"),
    ).join(ids, F.lit(True))
    rows = {
        ("V9", "records"): F.col("records"), ("V9", "columns"): F.lit(columns).cast("bigint"), ("V9", "analog_records"): F.col("analogue"),
        ("quality", "raw_missing_total"): F.col("raw"), ("quality", "actionable_missing_total"): F.col("actionable"), ("quality", "duplicate_nr_ref"): F.col("twice"),
    }
    entries = F.array(*(F.struct(F.lit(c).alias("category"), F.lit(m).alias("metric"), v.alias("value")) for (c, m), v in rows.items()))
    owners = frequency(df.select(S.clean_or_null(F.col("wlasciciel")).alias("metric")), "metric").orderBy(F.desc("n"), "metric").limit(top)
    return one.select(F.inline(entries)).unionByName(owners.select(F.lit("owners").alias("category"), "metric", F.col("n").alias("value")))
