"""Corrections, change registry, overlays and imputation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import scalars as S
from earshot.operators.quantiles import grouped

MIN_CONFIDENCE = 0.5
# fixed values of the overlay
OVERLAY_LAT, OVERLAY_LON, OVERLAY_POWER, OVERLAY_HEIGHT = (48.5, 55.2), (13.5, 24.5), (300, 5500), (3, 30)
OPERATIONS = ["add", "update", "disable"]


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """(keys, n) that occur more than once; must be empty before a table is changed."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def _cells(df: DataFrame, key: str) -> DataFrame:
    fields = [c for c in df.columns if c != key]
    return df.unpivot([key], fields, "field", "before")


def classify_corrections(base: DataFrame, corrections: DataFrame, key: str = "nr_ref", least: float = MIN_CONFIDENCE) -> DataFrame:
    """Each correction with the value before, whether it matched, and its outcome;
    the first reason against it wins."""
    fields = [c for c in base.columns if c != key]
    known = base.select(F.col(key)).distinct().withColumn("known", F.lit(True))
    rows = corrections.join(known, key, "left").join(_cells(base, key), [key, "field"], "left")
    outcome = (
        F.when(F.col("confidence") < least, "below_confidence")
        .when(F.col("known").isNull(), "unknown_record")
        .when(~F.col("field").isin(fields), "unknown_column")
        .otherwise("applied")
    )
    return rows.select(key, "field", "before", "suggested", "confidence", outcome.alias("outcome"), F.col("before").eqNullSafe(F.col("expected")).alias("matched"))


def _wide(changes: DataFrame, key: str, fields: list[str], value: str) -> DataFrame:
    """One row per key with a struct per field, null where the field isn't changed (a change to '' still is one)."""
    return changes.groupBy(key).agg(*(F.max(F.when(F.col("field") == f, F.struct(F.col(value).alias("v")))).alias(f"__{f}") for f in fields))


def apply_cells(base: DataFrame, changes: DataFrame, key: str = "nr_ref", value: str = "suggested") -> DataFrame:
    fields = [c for c in base.columns if c != key]
    joined = base.join(_wide(changes, key, fields, value), key, "left")
    return joined.select(key, *(F.when(F.col(f"__{f}").isNotNull(), F.col(f"__{f}.v")).otherwise(F.col(f)).alias(f) for f in fields))


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def rule_id(stage: Column, operation: Column, key: Column, field: Column) -> Column:
    """Names a change by where it was made, not by its value: the same change in a new run keeps its id."""
    parts = F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in (stage, operation, key, field)))
    return F.concat(F.lit("CORR-"), F.upper(F.substring(F.sha2(parts, 256), 1, 12)))


# fixed values of the registry
REGISTRY = ["rule_id", "stage", "operation", "nr_ref", "field", "before", "after", "reason", "source", "confidence"]
HEIGHT_REASON = "Korekta wysokości montażu zgodnie z kontrolami domenowymi V5–V8."
MODEL_POWER_REASON = "Ujednolicenie mocy modelowej, w tym analogowej SAD do odpowiednika DSE V9."
POWER_REASON = "Korekta jednostki lub wartości mocy po kontroli jakości."
ELEVATION_REASON = "Uzupełnienie wysokości n.p.m. z danych SRTM."
OTHER_REASON = "Zmiana zarejestrowana między zatwierdzonymi snapshotami pipeline."
ADDED_REASON = "Rekord dodany między snapshotami."
DISABLED_REASON = "Rekord usunięty z aktywnego snapshotu."
REMOVED_REASON = "Usunięcie technicznej kolumny roboczej ze schematu kolejnego snapshotu."


def change_reason(stage: Column, operation: Column, field: Column) -> Column:
    return (
        F.when(operation == "add", ADDED_REASON)
        .when(operation == "disable", DISABLED_REASON)
        .when(operation == "remove_field", REMOVED_REASON)
        .when(field == "wysokosc_nad_terenem_m", HEIGHT_REASON)
        .when((field == "moc_w") & stage.contains("V9"), MODEL_POWER_REASON)
        .when(field == "moc_w", POWER_REASON)
        .when(field == "npm_m", ELEVATION_REASON)
        .otherwise(OTHER_REASON)
    )


def change_confidence(operation: Column, before: Column, after: Column) -> Column:
    """0.9 for an update from or to a blank, else 1.0."""
    return F.when((operation == "update") & ((before == "") | (after == "")), 0.9).otherwise(1.0)


def _text(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def record_json(columns: list[str]) -> Column:
    """The filled fields of a row as JSON text, keys sorted, a space behind each colon and comma."""
    value = lambda c: F.regexp_extract(F.to_json(F.struct(_text(c).alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    field = lambda c: F.when(_text(c) != "", F.concat(F.lit(f'"{c}": '), value(c)))
    return F.concat(F.lit("{"), F.array_join(F.array(*(field(c) for c in sorted(columns))), ", "), F.lit("}"))


def _registry(rows: DataFrame, names: tuple[str, str], key: str) -> DataFrame:
    """(operation, key, field, before, after) rows as registry rows of a step."""
    old, new = names
    stage, op, field = F.lit(f"{old}→{new}"), F.col("operation"), F.col("field")
    source = F.when(op.isin("add", "disable"), f"{new}.csv").otherwise(f"{old}.csv -> {new}.csv")
    more = {
        "stage": stage,
        "rule_id": rule_id(stage, op, F.col(key), field),
        "reason": change_reason(stage, op, field),
        "source": source,
        "confidence": change_confidence(op, F.col("before"), F.col("after")),
    }
    return rows.withColumns(more).select([key if c == "nr_ref" else c for c in REGISTRY])


def diff(before: DataFrame, after: DataFrame, names: tuple[str, str], key: str = "nr_ref") -> DataFrame:
    """Registry rows that lead from one snapshot to the next: add, disable and update per
    changed field. Nulls count as blanks, and a field that ``before`` lacks is blank there;
    fields that ``after`` lacks are ``removed_columns``'. One full outer join on the key;
    fields are compared inside the joined row and only changed ones are exploded."""
    fields = [c for c in after.columns if c != key]
    a = before.select(F.col(key), F.struct(*(_text(c).alias(c) if c in before.columns else F.lit("").alias(c) for c in fields)).alias("a"))
    b = after.select(F.col(key), F.struct(*(_text(c).alias(c) for c in fields)).alias("b"), record_json(after.columns).alias("record"))
    change = lambda op, f, x, y: F.struct(F.lit(op).alias("operation"), F.lit(f).alias("field"), x.alias("before"), y.alias("after"))
    updates = F.array_compact(F.array(*(F.when(F.col(f"a.`{f}`") != F.col(f"b.`{f}`"), change("update", f, F.col(f"a.`{f}`"), F.col(f"b.`{f}`"))) for f in fields)))
    events = (
        F.when(F.col("a").isNull(), F.array(change("add", "record_json", F.lit(""), F.col("record"))))
        .when(F.col("b").isNull(), F.array(change("disable", "record", F.lit("active"), F.lit("disabled"))))
        .otherwise(updates)
    )
    rows = a.join(b, key, "full_outer").select(key, F.explode(events).alias("e")).select(key, "e.*")
    return _registry(rows, names, key)


def removed_columns(before: DataFrame, after: DataFrame, names: tuple[str, str], key: str = "nr_ref") -> DataFrame:
    """Registry rows for columns that ``after`` lacks, with ``filled``: how many rows of ``before`` had a value there."""
    gone = [c for c in before.columns if c not in after.columns]
    filled = before.agg(*(F.count_if(_text(c) != "").alias(c) for c in gone)) if gone else before.agg(F.lit(0).alias("none"))
    rows = filled.select(F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").alias("filled")) for c in gone)).cast("array<struct<field:string,filled:bigint>>")).alias("e")).select("e.*")
    rows = rows.withColumns({"operation": F.lit("remove_field"), key: F.lit("*"), "before": F.lit("column present"), "after": F.lit("column removed")})
    registry = _registry(rows, names, key)
    return registry.join(rows.select("field", "filled"), "field").select(*registry.columns, "filled")


def diff_chain(versions: list[tuple[str, DataFrame]], key: str = "nr_ref") -> DataFrame:
    """Registry over consecutive versions: removed columns and changed records of each step."""
    if len(versions) < 2:
        raise ValueError("a registry needs two versions at least")
    pairs = list(zip(versions, versions[1:], strict=False))
    changed = [diff(a, b, (x, y), key) for (x, a), (y, b) in pairs]
    gone = [removed_columns(a, b, (x, y), key).drop("filled") for (x, a), (y, b) in pairs if set(a.columns) - set(b.columns)]
    return reduce(DataFrame.unionByName, [*gone, *changed])


def replay(base: DataFrame, registry: DataFrame, stages: list[str], key: str = "nr_ref") -> DataFrame:
    """The stages of a registry applied to their base in order; all columns come out as text, blank
    where nothing is known. Which columns come and go is read from the registry (a row for each column)."""
    table = base.select(F.col(key), *(_text(c).alias(c) for c in base.columns if c != key))
    for stage in stages:
        own = registry.where(F.col("stage") == stage)
        of = lambda op, own=own: own.where(F.col("operation") == op)
        gone = {r[0] for r in of("remove_field").select("field").distinct().collect()}
        added_keys = of("add").select(F.explode(F.expr("json_object_keys(after)")).alias("field"))
        new = {r[0] for r in of("update").select("field").union(added_keys).distinct().collect()}
        fields = [c for c in table.columns if c != key and c not in gone] + sorted(new - set(table.columns) - {key})
        kept = table.join(of("disable").select(key), key, "left_anti")
        kept = kept.select(key, *((F.col(f"`{c}`") if c in table.columns else F.lit("")).alias(c) for c in fields))
        schema = ", ".join(f"`{c}` string" for c in fields)
        added = of("add").select(key, F.from_json("after", schema).alias("r")).select(key, *(F.coalesce(F.col(f"r.`{c}`"), F.lit("")).alias(c) for c in fields))
        table = apply_cells(kept, of("update"), key, "after").unionByName(added)
    return table


def replay_violations(base: DataFrame, registry: DataFrame, key: str = "nr_ref") -> DataFrame:
    """Updates whose record is missing or whose before-value differs; must be empty. A column that the
    base lacks reads as blank; withdrawing a record that isn't there is no fault."""
    cells = _cells(base, key).withColumnRenamed("before", "found")
    known = base.select(key).distinct().withColumn("known", F.lit(True))
    rows = registry.where("operation = 'update'").join(known, key, "left").join(cells, [key, "field"], "left")
    why = F.when(F.col("known").isNull(), "missing_record").when(F.col("before") != F.coalesce("found", F.lit("")), "before_differs")
    return rows.withColumn("violation", why).where("violation is not null").select("rule_id", key, "field", "before", "found", "violation")


def snapshot_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one snapshot that the other lacks, with the side they are on."""
    b = b.select(a.columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))


def table_digest(df: DataFrame) -> DataFrame:
    """Order-free content digest: rows, and the sum of the rows' leading hash digits."""
    text = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in sorted(df.columns)))
    head = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(head).alias("digest"))


# overlays

_SET = ["kind", "moc_w", "height", "lat", "lon", "gsm"]


def overlay_rows(overlay: DataFrame) -> DataFrame:
    """Overlay rows that hold anything at all."""
    some = reduce(lambda a, b: a | b, (F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "" for c in overlay.columns if c != "row_no"))
    return overlay.where(some)


def _outside(c: Column, limits: tuple) -> Column:
    return F.coalesce(~c.between(*limits), F.lit(True))


def overlay_rejects(base: DataFrame, overlay: DataFrame, units: DataFrame) -> DataFrame:
    """(row_no, nr_ref, operation, reject): null where the row is sound. Values of
    an update are checked on the merged record."""
    twice = overlay.groupBy("nr_ref").agg(F.count(F.lit(1)).alias("times"))
    now = base.select("nr_ref", F.struct(*_SET).alias("old"))
    codes = units.select(F.col("gmi").alias("unit")).distinct().withColumn("unit_known", F.lit(True))
    rows = overlay.join(twice, "nr_ref").join(now, "nr_ref", "left").join(codes, "unit", "left")
    merged = lambda n: F.coalesce(F.nullif(F.col(n), F.lit("")), F.col(f"old.{n}"))
    number = lambda n: S.parse_number(merged(n))
    any_set = reduce(lambda a, b: a | b, (F.coalesce(F.col(c), F.lit("")) != "" for c in _SET))
    op, exists = F.col("operation"), F.col("old").isNotNull()
    values = op.isin("add", "update") & (
        _outside(number("lat"), OVERLAY_LAT) | _outside(number("lon"), OVERLAY_LON) | _outside(number("moc_w"), OVERLAY_POWER) | _outside(number("height"), OVERLAY_HEIGHT)
    )
    reject = (
        F.when(F.col("times") > 1, "duplicate_key")
        .when(~op.isin(OPERATIONS), "bad_operation")
        .when((op == "add") & exists, "add_exists")
        .when(op.isin("update", "disable") & ~exists, "missing_record")
        .when((op == "disable") & any_set, "disable_with_data")
        .when((op == "update") & ~any_set, "empty_update")
        .when((op == "add") & F.col("unit_known").isNull(), "unknown_unit")
        .when(values, "value_out_of_range")
    )
    return rows.select("row_no", "nr_ref", "operation", reject.alias("reject"))


def apply_overlay(base: DataFrame, overlay: DataFrame) -> DataFrame:
    """Sound overlay rows applied: blank keeps a value, disable sets active to '0'."""
    new = overlay.select("nr_ref", F.col("operation").alias("__op"), *(F.nullif(F.col(c), F.lit("")).alias(f"__{c}") for c in _SET))
    old = base.join(new, "nr_ref", "left")
    kept = old.select(
        "nr_ref",
        *(F.when(F.col("__op") == "update", F.coalesce(f"__{c}", c)).otherwise(F.col(c)).alias(c) for c in _SET),
        F.when(F.col("__op") == "disable", "0").otherwise(F.col("active")).alias("active"),
    )
    added = new.where("__op = 'add'").select("nr_ref", *(F.coalesce(f"__{c}", F.lit("")).alias(c) for c in _SET), F.lit("1").alias("active"))
    return kept.unionByName(added)


def overlay_audit(base: DataFrame, overlay: DataFrame) -> DataFrame:
    """One row per overlay row: the changed fields, before and after."""
    rows = overlay.join(base.select("nr_ref", F.struct(*_SET).alias("old")), "nr_ref", "left")
    changed = F.filter(
        F.array(*(F.when((F.coalesce(F.col(c), F.lit("")) != "") & ~F.col(c).eqNullSafe(F.col(f"old.{c}")), F.struct(F.lit(c).alias("f"), F.coalesce(f"old.{c}", F.lit("")).alias("a"), F.col(c).alias("b"))) for c in _SET)),
        lambda e: e.isNotNull(),
    )
    join = lambda part: F.array_join(F.transform("changed", part), "; ")
    return rows.withColumn("changed", changed).select(
        "row_no", "operation", "nr_ref", join(lambda e: e["f"]).alias("field"), join(lambda e: e["a"]).alias("before"), join(lambda e: e["b"]).alias("after")
    )


def active(c: Column) -> Column:
    return ~F.upper(F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("1"))).isin("0", "FALSE", "NIE")


# imputation

def impute_heights(rows: DataFrame, highest: float = 0.0, above: float = 0.0) -> DataFrame:
    """(nr_ref, lp, kind, power, height, imputed, exact_peers, peers) for heights of at most
    ``highest``: the mean of the rows of the same kind that are higher than ``above``, weighted
    by 1 / (1 + |power difference| / 100), rounded to 0.5, and how many of them have the same
    power. Reference rows are summed per (kind, power) first, so the join meets distinct
    powers, never rows with rows. Rows without a power take no part; a kind that has no
    reference row at all raises when the result is read."""
    known = rows.where((F.col("height") > above) & F.col("power").isNotNull())
    peers = known.groupBy("kind", F.col("power").alias("p")).agg(F.sum("height").alias("h"), F.count(F.lit(1)).alias("n"))
    wanted = rows.where((F.col("height") <= highest) & F.col("power").isNotNull())
    weight = 1 / (1 + F.abs(F.col("power") - F.col("p")) / 100)
    exact = F.coalesce(F.sum(F.when(F.col("power") == F.col("p"), F.col("n"))), F.lit(0))
    means = (
        wanted.select("kind", "power").distinct().join(peers.withColumnRenamed("kind", "k"), F.col("kind").eqNullSafe(F.col("k")), "left").groupBy("kind", "power")
        .agg((F.sum(weight * F.col("h")) / F.sum(weight * F.col("n"))).alias("mean"), exact.alias("exact_peers"), F.coalesce(F.sum("n"), F.lit(0)).alias("peers"))
    )
    none = F.raise_error(F.concat(F.lit("no reference rows for the kind "), F.coalesce("kind", F.lit("")))).cast("double")
    mean = F.when(F.col("peers") == 0, none).otherwise(F.round("mean", 6))
    means = means.withColumnsRenamed({"kind": "mk", "power": "mp"})
    joined = wanted.join(means, F.col("kind").eqNullSafe(F.col("mk")) & (F.col("power") == F.col("mp")))
    return joined.select("nr_ref", "lp", "kind", "power", "height", S.round_step(mean, 0.5).alias("imputed"), "exact_peers", "peers")


def imputation_report(imputed: DataFrame) -> DataFrame:
    sums = imputed.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min("imputed").alias("low"), F.max("imputed").alias("high"), F.round(F.avg("imputed"), 6).alias("mean"))
    counts = imputed.groupBy(F.col("kind").alias("k"), "imputed").agg(F.count(F.lit(1)).alias("__n"))
    medians = grouped(counts, ["k"], "imputed", "__n", 0.5, "median")
    return sums.join(medians, F.col("kind").eqNullSafe(F.col("k"))).drop("k")


def add_elevation(sites: DataFrame, elevations: DataFrame, cell: int = 1000) -> DataFrame:
    """Elevation looked up once per distinct coordinate and joined back; never null."""
    places = sites.select("x", "y").distinct().withColumns({"cx": F.floor(F.col("x") / cell), "cy": F.floor(F.col("y") / cell)})
    found = places.join(elevations, ["cx", "cy"], "left").select("x", "y", F.bround(F.coalesce("npm", F.lit(0.0)), 1).alias("npm_m"))
    return sites.join(found, ["x", "y"], "left")
