"""SRC and M: files written to the shared folder and read back, and manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from earshot.plans.registry import query
from earshot.sources import files as S
from earshot.sources.storage import shared_path

c = F.col
_REG = ["nr_ref", "data", "wojewodztwo", "powiat", "gmina", "wlasciciel", "rodzaj_syreny", "moc_w", "wysokosc", "gsm", "lat", "lon", "kod_swd"]


@query("src01_text_csv", f"SELECT {', '.join(_REG)} FROM fx_register", "fx_register")
def src01(t):
    path = shared_path(t.spark, "csv")
    S.write_csv(t.fx_register.select(_REG), path, quote_all=True)
    return S.read_text_csv(t.spark, path, _REG)


@query("src02_typed_csv", "SELECT unit_no, gmi, xmin, ymin FROM fx_admin", "fx_admin")
def src02(t):
    path = shared_path(t.spark, "csv")
    S.write_csv(t.fx_admin.select("unit_no", "gmi", "xmin", "ymin"), path)
    return S.read_typed_csv(t.spark, path, "unit_no bigint, gmi string, xmin bigint, ymin bigint")


@query("src03_unit_register", "SELECT substr(gmi, 1, 2) AS woj, substr(gmi, 3, 2) AS pow, substr(gmi, 5, 2) AS gmi, substr(gmi, 7, 1) AS rodz, name AS nazwa FROM fx_admin", "fx_admin")
def src03(t):
    path, part = shared_path(t.spark, "register"), lambda i, n: F.substring("gmi", i, n)
    rows = t.fx_admin.select(part(1, 2).alias("woj"), part(3, 2).alias("pow"), part(5, 2).alias("gmi"), part(7, 1).alias("rodz"), c("name").alias("nazwa"))
    S.write_csv(rows, path, sep=";")
    return S.read_text_csv(t.spark, path, rows.columns, sep=";")


@query("src07_layer_parts", "SELECT * FROM fx_risk", "fx_risk")
def src07(t):
    path = shared_path(t.spark, "layer")
    S.write_layer(t.fx_risk.where("risk = 1"), f"{path}/a", t.fx_risk.columns)
    S.write_layer(t.fx_risk.where("risk <> 1"), f"{path}/b", t.fx_risk.columns)
    return S.read_parts(t.spark, f"{path}/a", f"{path}/b")


@query("src10_optional_table", "SELECT nr_ref, moc_w, 0::BIGINT AS extra FROM fx_sites", "fx_sites")
def src10(t):
    """A table that isn't there counts as empty: every site has zero rows of it."""
    extra = S.read_optional(t.spark, shared_path(t.spark, "absent"), "nr_ref string, n bigint").groupBy("nr_ref").agg(F.sum("n").alias("extra"))
    return t.fx_sites.select("nr_ref", "moc_w").join(extra, "nr_ref", "left").na.fill(0, ["extra"])


@query("src11_union_of_columns", "SELECT nr_ref, moc_w::VARCHAR AS moc_w, '' AS name FROM fx_sites UNION ALL SELECT gmi, '', name FROM fx_admin", "fx_sites", "fx_admin")
def src11(t):
    path = shared_path(t.spark, "union")
    a = t.fx_sites.select("nr_ref", c("moc_w").cast("string").alias("moc_w"))
    b = t.fx_admin.select(c("gmi").alias("nr_ref"), "name")
    S.write_csv(S.union_rows(a, b), path)
    return S.read_text_csv(t.spark, path, ["nr_ref", "moc_w", "name"])


@query("src12_csv_and_parquet", "SELECT 'parquet' AS name, count(*) AS n, 4 AS columns FROM fx_sites UNION ALL SELECT 'csv', count(*), 4 FROM fx_sites", "fx_sites")
def src12(t):
    path, rows = shared_path(t.spark, "both"), t.fx_sites.select("nr_ref", "kind", "moc_w", "owner")
    S.write_both(rows, path)
    return S.shape(t.spark.read.parquet(f"{path}/parquet"), "parquet").unionByName(S.shape(S.read_text_csv(t.spark, f"{path}/csv", rows.columns), "csv"))


def _package(t) -> dict:
    return {"A01_sites": t.fx_sites, "A02_units": t.fx_admin, "A03_risk": t.fx_risk, "A04_cells": t.fx_popgrid}


@query("src13_table_package", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n, {k} AS columns FROM {f}" for n, f, k in (("A01_sites", "fx_sites", 10), ("A02_units", "fx_admin", 5), ("A03_risk", "fx_risk", 6), ("A04_cells", "fx_popgrid", 4))), "fx_sites", "fx_admin", "fx_risk", "fx_popgrid")
def src13(t):
    path, tables = shared_path(t.spark, "package"), _package(t)
    S.publish(tables, path)
    return S.union_rows(*(S.shape(t.spark.read.parquet(f"{path}/{n}"), n) for n in tables))


@query("src14_layer_sink", "SELECT zone_id, risk, xmin, ymin, w, h FROM fx_risk", "fx_risk")
def src14(t):
    path = shared_path(t.spark, "layer")
    S.write_layer(t.fx_risk, path, ["zone_id", "risk", "xmin", "ymin", "w", "h"])
    return t.spark.read.parquet(path)


@query("src15_json_sidecar", "SELECT kind, count(*) AS n, sum(moc_w)::BIGINT AS power FROM fx_sites GROUP BY kind", "fx_sites")
def src15(t):
    path = shared_path(t.spark, "sidecar")
    S.write_json(t.fx_sites.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("moc_w").alias("power")), path)
    return S.read_json(t.spark, path, "kind string, n bigint, power bigint")


@query("src18_copy_layer", "SELECT count(*) AS n FROM fx_buildings", "fx_buildings")
def src18(t):
    path = shared_path(t.spark, "copy")
    S.write_layer(t.fx_buildings, path, t.fx_buildings.columns)
    return t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


#: Table of the package, the fixture it is made of, its columns, and a sum over its values.
_WRITTEN = (
    ("A01_sites", "fx_sites", 10, "lp * 3 + moc_w + x + y"),
    ("A02_units", "fx_admin", 5, "unit_no + xmin * 2 + ymin"),
    ("A03_risk", "fx_risk", 6, "zone_id * risk + xmin + h"),
    ("A04_cells", "fx_popgrid", 4, "cell_id + gx * 5 + gy * 7 + tot"),
)


@query("v05_written_shapes", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n, {k} AS columns, sum({v})::BIGINT AS total FROM {f}" for n, f, k, v in _WRITTEN), *(w[1] for w in _WRITTEN))
def v05(t):
    """Rows, columns and a sum over the values of each table of the package, as they are read back from disk."""
    path = shared_path(t.spark, "package")
    S.publish(_package(t), path)
    parts = []
    for name, _, _, value in _WRITTEN:
        written = t.spark.read.parquet(f"{path}/{name}")
        parts.append(S.shape(written, name).crossJoin(written.agg(F.sum(F.expr(value)).cast("bigint").alias("total"))))
    return S.union_rows(*parts)


@query("m01_file_manifest")
def m01(t):
    """Size and SHA-256 of every file of the given tables."""
    return S.manifest(t.spark, t.sf_dir)


_PATHS = "(SELECT CASE doc_id % 5 WHEN 0 THEN 'result/' || coalesce(source, '') || '.csv' WHEN 1 THEN 'result/part-' || (doc_id % 50)::VARCHAR || '.bin' WHEN 2 THEN 'layer-' || doc_id::VARCHAR || '.parquet' WHEN 3 THEN 'result/.hidden' || doc_id::VARCHAR || '.crc' ELSE 'notes/' || coalesce(source, '') || '.csv' END AS path FROM documents)"


@query("m02_package_groups", f"SELECT min(path) AS path, target, CASE WHEN min(path) LIKE 'result/%.csv' THEN 'tables' WHEN min(path) LIKE 'result/%' THEN 'results' WHEN min(path) LIKE '%.parquet' THEN 'layers' ELSE 'other' END AS \"group\" FROM (SELECT path, regexp_replace(path, '^result/', '') AS target FROM {_PATHS} WHERE path NOT LIKE '%.crc') GROUP BY target")
def m02(t):
    k, src = c("doc_id") % 5, F.coalesce("source", F.lit(""))
    cat = lambda *p: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in p))
    path = (
        F.when(k == 0, cat("result/", src, ".csv")).when(k == 1, cat("result/part-", c("doc_id") % 50, ".bin")).when(k == 2, cat("layer-", c("doc_id"), ".parquet"))
        .when(k == 3, cat("result/.hidden", c("doc_id"), ".crc")).otherwise(cat("notes/", src, ".csv"))
    )
    return S.expand_packages(t.documents.select(path.alias("path")))


@query(
    "m03_verify_manifest",
    """a AS (SELECT nr_ref AS path, length(name) AS size, sha256(name) AS sha256 FROM fx_v1), b AS (SELECT nr_ref AS path, length(name) AS size, sha256(CASE WHEN size = '7' THEN brand ELSE name END) AS sha256 FROM fx_v3),
    j AS (SELECT path, CASE WHEN b.sha256 IS NULL THEN 'missing' WHEN a.sha256 IS NULL THEN 'unexpected' WHEN a.size <> b.size THEN 'size' WHEN a.sha256 <> b.sha256 THEN 'hash' END AS problem FROM a FULL JOIN b USING (path))
    SELECT * FROM j WHERE problem IS NOT NULL""",
    "fx_v1", "fx_v3",
)
def m03(t):
    entry = lambda df, text: df.select(c("nr_ref").alias("path"), F.length("name").cast("bigint").alias("size"), F.sha2(text, 256).alias("sha256"))
    return S.verify_manifest(entry(t.fx_v1, c("name")), entry(t.fx_v3, F.when(c("size") == "7", c("brand")).otherwise(c("name"))))


