"""Projections of the given tables on which the registered queries run.

The given tables hold no devices, so the register, buildings, census cells, risk
zones and units are integer projections of whole tables: 300 sites, 3,000
buildings and census cells, 400 zones and 20 units share a square of 40 km, and
more rows fill more squares. The SQL runs unchanged in Spark and in the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem documents pages".split()


def _div(a: str, b: str | int) -> str:
    return f"cast(floor(({a}) / {b}) as bigint)"


def _x(tile: str) -> str:
    return f"400000 + ({tile} % 10) * 40000"


def _y(tile: str) -> str:
    return f"500000 + {_div(tile, 10)} * 40000"


_SITE = "(c_custkey - case when c_custkey % 20 = 1 then 1 else 0 end)"
_SITE_TILE = _div(_SITE, 300)
_ORDER_TILE = _div("o_orderkey", 3000)
_PART_TILE = _div("p_partkey", 400)
_SHAPE = _div("l_orderkey", 8)
_RING = "case when l_orderkey % 8 < 3 then 0 when l_orderkey % 8 = 3 then 1 when l_orderkey % 8 < 7 then 2 else 3 end"
_TURN = f"6.283185307179586e0 * row_number() over (partition by {_SHAPE}, {_RING} order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) / count(*) over (partition by {_SHAPE}, {_RING})"
_REACH = "case when l_orderkey % 4 = 3 then 40 + l_partkey % 60 else 300 + (l_partkey * 37 + l_linenumber * 101) % 400 end"
_UNIT_TILE = _div("s_suppkey", 20)

SQL: dict[str, str] = {
    # register sites; every 20th pair is co-located
    "fx_sites": f"""
select c_custkey as lp, 'S-' || lpad(cast(c_custkey as string), 9, '0') as nr_ref,
  case when c_custkey % 3 = 0 then 'cyfrowa' else 'analogowa' end as kind,
  cast(case c_custkey % 5 when 0 then 300 when 1 then 600 when 2 then 900 when 3 then 1200 else 1500 end as bigint) as moc_w,
  cast(c_custkey % 2 as bigint) as gsm_flag, cast(case when c_custkey % 7 < 3 then 1 else 0 end as bigint) as sk_flag,
  c_mktsegment as owner, {_x(_SITE_TILE)} + ({_SITE} * 7919) % 40000 as x, {_y(_SITE_TILE)} + ({_SITE} * 104729) % 40000 as y,
  cast({_UNIT_TILE.replace("s_suppkey", f"({_SITE_TILE} * 20 + c_custkey % 20)")} as bigint) as woj_no,
  {_SITE_TILE} * 20 + {_SITE} % 20 as unit_no
from customer""",
    # raw register, all text, with gaps and mistakes
    "fx_register": f"""
select c_custkey as lp,
  'S-' || lpad(cast(c_custkey - case when c_custkey % 50 = 49 then 1 else 0 end as string), 9, '0') as nr_ref,
  case c_custkey % 7 when 0 then '31.12.2020' when 1 then '1/2/2021' when 2 then '2022-03-04' when 3 then '' when 4 then '32.1.2020' else '5.06.2019' end as data,
  'WOJ ' || cast({_div("c_custkey", 300)} % 4 as string) as wojewodztwo,
  'POW ' || cast({_div("c_custkey", 60)} % 20 as string) as powiat, 'GMI ' || cast({_div("c_custkey", 15)} as string) as gmina,
  case when c_custkey % 11 = 0 then 'OSP ' || c_mktsegment else c_mktsegment end as wlasciciel,
  case when c_custkey % 29 = 5 then '' when c_custkey % 3 = 0 then ' Cyfrowa' else 'Analogowa' end as rodzaj_syreny,
  case when c_custkey % 31 = 3 then '' when c_custkey % 37 = 4 then 'abc' when c_custkey % 41 = 6 then '30000'
       else cast(300 + (c_custkey * 7) % 50 * 100 as string) end as moc_w,
  case when c_custkey % 23 = 2 then '' when c_custkey % 43 = 7 then '150' when c_custkey % 47 = 8 then '75' when c_custkey % 53 = 9 then '1,5'
       else cast(6 + (c_custkey * 5) % 20 as string) || ',5' end as wysokosc,
  case c_custkey % 6 when 0 then 'TAK' when 1 then 'tak' when 2 then 'NIE' when 3 then 'n/d' when 4 then '' else 'T' end as gsm,
  case c_custkey % 5 when 0 then 'TAK' when 1 then 'NIE' when 2 then 'N/D' when 3 then 'nie ' else '' end as sk_psp,
  case c_custkey % 4 when 0 then 'TAK' when 1 then 'NIE' when 2 then 'N/D' else 'NIE' end as sygn_osp,
  case c_custkey % 3 when 0 then 'TAK' when 1 then 'NIE' else 'N/D' end as sygn_ol,
  case c_custkey % 9 when 0 then 'TAK' when 1 then '' else 'NIE' end as wgr_sygn,
  case when c_custkey % 59 = 11 then '' when c_custkey % 61 = 12 then '19.5' when c_custkey % 67 = 13 then '70.25' else cast(50 + c_custkey % 4 as string) || '.125' end as lat,
  case when c_custkey % 61 = 12 then '52.25' when c_custkey % 71 = 14 then '99' else cast(15 + c_custkey % 8 as string) || '.5' end as lon,
  case when c_custkey % 13 = 1 then '' else 'KP ' || cast({_div("c_custkey", 60)} % 20 as string) end as jednostka_psp,
  case when c_custkey % 17 = 1 then '' else 'SWD' || cast({_div("c_custkey", 60)} % 20 as string) end as kod_swd
from customer""",
    "fx_text": """
select doc_id, ' ' || coalesce(lang, '') || chr(160) || ' ' || coalesce(source, '') || '  ' as raw,
  case doc_id % 9 when 0 then 'tak' when 1 then ' NIE ' when 2 then 'n/d' when 3 then '' when 4 then '-' when 5 then 'Brak' when 6 then 'N D'
       when 7 then null else 'inny' end as status,
  case doc_id % 8 when 0 then '12,5' when 1 then ' 1 200 ' when 2 then 'x' when 3 then '' when 4 then '7;8' when 5 then 'N/D' when 6 then null
       else cast(doc_id as string) end as num,
  case doc_id % 7 when 0 then '31.12.2020' when 1 then '1/2/2021' when 2 then '2022-03-04' when 3 then '' when 4 then '32.1.2020' when 5 then null
       else '5.06.2019' end as day,
  case doc_id % 6 when 0 then 'Łódź ul. Żółta 5' when 1 then 'm. Kraków' when 2 then '  Gdańsk--Główny ' when 3 then null when 4 then 'm. st.  Warszawa' else 'ĄĆĘŁŃÓŚŹŻ é' end as place,
  cast(doc_id % 2477 * 7 as string) as code, doc_id * 37 % 1001 / 8e0 as v, cast(doc_id % 13 - 2 as bigint) as k, coalesce(n_chars, 0) as n
from documents""",
    "fx_buildings": f"""
select o_orderkey as bldg_id,
  case o_orderkey % 8 when 0 then 'house' when 1 then 'apartments' when 2 then 'yes' when 3 then 'school' when 4 then 'garage' when 5 then 'terrace'
       when 6 then 'office' else 'dormitory' end as bldg,
  cast(o_orderkey % 5 as bigint) as levels, cast(o_orderkey % 31 as bigint) as height_m, cast(20 + o_orderkey % 500 as bigint) as area_m2,
  {_x(_ORDER_TILE)} + (o_orderkey * 6151) % 40000 as x, {_y(_ORDER_TILE)} + (o_orderkey * 9973) % 40000 as y
from orders""",
    # 500 m census cells, 60 x 50 of them in each square
    "fx_popgrid": f"""
select o_orderkey as cell_id, ({_ORDER_TILE} % 10) * 80 + o_orderkey % 3000 % 60 as gx,
  {_div(_ORDER_TILE, 10)} * 80 + {_div("o_orderkey % 3000", 60)} as gy, cast(o_orderkey % 97 as bigint) as tot
from orders""",
    "fx_risk": f"""
select p_partkey as zone_id, {_x(_PART_TILE)} + (p_partkey * 3571) % 39000 as xmin, {_y(_PART_TILE)} + (p_partkey * 2593) % 39000 as ymin,
  300 + (p_partkey % 7) * 100 as w, 200 + (p_partkey % 5) * 100 as h, cast(1 + p_partkey % 2 as bigint) as risk
from part""",
    # units of 8 x 10 km: code = province, county, commune, kind
    "fx_admin": f"""
select s_suppkey as unit_no,
  lpad(cast({_UNIT_TILE} % 90 + 2 as string), 2, '0') || lpad(cast({_div("s_suppkey", 1800)} * 4 + {_div("s_suppkey % 20", 5)} + 1 as string), 2, '0')
    || lpad(cast(s_suppkey % 5 + 1 as string), 2, '0') || cast(s_suppkey % 3 + 1 as string) as gmi,
  {_x(_UNIT_TILE)} + s_suppkey % 5 * 8000 as xmin, {_y(_UNIT_TILE)} + {_div("s_suppkey % 20", 5)} * 10000 as ymin, s_name as name
from supplier""",
    # corners of concave shapes in two parts, each with a hole, in whole metres
    "fx_corners": f"""
select {_SHAPE} as shape_id, case when l_orderkey % 8 < 4 then 0 else 1 end as part, {_RING} as ring,
  row_number() over (partition by {_SHAPE}, {_RING} order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as pos,
  {_x(_div(_SHAPE, 400))} + ({_SHAPE} * 3571) % 38000 + case when l_orderkey % 8 < 4 then 0 else 1500 end + round(({_REACH}) * cos({_TURN})) as x,
  {_y(_div(_SHAPE, 400))} + ({_SHAPE} * 2593) % 39000 + round(({_REACH}) * sin({_TURN})) as y
from lineitem""",
    "fx_tags": """
select p_partkey as osm_id,
  case p_partkey % 6 when 0 then 'yes' when 1 then 'house' when 2 then 'no' else null end as building,
  case p_partkey % 7 when 3 then 'forest' when 4 then 'residential' when 5 then 'meadow' else null end as landuse,
  case p_partkey % 5 when 2 then 'water' when 3 then 'scrub' else null end as "natural",
  case p_partkey % 11 when 4 then 'park' else null end as leisure, case p_partkey % 13 when 5 then 'parking' else null end as amenity,
  case p_partkey % 9 when 1 then 'primary' when 2 then 'footway' when 3 then 'track' else null end as highway,
  case p_partkey % 4 when 0 then '3' when 1 then '2;4' when 2 then '' else null end as levels,
  case p_partkey % 5 when 0 then '12,5' when 1 then 'n/a' else null end as height, p_name as name
from part""",
    # three snapshots of one register, all text
    "fx_v1": """
select 'P-' || cast(p_partkey as string) as nr_ref, p_name as name, p_brand as brand, cast(p_size as string) as size, cast(p_partkey % 5 as string) as grade
from part""",
    "fx_v2": """
select case when p_partkey % 7 = 3 then 'N-' else 'P-' end || cast(p_partkey as string) as nr_ref, p_name as name,
  case when p_partkey % 7 = 2 then '' else p_brand end as brand, cast(p_size + case when p_partkey % 7 = 1 then 1 else 0 end as string) as size,
  cast(p_partkey % 5 as string) as grade
from part where p_partkey % 7 <> 0""",
    "fx_v3": """
select case when p_partkey % 7 = 3 then 'N-' else 'P-' end || cast(p_partkey as string) as nr_ref, p_name || case when p_partkey % 11 = 4 then '!' else '' end as name,
  case when p_partkey % 7 = 2 then '' else p_brand end as brand, cast(p_size + case when p_partkey % 7 = 1 then 1 else 0 end as string) as size,
  cast(p_partkey % 5 as string) as grade
from part where p_partkey % 7 <> 0 and p_partkey % 13 <> 6""",
    # three snapshots with the register's own field names; the second lacks a column, the third has a new one
    "fx_v5": """
select 'P-' || cast(p_partkey as string) as nr_ref, p_name as gmina, p_brand as wlasciciel, cast(p_size * 100 as string) as moc_w,
  case when p_partkey % 5 = 4 then '' else cast(p_partkey % 5 * 10 as string) end as wysokosc_nad_terenem_m, case when p_partkey % 3 = 0 then '' else 'x' end as robocza
from part""",
    "fx_v6": """
select case when p_partkey % 7 = 3 then 'N-' else 'P-' end || cast(p_partkey as string) as nr_ref, p_name || case when p_partkey % 14 = 3 then ' "q"' else '' end as gmina,
  case when p_partkey % 7 = 2 then '' else p_brand end as wlasciciel, cast(p_size * case when p_partkey % 9 = 5 then 10 else 100 end as string) as moc_w,
  case when p_partkey % 5 = 4 then '12' else cast(p_partkey % 5 * 10 as string) end as wysokosc_nad_terenem_m
from part where p_partkey % 7 <> 0""",
    "fx_v9": """
select case when p_partkey % 7 = 3 then 'N-' else 'P-' end || cast(p_partkey as string) as nr_ref, p_name || case when p_partkey % 14 = 3 then ' "q"' else '' end as gmina,
  case when p_partkey % 7 = 2 then '' else p_brand end as wlasciciel, case when p_partkey % 11 = 4 then '900' else cast(p_size * case when p_partkey % 9 = 5 then 10 else 100 end as string) end as moc_w,
  case when p_partkey % 5 = 4 then '12' else cast(p_partkey % 5 * 10 as string) end as wysokosc_nad_terenem_m, case when p_partkey % 17 = 2 then '' else cast(p_partkey % 300 as string) end as npm_m
from part where p_partkey % 7 <> 0 and p_partkey % 13 <> 6""",
    "fx_corrections": """
select case when p_partkey % 19 = 5 then 'X-' else 'P-' end || cast(p_partkey as string) as nr_ref,
  case p_partkey % 4 when 0 then 'size' when 1 then 'brand' when 2 then 'grade' else 'colour' end as field,
  case when p_partkey % 3 = 0 then '' else 'new ' || cast(p_partkey % 10 as string) end as suggested,
  case when p_partkey % 2 = 0 then cast(p_size as string) else p_brand end as expected, p_partkey % 10 / 10e0 as confidence,
  case p_partkey % 3 when 0 then 'mode' when 1 then 'mean' else 'rule' end as method
from part""",
    "fx_base": """
select 'S-' || cast(c_custkey as string) as nr_ref, case when c_custkey % 3 = 0 then 'cyfrowa' else 'analogowa' end as kind,
  cast(300 + c_custkey % 20 * 100 as string) as moc_w, cast(c_custkey % 28 + 3 as string) as height, cast(49 + c_custkey % 6 as string) as lat,
  cast(14 + c_custkey % 10 as string) as lon, case when c_custkey % 2 = 0 then 'TAK' else 'NIE' end as gsm,
  case c_custkey % 10 when 0 then '0' when 1 then 'nie' when 2 then '' else '1' end as active
from customer""",
    "fx_overlay": """
select p_partkey as row_no,
  case p_partkey % 9 when 0 then 'add' when 1 then 'update' when 2 then 'disable' when 3 then 'move' when 4 then 'add' when 5 then 'update' when 6 then '' when 7 then 'disable'
       else 'update' end as operation,
  case when p_partkey % 9 = 6 then '' when p_partkey % 31 = 8 then 'S-1' when p_partkey % 9 in (0) then 'Z-' || cast(p_partkey as string) else 'S-' || cast(p_partkey as string) end as nr_ref,
  case when p_partkey % 9 in (0, 4) then lpad(cast(2 + cast(floor(p_partkey / 20e0) as bigint) * 0 as string), 2, '0') || '01' || '0' || cast(p_partkey % 6 as string) || cast(p_partkey % 3 + 1 as string) else '' end as unit,
  case when p_partkey % 9 in (0, 1) then 'cyfrowa' else '' end as kind, case when p_partkey % 9 in (0, 1) then cast(200 + p_partkey % 60 * 100 as string) else '' end as moc_w,
  case when p_partkey % 9 in (0, 5) then cast(p_partkey % 40 as string) else '' end as height, case when p_partkey % 9 = 0 then '52,5' else '' end as lat,
  case when p_partkey % 9 = 0 then '19.25' else '' end as lon, case when p_partkey % 9 = 7 then 'TAK' else '' end as gsm
from part""",
}
SQL["fx_sites"] = SQL["fx_sites"].replace(
    "  cast(" + _UNIT_TILE.replace("s_suppkey", f"({_SITE_TILE} * 20 + c_custkey % 20)") + " as bigint) as woj_no,\n", ""
)


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A projection as a DataFrame; the parquet scan sees only its columns."""
    head, tail = SQL[name].rsplit("from ", 1)
    source, *rest = tail.split()
    text = f"{head}from {{source}} {' '.join(rest)}"
    return spark.sql(text.replace('"natural"', "`natural`"), source=spark.read.parquet(f"{sf_dir}/{source}.parquet"))


def oracle(body: str, *names: str) -> str:
    """The oracle's SQL: the fixtures as CTEs, then ``body`` (more CTEs and a SELECT, or a SELECT)."""
    head = ", ".join(f"{n} AS ({SQL[n]})" for n in names)
    body = body.strip()
    if not names:
        return body if body[:6].upper() == "SELECT" else f"WITH {body}"
    return f"WITH RECURSIVE {head}{' ' if body[:6].upper() == 'SELECT' else ', '}{body}"
