"""SCL: scalars over documents and register text."""

from __future__ import annotations

from pyspark.sql import functions as F

from earshot.functions import scalars as S
from earshot.plans.registry import query

# the oracle's words for the same thing
WS = "[\\s\u00a0]+"
TOKEN = rf"upper(regexp_replace(coalesce({{0}}, ''), '{WS}', '', 'g'))"
NUMBER = r"CASE WHEN regexp_full_match({0}, '[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?') THEN try_cast({0} AS DOUBLE) END"
DIGITS = rf"replace(regexp_replace(num, '{WS}', '', 'g'), ',', '.')"
_NUM = NUMBER.format(DIGITS)
_STATUS = TOKEN.format("status")
YES, NO, ND = "('TAK', 'YES', 'Y')", "('NIE', 'NO', 'N')", "('N/D', 'ND', 'N\\D', 'N-D')"
NULLS = "('', '-', 'BRAK', 'NULL', 'NONE', 'NAN')"
CLEAN = "nullif(trim(replace({0}, chr(160), ' ')), '')"


def tri(name: str) -> str:
    token = TOKEN.replace("{0}", name)
    return f"CASE WHEN {token} IN {NULLS} THEN NULL WHEN {token} IN {YES} THEN 'TAK' WHEN {token} IN {NO} THEN 'NIE' WHEN {token} IN {ND} THEN 'N/D' ELSE upper({CLEAN.replace('{0}', name)}) END"


def flag(name: str) -> str:
    return f"CASE WHEN upper(trim(regexp_replace(coalesce({name}, ''), '{WS}', ' ', 'g'))) = 'TAK' THEN 1 WHEN upper(trim(regexp_replace(coalesce({name}, ''), '{WS}', ' ', 'g'))) IN ('NIE', 'N/D', '', '0') THEN 0 END::BIGINT"


def slug(name: str) -> str:
    plain = f"regexp_replace(strip_accents(translate(lower(trim(regexp_replace(coalesce({name}, ''), '{WS}', ' ', 'g'))), 'ąćęłńóśźż', 'acelnoszz')), '[^\\x00-\\x7f]+', '', 'g')"
    return f"regexp_replace(regexp_replace({plain}, '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')"


def shown(x: str) -> str:
    return f"CASE WHEN ({x}) IS NULL THEN '' WHEN ({x}) = floor({x}) THEN ({x})::BIGINT::VARCHAR ELSE rtrim(rtrim(printf('%.2f', ({x})::DOUBLE), '0'), '.') END"


def _scalar(name: str, sql: str, make):
    @query(name, f"SELECT doc_id, {sql} AS value FROM fx_text", "fx_text")
    def _(t):
        return t.fx_text.select("doc_id", make().alias("value"))


c = F.col
_scalar("scl01_clean_text", f"trim(regexp_replace(coalesce(raw, ''), '{WS}', ' ', 'g'))", lambda: S.clean_text(c("raw")))
_scalar("scl02_clean_or_null", "nullif(trim(replace(status, chr(160), ' ')), '')", lambda: S.clean_or_null(c("status")))
_scalar("scl03_label_key", f"lower(trim(regexp_replace(coalesce(raw, ''), '{WS}', ' ', 'g')))", lambda: S.label_key(c("raw")))
_scalar(
    "scl04_ascii_key",
    slug("place"),
    lambda: S.ascii_key(c("place")),
)
_scalar("scl05_key_token", TOKEN.format("raw"), lambda: S.key_token(c("raw")))
_scalar("scl06_null_tests", f"(CASE WHEN {_STATUS} IN {NULLS} OR {_STATUS} IN {ND} THEN 1 ELSE 0 END + CASE WHEN {_STATUS} IN {ND} THEN 2 ELSE 0 END)::INTEGER",
        lambda: S.is_null_like(c("status")).cast("int") + S.is_nd(c("status")).cast("int") * 2)
_scalar("scl07_yes_no_nd", tri("status"), lambda: S.yes_no_nd(c("status")))
_scalar("scl08_status_flag", flag("status"), lambda: S.status_flag(c("status")))


@query(
    "scl09_parse_number",
    f"SELECT doc_id, {_NUM} AS value, {CLEAN.format('num')} IS NOT NULL AND {TOKEN.format('num')} NOT IN {ND} AND ({_NUM}) IS NULL AS failed FROM fx_text",
    "fx_text",
)
def scl09(t):
    return t.fx_text.select("doc_id", S.parse_number(c("num")).alias("value"), S.parse_failed(c("num")).alias("failed"))


_scalar("scl10_parse_integer", f"round_even({_NUM}, 0)::BIGINT", lambda: S.parse_integer(c("num")))
_scalar("scl11_lenient_float", "coalesce(" + NUMBER.format(f"replace(regexp_replace(split_part(num, ';', 1), '{WS}', '', 'g'), ',', '.')") + ", 0)", lambda: S.lenient_float(c("num")))
_scalar(
    "scl12_date_iso",
    "coalesce(strftime(coalesce(try_strptime(trim(day), '%d.%m.%Y'), try_strptime(trim(day), '%d/%m/%Y'), try_strptime(trim(day), '%d-%m-%Y'), try_strptime(trim(day), '%Y-%m-%d')), '%Y-%m-%d'), '')",
    lambda: S.date_iso(c("day")),
)
_scalar("scl13_round_step", "round_even(v / 0.5e0, 0) * 0.5e0", lambda: S.round_step(c("v"), 0.5))
_scalar(
    "scl14_display_value",
    "CASE WHEN v IS NULL THEN '' WHEN v = floor(v) THEN floor(v)::BIGINT::VARCHAR ELSE rtrim(rtrim(printf('%.2f', floor(v * 4) / 4), '0'), '.') END",
    lambda: S.display_value(F.when(c("v") == F.floor("v"), c("v")).otherwise(F.floor(c("v") * 4) / 4)),
)
_scalar("scl16_code_parts", "lpad(code, 7, '0') || '/' || substr(lpad(code, 7, '0'), 1, 2) || '/' || substr(lpad(code, 7, '0'), 1, 4)",
        lambda: F.concat_ws("/", S.pad_code(c("code")), F.substring(S.pad_code(c("code")), 1, 2), F.substring(S.pad_code(c("code")), 1, 4)))
_scalar("scl17_code_level", "CASE WHEN regexp_full_match(code, '[0-9]+') THEN CASE length(code) WHEN 2 THEN 'woj' WHEN 4 THEN 'pow' WHEN 7 THEN 'gmi' END END",
        lambda: S.code_level(c("code")))
_scalar("scl18_unit_name", f"trim(regexp_replace(replace(lower(coalesce(place, '')), 'm. ', ''), '{WS}', ' ', 'g'))", lambda: S.unit_name_key(c("place")))
_scalar(
    "scl19_in_unit",
    "starts_with(lpad(code, 7, '0'), coalesce(nullif(CASE WHEN k > 5 THEN '0000007' ELSE '' END, ''), nullif(CASE WHEN k > 2 THEN '0001' ELSE '' END, ''), '00'))",
    lambda: S.in_unit(S.pad_code(c("code")), F.lit("00"), F.when(c("k") > 2, "0001").otherwise(""), F.when(c("k") > 5, "0000007").otherwise("")),
)
_scalar("scl20_safe_pct", "CASE WHEN k = 0 THEN 0 ELSE round_even(n * 100 / k::DOUBLE, 2) END::DOUBLE", lambda: S.pct(c("n"), c("k")))
_scalar("scl21_cost_per_person", "CASE WHEN k <= 0 THEN 0 ELSE round_even(n * 1000 / k::DOUBLE, 2) END::DOUBLE", lambda: S.cost_per_person(c("n") * 1000, c("k")))
_scalar("scl22_money", "round_even(v * 4, 0)::BIGINT", lambda: S.money(c("v") * 4))
_scalar("scl23_risk_value", "CASE k % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END::INTEGER",
        lambda: S.risk_value(F.when(c("k") % 4 == 0, " Low ").when(c("k") % 4 == 1, "HI GH").otherwise("none")))
_scalar("scl24_building_type", "coalesce(nullif(lower(trim(status)), ''), 'unknown')", lambda: S.building_type(c("status")))


@query(
    "scl15_repair_text",
    """h AS (SELECT doc_id, coalesce(text, '') AS whole, hex(encode(coalesce(text, ''))) AS hx FROM documents),
    b AS (SELECT doc_id, whole, array_to_string(list_transform(range(len(hx) // 2), lambda i: chr(('0x' || hx[2 * i + 1 : 2 * i + 2])::INTEGER)), '') AS broken FROM h)
    SELECT doc_id, CASE WHEN regexp_matches(broken, '[ÃÅÄ]') THEN whole ELSE broken END AS value FROM b""",
)
def scl15(t):
    """Text broken on purpose (UTF-8 bytes read as Latin-1) is made whole; the tests compare both."""
    text = F.coalesce("text", F.lit(""))
    return t.documents.select("doc_id", S.repair_text(F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")).alias("value"))
