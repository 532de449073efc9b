"""Text, number and code scalars as column expressions; nulls in give nulls out unless said."""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
NULL_TOKENS = ["", "-", "BRAK", "NULL", "NONE", "NAN"]
ND_TOKENS = ["N/D", "ND", "N\\D", "N-D"]
YES_TOKENS = ["TAK", "YES", "Y"]
NO_TOKENS = ["NIE", "NO", "N"]
RISK_LABELS = {"low": 1, "high": 2}
POLISH = str.maketrans("ąćęłńóśźż", "acelnoszz")

SPACE = r"(?U)\s+"


def clean_text(c: Column) -> Column:
    """Runs of white space, no-break spaces too, become one space; trimmed; null gives ''."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " "))


def clean_or_null(c: Column) -> Column:
    """No-break spaces become spaces; trimmed; blank gives null."""
    return F.nullif(F.trim(F.replace(c, F.lit(" "), F.lit(" "))), F.lit(""))


def label_key(c: Column) -> Column:
    return F.lower(clean_text(c))


@functools.cache
def _plain_letters() -> dict[str, str]:
    """Lower-case letters beyond ASCII whose compatibility decomposition holds ASCII, and that part of it."""
    out = {}
    for letter in map(chr, range(128, sys.maxunicode + 1)):
        plain = unicodedata.normalize("NFKD", letter.translate(POLISH)).encode("ascii", "ignore").decode()
        if plain and letter == letter.lower():
            out[letter] = plain
    return out


def ascii_key(c: Column) -> Column:
    """Lower-case slug: letters are decomposed and lose what is not ASCII, other runs give one underscore."""
    single = {k: v for k, v in _plain_letters().items() if len(v) == 1}
    several = {k: v for k, v in _plain_letters().items() if len(v) > 1}
    text = F.translate(F.lower(clean_text(c)), "".join(single), "".join(single.values()))
    table = F.map_from_arrays(F.lit(list(several)), F.lit(list(several.values())))
    spelt = F.array_join(F.transform(F.split(text, ""), lambda x: F.coalesce(table[x], x)), "")
    plain = F.when(text.rlike(r"[^\x00-\x7f]"), F.regexp_replace(spelt, r"[^\x00-\x7f]+", "")).otherwise(text)
    return F.regexp_replace(F.regexp_replace(plain, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def key_token(c: Column) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, ""))


def is_null_token(c: Column) -> Column:
    """Blank or a word for nothing."""
    return key_token(c).isin(NULL_TOKENS)


def is_null_like(c: Column) -> Column:
    """Blank, a word for nothing, or N/D."""
    return key_token(c).isin([*NULL_TOKENS, *ND_TOKENS])


def is_nd(c: Column) -> Column:
    return key_token(c).isin(ND_TOKENS)


def yes_no_nd(c: Column) -> Column:
    """TAK, NIE or N/D; null where blank or a word for nothing; other text in upper case."""
    token = key_token(c)
    known = F.when(token.isin(YES_TOKENS), "TAK").when(token.isin(NO_TOKENS), "NIE").when(token.isin(ND_TOKENS), "N/D")
    return F.when(~is_null_token(c), F.coalesce(known, F.upper(clean_or_null(c))))


def status_flag(c: Column) -> Column:
    """1 for TAK, 0 for NIE, N/D, 0 and blank, null where unknown."""
    status = F.upper(clean_text(c))
    return F.when(status == "TAK", 1).when(status.isin("NIE", "N/D", "", "0"), 0).cast("bigint")


def parse_number(c: Column) -> Column:
    """Decimal-comma number; anything else null."""
    digits = F.replace(F.regexp_replace(c, SPACE, ""), F.lit(","), F.lit("."))
    return F.when(digits.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), digits.try_cast("double"))


def plain_number(c: Column) -> Column:
    """A number whose comma may stand for the point; unlike ``parse_number`` blanks inside make it none."""
    digits = F.replace(clean_text(c), F.lit(","), F.lit("."))
    return F.when(digits.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), digits.try_cast("double"))


def parse_failed(c: Column) -> Column:
    """A value that is neither blank nor N/D and no number."""
    return clean_or_null(c).isNotNull() & ~is_nd(c) & parse_number(c).isNull()


def parse_integer(c: Column) -> Column:
    return F.bround(parse_number(c)).cast("bigint")


def lenient_float(c: Column) -> Column:
    """First of a ``;`` list, comma or point, 0 where unreadable."""
    return F.coalesce(parse_number(F.element_at(F.split(c, ";"), 1)), F.lit(0.0))


def date_iso(c: Column) -> Column:
    """Day-first date as ISO text, '' where unreadable."""
    parsed = F.coalesce(*(F.expr("null").cast("date") if f is None else F.try_to_date(F.trim(c), f) for f in ("d.M.yyyy", "d/M/yyyy", "d-M-yyyy", "yyyy-MM-dd")))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), F.lit(""))


def round_step(c: Column, step: float) -> Column:
    return F.bround(c / step) * step


def display_value(c: Column) -> Column:
    """Whole numbers without point, others with two decimals at most, null as ''."""
    text = F.rtrim(F.format_string("%.2f", c), F.lit("0"))
    return F.when(c.isNull(), "").when(c == F.floor(c), F.floor(c).cast("string")).otherwise(F.rtrim(text, F.lit(".")))


def repair_text(c: Column) -> Column:
    """UTF-8 that was read as Latin-1 is read again; other text stays."""
    latin = F.when(c.rlike("[ÃÅÄ]") & c.rlike(r"^[\x{00}-\x{ff}]*$"), c)
    bytes_ = F.encode(latin, "ISO-8859-1").cast("string")
    return F.when(latin.isNotNull() & F.is_valid_utf8(bytes_), bytes_).otherwise(c)


def pad_code(c: Column, width: int = 7) -> Column:
    return F.lpad(c, width, "0")


def code_level(c: Column) -> Column:
    """Level of an administrative code by its length, null for other text."""
    return F.when(c.rlike("^[0-9]+$"), F.when(F.length(c) == 2, "woj").when(F.length(c) == 4, "pow").when(F.length(c) == 7, "gmi"))


def unit_name_key(c: Column) -> Column:
    """Name to compare: lower case, without the town prefix, single spaces."""
    return F.trim(F.regexp_replace(F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("m. "), F.lit("")), SPACE, " "))


def in_unit(code: Column, woj: Column, pow_: Column, gmi: Column) -> Column:
    """Whether ``code`` lies under the most specific code given."""
    prefix = F.coalesce(F.nullif(gmi, F.lit("")), F.nullif(pow_, F.lit("")), woj, F.lit(""))
    return F.startswith(code, prefix)


def half_even(value: Column, digits: int) -> Column:
    """Half to even as SQL's ``round_even`` has it: a tie is what binary arithmetic shows as one. ``bround`` decides on
    the shortest decimal, so it makes 1.02 of 1.015, which is less than its tie."""
    scale = 10.0**digits
    return F.rint(value * scale) / scale


def safe_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def pct(a: Column, b: Column) -> Column:
    return F.bround(safe_div(a * 100, b), 2)


def cost_per_person(cost: Column, people: Column) -> Column:
    return F.when(people <= 0, 0.0).otherwise(F.bround(F.try_divide(cost, people), 2))


def money(c: Column) -> Column:
    return F.bround(c).cast("bigint")


def risk_value(c: Column) -> Column:
    """1 or 2 by label, white space and case aside; else 0."""
    label = F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, ""))
    return F.when(label == "low", 1).when(label == "high", 2).otherwise(0)


def building_type(c: Column) -> Column:
    return F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit("unknown"))
