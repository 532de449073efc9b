"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Base kinds are e-mail addresses, IPv4 addresses (parts up to 255), card numbers
(13 to 19 digits, Luhn) and telephone numbers with a country code (9 to 15
digits): leftmost matches that don't overlap; a match that fails its test is
dropped. Base spans always stay. Three more proposals need evidence beyond their
form and are kept where their score reaches ``KEEP``:

==========  =========================================  ======  =========  ============
proposal    form                                       points  confirmed  by
==========  =========================================  ======  =========  ============
iban        country, two check digits, 11 to 30 more   40      +40        mod 97
card        a run of 13 to 19 digits by itself         30      +30        Luhn
phone       three groups of 3, 3 and 4 digits          40
==========  =========================================  ======  =========  ============

A word of the kind's list within ``NEAR`` code points before or ``AFTER`` behind
the span adds 30 points, a word that tells of other numbers takes 40 off. An
added span that overlaps a base span of its own kind is that span and isn't named twice.

Only DataFrame functions are used. A text is split at a pattern's matches; the
lengths of pieces and matches, summed up, are the spans' places. Sums run in
blocks, so work grows with the number of matches. Patterns start where a run
starts and take runs without backtracking (``++``), so a long run of one sort of
character costs its length, not its square, and loops need no stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import fresh, table

#: Patterns of the base kinds, in the order of output. ``\G`` lets a match begin where the last one ended.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Patterns of further proposals: whole runs, or between characters that no word has.
IBAN = r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9_])"
DIGITS = r"[0-9]++"
GROUPS = r"(?<![A-Za-z0-9_])[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![A-Za-z0-9_])"

KINDS = ["email", "ip", "card", "phone", "iban"]
KEEP, NEAR, AFTER = 70, 48, 24
#: Words near a span that speak for its kind.
CONTEXT = {
    "iban": "iban|bank|account|konto|cuenta|compte|transfer|bic|swift",
    "card": "card|credit|debit|visa|mastercard|amex|payment|karte|tarjeta|carte",
    "phone": "phone|tel|telephone|mobile|cell|fax|call|whatsapp|telefon|telefono|portable",
}
#: Words near a span that speak for a number of another sort.
OTHER = "isbn|issn|order|invoice|version|serial|sku|tracking|reference|hash|token"
#: Sums run over blocks of so many matches.
BLOCK = 128


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(lengths: Column) -> Column:
    """For each entry of an array of counts the sum of those before it, in blocks of ``BLOCK``."""
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")

    def prefix(values: Column, start: Column) -> Column:
        step = lambda acc, v: F.struct((acc["at"] + v).alias("at"), F.concat(acc["before"], F.array(acc["at"])).alias("before"))
        return F.aggregate(values, F.struct(start.alias("at"), none.alias("before")), step, lambda acc: acc["before"])

    def whole(values: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(values) - 1) / BLOCK)).cast("int"))
        cut = F.transform(blocks, lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)))
        return let(cut, lambda parts: let(prefix(F.transform(parts, lambda p: F.aggregate(p, zero, lambda a, v: a + v)), zero), lambda starts: F.flatten(F.zip_with(parts, starts, prefix))))

    return let(F.transform(lengths, lambda n: n.cast("long")), whole)


def matches(text: Column, pattern: str, gate: Column) -> Column:
    """Array of (at, upto, value): leftmost matches that don't overlap, in code points, none where ``gate`` fails."""
    span = "array<struct<at:bigint,upto:bigint,value:string>>"

    def places(found: Column, pieces: Column) -> Column:
        # a match stands behind its piece; the sum before counts earlier pieces with their matches
        steps = F.zip_with(found, pieces, lambda m, p: F.coalesce(F.char_length(m), F.lit(0)) + p)
        starts = F.zip_with(sums_before(steps), pieces, lambda b, p: b + p)
        first = F.slice(starts, F.lit(1), F.size(found))
        return F.zip_with(found, first, lambda m, s: F.struct(s.alias("at"), (s + F.char_length(m)).alias("upto"), m.alias("value")))

    found = F.when(gate, F.regexp_extract_all(text, F.lit(pattern), 0))
    pieces = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p))
    return let(found, lambda m: F.when(F.size(m) > 0, let(pieces, lambda p: places(m, p))).otherwise(F.array().cast(span)))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """13 to 19 digits whose last one is Luhn's check digit."""
    digits = digits_of(value)
    return F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)


def mod97(value: Column) -> Column:
    """15 to 34 characters that leave 1 as an IBAN does: the first four moved behind, letters read as 10 to 35."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substr(bare, F.lit(5)), F.substring(bare, 1, 4)), "")
    figure = lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    step = lambda rest, c: F.when(c == "", rest).otherwise(F.pmod(rest * F.when(c >= "A", 100).otherwise(10) + figure(c), F.lit(97)))
    return F.length(bare).between(15, 34) & (F.aggregate(turned, F.lit(0), step) == 1)


def context_points(text: Column, span: Column, kind: str) -> Column:
    """30 for a word of the kind nearby, 40 less for a word of other numbers."""
    first = F.greatest(span["at"] - NEAR, F.lit(0))
    before = F.substr(text, first + 1, span["at"] - first)
    near = F.concat(before, F.lit(" "), F.substr(text, span["upto"] + 1, F.lit(AFTER)))
    told = lambda words: F.when(near.rlike(rf"(?i)(?<![A-Za-z])(?:{words})(?![A-Za-z])"), 1).otherwise(0)
    return 30 * told(CONTEXT[kind]) - 40 * told(OTHER)


def _small(part: Column) -> Column:
    """Digits whose value is 255 at most, whatever zeros lead."""
    return (F.length(F.ltrim(part, F.lit("0"))) <= 3) & (F.right(part, F.lit(3)).cast("int") <= 255)


def _base(text: Column) -> dict[str, Column]:
    """Confirmed base spans by kind."""
    figures = text.rlike("[0-9]")
    return {
        "email": matches(text, EMAIL, text.contains("@")),
        "ip": F.filter(matches(text, IP, text.rlike(r"[0-9]\.[0-9]")), lambda m: F.forall(F.split(m["value"], r"\."), _small)),
        "card": F.filter(matches(text, CARD, figures), lambda m: luhn(m["value"])),
        "phone": F.filter(matches(text, PHONE, text.contains("+")), lambda m: F.length(digits_of(m["value"])).between(9, 15)),
    }


def _proposals(text: Column) -> dict[str, Column]:
    """Further spans that no check refutes, by kind, with their score."""

    def scored(found: Column, kind: str, points: int) -> Column:
        score = lambda m: (points + context_points(text, m, kind)).cast("int")
        return F.transform(found, lambda m: F.struct(m["at"].alias("at"), m["upto"].alias("upto"), m["value"].alias("value"), score(m).alias("score")))

    accounts = F.filter(matches(text, IBAN, text.rlike("[A-Z]{2}[0-9]{2}")), lambda m: mod97(m["value"]))
    runs = F.filter(matches(text, DIGITS, text.rlike("[0-9]{13}")), lambda m: luhn(m["value"]))
    groups = matches(text, GROUPS, text.rlike("[0-9]{3}[ .-][0-9]{4}"))
    return {"iban": scored(accounts, "iban", 80), "card": scored(runs, "card", 60), "phone": scored(groups, "phone", 40)}


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii") -> DataFrame:
    """``docs`` with ``out_col``: an array of (kind, at, upto, value, score, base), by kind as ``KINDS``
    lists them, then by place; ``upto`` is exclusive, both count code points. Base spans score 100.

    A null or empty text has an empty array. Rows pass through as they are, repeated
    rows each with their spans; no rows give no rows. A column of the name ``out_col``
    is replaced; no other column is read or changed.
    """
    name = fresh(docs.columns, [out_col])
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = {kind: (name(f"base_{kind}"), spans) for kind, spans in _base(text).items()}
    more = {kind: (name(f"more_{kind}"), spans) for kind, spans in _proposals(text).items()}
    rows = docs.withColumns(dict([*base.values(), *more.values()]))

    def out(kind: str, spans: Column, is_base: bool) -> Column:
        score = lambda m: F.lit(100) if is_base else m["score"]
        fields = lambda m: (F.lit(kind).alias("kind"), m["at"].alias("at"), m["upto"].alias("upto"), m["value"].alias("value"), score(m).alias("score"), F.lit(is_base).alias("base"))
        return F.transform(spans, lambda m: F.struct(*fields(m)))

    def of(kind: str) -> Column:
        if kind not in more:
            return out(kind, F.col(base[kind][0]), True)
        added = F.filter(more[kind][0], lambda m: m["score"] >= KEEP)
        if kind not in base:
            return out(kind, added, False)
        known = F.col(base[kind][0])
        new = F.filter(added, lambda m: ~F.array_contains(known["at"], m["at"]))  # most are base spans themselves
        new = F.filter(new, lambda m: ~F.exists(known, lambda k: (k["at"] < m["upto"]) & (m["at"] < k["upto"])))
        both = F.concat(out(kind, known, True), out(kind, new, False))
        # within a kind spans don't overlap, so the place tells them apart
        return F.array_sort(both, lambda a, b: F.when(a["at"] < b["at"], -1).when(a["at"] > b["at"], 1).otherwise(0))

    helpers = [column for column, _ in [*base.values(), *more.values()]]
    return rows.withColumn(out_col, F.concat(*[of(k) for k in KINDS])).drop(*helpers)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with each span of its text replaced by its kind in brackets, as in ``[email]``.

    Of spans that overlap, the one that begins first is named and the cut runs to
    the end of the last; of spans that begin together, the longest is named. Null texts stay null.
    """
    name = fresh(docs.columns)
    pii, text = name("pii"), F.col(text_col)
    order = lambda a, b: F.when(a["at"] < b["at"], -1).when(a["at"] > b["at"], 1).when(a["upto"] > b["upto"], -1).when(a["upto"] < b["upto"], 1).otherwise(0)

    def cut(spans: Column) -> Column:
        reach = lambda i: F.array_max(F.transform(F.slice(spans, F.lit(1), i), lambda s: s["upto"]))
        places = F.sequence(F.lit(0), F.size(spans) - 1)
        ends = F.transform(places, lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(reach(F.greatest(i, F.lit(1)))))

        def piece(i: Column, end: Column) -> Column:
            s = F.get(spans, i)
            return F.when(s["at"] < end, F.lit("")).otherwise(F.concat(F.substr(text, end + 1, s["at"] - end), F.lit("["), s["kind"], F.lit("]")))

        return F.concat(F.array_join(F.zip_with(places, ends, piece), ""), F.substr(text, reach(F.size(spans)) + 1))

    found = find_pii(docs, text_col, pii).withColumn(pii, F.array_sort(F.col(pii), order))
    return found.withColumn(text_col, F.when(F.size(pii) > 0, let(F.col(pii), cut)).otherwise(text)).drop(pii)


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents", "doc_id", "text"))
    line = lambda s: F.concat_ws(":", s["kind"], s["at"].cast("string"), s["upto"].cast("string"))
    joined = lambda spans: F.array_join(F.transform(spans, line), ",")
    base = F.filter("pii", lambda s: s["base"])
    count = lambda kind: F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(kind) for kind in KINDS[:4]], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("pii")).alias("spans"))


def _places(kind: str, pattern: str, gate: str = "true") -> str:
    """SQL for (doc_id, kind, pos, upto, value) of a pattern's matches."""
    return f"""
  SELECT row, kind, value, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: length(x))), 0) AS pos
  FROM (SELECT row, '{kind}' AS kind, m, p, unnest(m) AS value, generate_subscripts(m, 1) AS i
        FROM (SELECT row, regexp_extract_all(text, '{pattern}') AS m, regexp_split_to_array(text, '{pattern}') AS p FROM t WHERE {gate}))"""


ORACLE = rf"""
WITH t AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({_places("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")} UNION ALL {_places("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")}
  UNION ALL {_places("card", r"[0-9](?:[ -]?[0-9])+")} UNION ALL {_places("phone", r"\+[0-9][ ().0-9-]+[0-9]")}
  UNION ALL {_places("iban+", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b")} UNION ALL {_places("card+", r"[0-9]+")}
  UNION ALL {_places("phone+", r"\b[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}\b")}),
f AS (SELECT row, kind, pos::BIGINT AS pos, pos::BIGINT + length(value) AS upto, value, regexp_replace(value, '[^0-9]', '', 'g') AS digits FROM found),
c AS (
  SELECT *, length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length(digits)), lambda i:
           CASE WHEN i % 2 = 0 THEN digits[(length(digits) - i)::BIGINT]::INT
                ELSE digits[(length(digits) - i)::BIGINT]::INT * 2 - CASE WHEN digits[(length(digits) - i)::BIGINT]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0 AS luhn,
         replace(value, ' ', '') AS bare FROM f),
k AS (
  SELECT row, kind, pos, upto FROM c WHERE kind = 'email' OR kind = 'card' AND luhn OR kind = 'phone' AND length(digits) BETWEEN 9 AND 15
      OR kind = 'ip' AND list_bool_and(list_transform(string_split(CASE WHEN kind = 'ip' THEN value ELSE '0' END, '.'), lambda x: length(ltrim(x, '0')) <= 3 AND right(x, 3)::INT <= 255))),
near AS (
  SELECT c.*, substring(text, greatest(pos - {NEAR}, 0) + 1, pos - greatest(pos - {NEAR}, 0)) || ' ' || substring(text, upto + 1, {AFTER}) AS near
  FROM c JOIN t USING (row)
  WHERE kind = 'phone+' OR kind = 'card+' AND luhn OR kind = 'iban+' AND length(bare) BETWEEN 15 AND 34
    AND list_reduce(list_concat([0], list_transform(string_split(bare[5:] || bare[1:4], ''), lambda x: CASE WHEN x = '' THEN 0 WHEN x >= 'A' THEN ascii(x) - 55 ELSE ascii(x) - 48 END)),
        lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97) = 1),
s AS (
  SELECT row, kind[:-2] AS kind, pos, upto,
         CASE kind WHEN 'iban+' THEN 80 WHEN 'card+' THEN 60 ELSE 40 END
         + 30 * regexp_matches(near, '(?i)(^|[^A-Za-z])(' || CASE kind WHEN 'iban+' THEN '{CONTEXT["iban"]}' WHEN 'card+' THEN '{CONTEXT["card"]}' ELSE '{CONTEXT["phone"]}' END || ')([^A-Za-z]|$)')::INT
         - 40 * regexp_matches(near, '(?i)(^|[^A-Za-z])({OTHER})([^A-Za-z]|$)')::INT AS score
  FROM near),
added AS (SELECT row, kind, pos, upto FROM s WHERE score >= {KEEP} AND NOT EXISTS (FROM k WHERE k.row = s.row AND k.kind = s.kind AND k.pos < s.upto AND s.pos < k.upto)),
o AS (SELECT *, list_position(['email', 'ip', 'card', 'phone', 'iban'], kind) AS place, kind || ':' || pos || ':' || upto AS line
      FROM (SELECT *, true AS base FROM k UNION ALL SELECT *, false FROM added)),
g AS (
  SELECT row, count(*) FILTER (base AND kind = 'email') AS n_email, count(*) FILTER (base AND kind = 'ip') AS n_ip,
         count(*) FILTER (base AND kind = 'card') AS n_card, count(*) FILTER (base AND kind = 'phone') AS n_phone,
         string_agg(line, ',' ORDER BY place, pos) FILTER (base) AS of_base, string_agg(line, ',' ORDER BY place, pos) AS spans FROM o GROUP BY row)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
       sha256(coalesce(of_base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN g USING (row)
"""
