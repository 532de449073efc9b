"""Line de-duplication over overlapping three-line windows.

Each run of three consecutive lines is hashed (128 bits). A window found more
than once keeps its first occurrence in (doc_id, line) order; every later
occurrence covers its three lines, covered positions are merged per document and
those lines go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm.common import fresh, materialize, table

WINDOW = 3


def windows(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, body, pos, w1, w2): one row per window that has a non-blank line."""
    lines = F.split(F.col("text"), "\n", -1)
    at = F.sequence(F.lit(0), F.size("lines") - size)
    one = F.transform(
        at,
        lambda i: F.struct(i.alias("pos"), F.array_join(F.slice("lines", i + 1, size), "\n").alias("span")),
    )
    return (
        docs.where("text is not null")
        .select("doc_id", F.xxhash64("text").alias("body"), lines.alias("lines"))
        .where(F.size("lines") >= size)
        .select("doc_id", "body", F.explode(one).alias("w"))
        .where(F.trim(F.translate("w.span", "\n\t\r", "")) != "")
        .select("doc_id", "body", "w.pos", F.xxhash64("w.span").alias("w1"), F.xxhash64(F.lit(7), "w.span").alias("w2"))
    )


def covered_positions(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, body, covered): line positions under a later occurrence.
    ``docs`` has doc_id and text; ``body`` hashes the text, so rows that share an
    id but not a text stay apart."""
    found = windows(docs, size)
    first = (
        found.groupBy("w1", "w2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "pos", "body")).alias("first"))
        .where("n > 1")
        .select("w1", "w2", "first")
    )
    first = materialize(first, "line-windows")
    later = found.join(first, ["w1", "w2"]).where(~F.struct("doc_id", "pos", "body").eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "body").agg(F.collect_set("pos").alias("starts"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """``docs`` with repeated windows cut out of ``text_col``, plus ``removed_lines``.

    A text of fewer than three lines has no window and never changes; a window
    of blank lines never counts; null stays null; a text that loses every line
    becomes empty, its row stays. Rows that repeat id and text are one document:
    they count as one occurrence and get the same result. Columns of any name
    pass through; one already called removed_lines is replaced.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    name = fresh(docs.columns, ["removed_lines"])
    key, id_, body, starts, split, count = (name(n) for n in ("key", "id", "body", "starts", "lines", "count"))
    cover = covered_positions(slim, size).select(F.col("doc_id").alias(id_), F.col("body").alias(body), F.col("starts").alias(starts))
    keyed = docs.withColumn(key, F.xxhash64(F.col(text_col)))
    joined = keyed.join(cover, F.col(id_col).eqNullSafe(F.col(id_)) & (F.col(key) == F.col(body)) & F.col(text_col).isNotNull(), "left")
    lines = F.split(F.col(text_col), "\n", -1)
    gone = F.array_distinct(F.flatten(F.transform(starts, lambda p: F.sequence(p, p + size - 1))))
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone))
    text = F.array_join(F.transform(stay, lambda i: F.get(F.col(split), i)), "\n")
    names = [c for c in docs.columns if c.lower() != "removed_lines"]
    return (
        joined.withColumn(split, F.when(F.col(starts).isNotNull(), lines))
        .withColumn(count, F.when(F.col(starts).isNotNull(), F.size(gone)).otherwise(0).cast("long"))
        .withColumn(text_col, F.when(F.col(starts).isNotNull(), text).otherwise(F.col(text_col)))
        .select(*names, F.col(count).alias("removed_lines"))
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "removed_lines")


ORACLE = r"""
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, unnest(range(len(lines) - 2)) AS pos, lines FROM l WHERE len(lines) >= 3),
s AS (SELECT doc_id, pos, array_to_string(lines[pos + 1 : pos + 3], chr(10)) AS span FROM w),
r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY span ORDER BY doc_id, pos) AS k FROM s
      WHERE trim(translate(span, chr(10) || chr(9) || chr(13), '')) <> ''),
c AS (SELECT DISTINCT doc_id, pos + d AS pos FROM r, (VALUES (0), (1), (2)) v(d) WHERE k > 1),
e AS (SELECT doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM l),
k AS (SELECT e.doc_id, string_agg(CASE WHEN c.pos IS NULL THEN line END, chr(10) ORDER BY e.pos) AS text,
             count(c.pos) AS removed_lines FROM e LEFT JOIN c USING (doc_id, pos) GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(k.text, '') AS text, coalesce(k.removed_lines, 0)::BIGINT AS removed_lines
FROM documents d LEFT JOIN k USING (doc_id)
"""
