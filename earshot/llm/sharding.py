"""Sharding by proportional stratified interleaving.

Rows are shuffled with a seed and ranked within their source. A row of rank r
(from 1) in a source of n rows gets the fraction ``(r - u) / n``, where ``u`` in
[0, 1) is the source's own fixed offset: the rows of each source lie evenly
between 0 and 1, and small sources do not all meet in the middle. Sorting by the
fraction interleaves the sources in proportion; equal cuts give shards whose row
counts differ by at most one and whose mixture is that of the whole.

Neither rank is a window over a whole source or table: rows go to buckets of a
bounded expected size (by hash, then by fraction), are numbered inside the
bucket, and the bucket's offset is added. Offsets are sums over buckets in two
levels: within groups of ``GROUP`` buckets, and over the groups, so the largest
table that one task sums up in order has a row for every ``GROUP * BUCKET_ROWS``
rows of a stratum. Texts are never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earshot.llm.common import broadcast_if_small, materialize, table
from earshot.operators import ranks

SHARDS, SEED, BUCKET_ROWS, GROUP = 8, "2026", 1_024, 4_096
#: Up to so many different repeated rows (about 80 bytes each) are broadcast.
BROADCAST_COPIES = 300_000


def _hex_fraction(text: Column, digits: int = 8) -> Column:
    """A number in [0, 1) from the first hex digits of an MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("double") / float(16**digits)


def _numbered(rows: DataFrame, strata: list[str], bucket: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: the position from 0 within the strata, ordered by bucket, then ``order``."""
    sizes = rows.groupBy(*strata, bucket).agg(F.count(F.lit(1)).alias("__n"))
    sizes = materialize(sizes.withColumn("__group", F.floor(F.col(bucket) / GROUP)), "sizes")

    def before(n: str, keys: list[str], order: str) -> Column:
        return F.coalesce(F.sum(n).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    groups = sizes.groupBy(*strata, "__group").agg(F.sum("__n").alias("__g")).withColumn("__lead", before("__g", strata, "__group")).drop("__g")
    starts = sizes.withColumn("__own", before("__n", [*strata, "__group"], bucket)).join(groups, [*strata, "__group"])
    starts = materialize(starts.select(*strata, bucket, (F.col("__lead") + F.col("__own")).alias("__start")), "starts")
    place = F.row_number().over(Window.partitionBy(*strata, bucket).orderBy(*order)) - 1
    return rows.withColumn("__place", place).join(starts, [*strata, bucket]).withColumn(name, F.col("__start") + F.col("__place")).drop("__start", "__place")


def _counted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copy``: numbers from 0 among rows that are equal in all columns. Only repeated rows are numbered,
    over range partitions, so copies that are a third of all rows are numbered by many tasks."""
    keys = rows.columns
    same = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").drop("__n").withColumnsRenamed({k: f"__{k}" for k in keys})
    same = materialize(same, "copies")
    n = same.count()
    if not n:
        return rows.withColumn("copy", F.lit(0).cast("bigint"))
    equal = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    known = broadcast_if_small(same, n, BROADCAST_COPIES)
    again = materialize(rows.join(known, equal, "left_semi").withColumn("__row", F.monotonically_increasing_id()), "copied-rows")
    placed = materialize(ranks.row_number(again, [*(F.asc_nulls_first(k) for k in keys), F.col("__row")], "__at"), "numbered-copies")
    first = placed.groupBy(*keys).agg(F.min("__at").alias("__first")).withColumnsRenamed({k: f"__{k}" for k in keys})
    numbered = placed.join(broadcast_if_small(first, n, BROADCAST_COPIES), equal).select(*keys, (F.col("__at") - F.col("__first")).alias("copy"))
    return rows.join(known, equal, "left_anti").withColumn("copy", F.lit(0).cast("bigint")).unionByName(numbered)


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, source, rank, fraction, shard, slot.

    ``size`` is the text's UTF-8 bytes plus 1 (a null text has none, so 1) and
    its crc32 that of the empty text. A null source is a source of its own, named ''.
    Rows are told apart by id, size and crc32, and rows that repeat all of them by a
    number among themselves (they are interchangeable); all of it goes into the draw, so
    neither null ids nor copies of one row meet in a bucket. Null ids are shuffled as ''.
    An empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
    )
    rows = materialize(_counted(materialize(rows, "shard-rows")), "shard-draws")
    parts = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), *(F.col(c).cast("string") for c in ("size", "text_crc32", "copy"))]
    rows = rows.withColumn("draw", F.md5(F.concat_ws("/", F.lit(seed), *parts).cast("binary"))).drop("copy")
    total = rows.count()
    buckets = max(1, total // bucket_rows)
    totals = materialize(rows.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "sources")
    head = F.conv(F.substring("draw", 1, 8), 16, 10).cast("double") / float(16**8)
    ranked = _numbered(rows.withColumn("bucket", F.floor(head * buckets)), ["source"], "bucket", ["draw", "doc_id", "size", "text_crc32"], "before")
    fraction = (F.col("before") + 1 - _hex_fraction(F.col("source"))) / F.col("n")
    spread = materialize(ranked.join(totals, "source").withColumn("fraction", fraction).drop("bucket", "n"), "spread")
    spread = spread.withColumn("bucket", F.least(F.floor(F.col("fraction") * buckets), F.lit(buckets - 1)))
    order = ["fraction", "source", "draw", "doc_id", "size", "text_crc32"]
    placed = _numbered(spread, [], "bucket", order, "position")
    cut = F.expr(f"position * {shards} div {max(1, total)}")
    start = F.expr(f"({max(1, total)} * shard + {shards - 1}) div {shards}")
    return placed.withColumn("shard", cut.cast("int")).select(
        "doc_id", "size", "text_crc32", "source", (F.col("before") + 1).alias("rank"), "fraction", "shard", (F.col("position") - start).alias("slot")
    )


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


ORACLE = """
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, i:
         CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size,
         coalesce(source, '') AS source,
         xor(list_reduce(list_concat([4294967295], list_transform(range(octet_length(encode(coalesce(text, '')))),
             lambda i: ('0x' || substr(hex(encode(text)), (2 * i + 1)::BIGINT, 2))::BIGINT)),
             lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc),
e AS (
  SELECT *, md5('2026/' || coalesce(doc_id::VARCHAR, '') || '/' || size || '/' || text_crc32::BIGINT || '/' || row_number() OVER (PARTITION BY doc_id, size, text_crc32, source) - 1) AS draw FROM d),
r AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY draw, doc_id, size, text_crc32) AS rank,
         count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM e),
p AS (
  SELECT *, row_number() OVER (ORDER BY
         (rank::DOUBLE - ('0x' || substr(md5(source), 1, 8))::BIGINT::DOUBLE / 4294967296::DOUBLE) / n::DOUBLE,
         source, draw, doc_id, size, text_crc32) - 1 AS position FROM r),
s AS (SELECT *, position * 8 // total AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard,
       (position - (total * shard + 7) // 8)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM s
"""
