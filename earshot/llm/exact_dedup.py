"""Exact de-duplication with an extendible-hash index kept in shared files.

The index is keyed by a 64-bit hash of the text. Its directory maps key prefixes
to buckets: buckets start at the depth that the number of keys asks for, and one
that holds more than ``bucket_entries`` keys is split by one more key bit, again
and again, with no limit but the bits of the key. Where a bucket at the greatest
depth is split, the directory doubles; slots whose bucket was not split share it.

Buckets are dealt to owner tasks in order of their first key, so an owner has a
range of keys and every bucket lies in one file of the index. Keys that one row has
come to their owner without a text. Of keys that several rows have the owner gets
each distinct text once and compares them byte for byte: where a key has over one
text, they are chained, an entry for each. Every row then reads its class off the
index: by bucket and key, and in a chain by comparing its text.

Nothing gathers a group: largest ids and counts are combined before the exchange,
so a text that a third of all rows share comes to its owner as one row. Only
DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earshot.llm.common import broadcast_if_small, materialize, table

BUCKET_ENTRIES = 65_536
#: Directories of at most so many slots (about 60 bytes each) are broadcast; larger ones are joined by a shuffle.
BROADCAST_SLOTS = 500_000
#: Up to so many repeated keys (about 60 bytes each) are broadcast to pick their rows; beyond, equal texts are combined first.
BROADCAST_KEYS = 1_000_000
KEY_BITS = 64


def _prefix(key: Column, depth: int) -> Column:
    """The top ``depth`` bits of a 64-bit key."""
    return F.shiftrightunsigned(key, KEY_BITS - depth) if depth else F.lit(0).cast("long")


def _low(prefix: Column, depth: int) -> Column:
    """The first key with the prefix: it names the bucket."""
    return F.shiftleft(prefix, KEY_BITS - depth) if depth else prefix


def directory(keys: DataFrame, bucket_entries: int = BUCKET_ENTRIES) -> tuple[DataFrame, int]:
    """((bucket, depth) of all buckets, the depth they started at). ``keys`` has distinct keys.
    A round splits the overfull buckets of one depth and reads their keys only."""
    n = keys.count()
    depth = start = max(0, math.ceil(math.log2(max(1, n) / bucket_entries)))
    done, left = [], keys
    while True:
        sizes = left.groupBy(_prefix(F.col("key"), depth).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
        sizes = materialize(sizes, "bucket-sizes")
        full = sizes.where((F.col("n") > bucket_entries) & F.lit(depth < KEY_BITS)).select("prefix")
        fits = sizes.join(full, "prefix", "left_anti") if depth < KEY_BITS else sizes
        done.append(fits.select(_low(F.col("prefix"), depth).alias("bucket"), F.lit(depth).alias("depth")))
        if full.isEmpty():
            return materialize(reduce(DataFrame.unionByName, done), "directory"), start
        left = materialize(left.withColumn("prefix", _prefix(F.col("key"), depth)).join(full, "prefix", "left_semi").select("key"), "overfull-keys")
        depth += 1


def with_bucket(rows: DataFrame, buckets: DataFrame, start: int) -> DataFrame:
    """``rows``, which have a key, with the bucket that the directory names for it."""
    slots = buckets.groupBy(_prefix(F.col("bucket"), start).alias("slot")).agg(F.collect_list(F.struct("bucket", "depth")).alias("buckets"))
    slots = materialize(slots, "slots")
    slots = broadcast_if_small(slots, slots.count(), BROADCAST_SLOTS)
    # a shift by all 64 bits would shift by none, so depth 0 is told apart
    held = F.expr("filter(buckets, b -> b.depth = 0 or shiftrightunsigned(key, 64 - b.depth) = shiftrightunsigned(b.bucket, 64 - b.depth))")
    return rows.withColumn("slot", _prefix(F.col("key"), start)).join(slots, "slot").withColumn("bucket", F.get(held, F.lit(0))["bucket"]).drop("slot", "buckets")


def owned(entries: DataFrame, buckets: DataFrame) -> DataFrame:
    """``entries`` dealt to the owners of their buckets: key ranges, one task each."""
    tasks = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entries.repartitionByRange(max(1, min(tasks, buckets.count())), "bucket")


def build_index(rows: DataFrame, bucket_entries: int = BUCKET_ENTRIES, broadcast_keys: int = BROADCAST_KEYS) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Writes the index of ``rows`` (doc_id, key, text) and returns it, its collision chains and its directory.

    The index has bucket, key, keep_id, group_size and collides; where ``collides``
    holds, the key's entries are in the chains: bucket, key, place, text, keep_id, group_size."""
    top = (F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    keys = materialize(rows.groupBy("key").agg(*top), "keys")
    buckets, start = directory(keys.select("key"), bucket_entries)
    placed = with_bucket(keys, buckets, start)
    lone = placed.where("group_size = 1").withColumn("collides", F.lit(False))
    repeated = placed.where("group_size > 1").select("bucket", "key")
    if repeated.count() <= broadcast_keys:
        texts = rows.join(F.broadcast(repeated), "key").groupBy("bucket", "key", "text").agg(*top)
    else:
        texts = rows.groupBy("key", "text").agg(*top).join(repeated, "key")
    # an owner has all texts of its buckets' keys: no exchange is left for these windows
    chain = Window.partitionBy("bucket", "key")
    compared = owned(texts.select("bucket", "key", "text", "keep_id", "group_size"), buckets)
    compared = materialize(compared.withColumn("place", F.row_number().over(chain.orderBy("text")) - 1).withColumn("texts", F.count(F.lit(1)).over(chain)), "exact-texts")
    clashing = compared.where("texts > 1")
    chains = clashing.select("bucket", "key", "place", "text", "keep_id", "group_size")
    single = compared.where("texts = 1").select("bucket", "key", "keep_id", "group_size", F.lit(False).alias("collides"))
    marks = clashing.where("place = 0").select("bucket", "key", "keep_id", "group_size", F.lit(True).alias("collides"))
    entries = lone.select(*single.columns).unionByName(single).unionByName(marks)
    return materialize(owned(entries, buckets), "exact-index"), chains, buckets, start


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_entries: int = BUCKET_ENTRIES, key: Callable[[Column], Column] = F.xxhash64, broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, bucket, place (in the key's chain).

    Equal texts are equal after no change at all; null counts as empty. The
    largest id of a group stays; a null id is below every other and stays only
    where the whole group has null ids. Rows that repeat both id and text all
    count in group_size and share one decision. An empty table gives no rows;
    other columns of ``docs`` are not read, whatever their names. ``key`` makes a
    long of a text; keys of different texts may be equal.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), key(text).alias("key"), text.alias("text"))
    index, chains, buckets, start = build_index(rows, bucket_entries, broadcast_keys)
    sha = F.sha2("text", 256).alias("text_sha256")
    out = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "bucket", "place"]
    looked_up = with_bucket(rows.select("doc_id", "key", sha), buckets, start)
    alone = looked_up.join(index.where("not collides").drop("collides"), ["bucket", "key"]).withColumn("place", F.lit(0)).select(*out)
    if chains.isEmpty():
        return alone
    clashing = with_bucket(rows.select("doc_id", "key", "text", sha), buckets, start).join(index.where("collides").select("bucket", "key"), ["bucket", "key"], "left_semi")
    return alone.unionByName(clashing.join(chains, ["bucket", "key", "text"]).select(*out))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
