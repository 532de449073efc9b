"""Benchmark decontamination by MinHash containment search.

Items and documents are sets of five-word shingles. Items are dealt into size
classes (powers of two). The sketch of an item is the bottom-k MinHash of its
shingles, with k set by the upper bound ``u`` of its class: ``floor((1-t)u)+1``.
A document that contains a share ``t`` of the item misses at most ``(1-t)n`` of
its shingles, so it always holds one of any ``k`` of them: unlike banded
signatures of whole documents, whose resemblance to a short item is close to
zero in a long text, the search loses nothing. Candidates are then verified by
counting the exact shingles. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from earshot.llm.common import broadcast_if_small, fresh, materialize, table, words

WORDS, THRESHOLD = 5, 0.8
#: Item tables of at most so many shingles (about 100 bytes each) are broadcast.
BROADCAST_SHINGLES = 200_000


def item_shingles(items: DataFrame, id_col: str = "item_id", text_col: str = "text", n: int = WORDS) -> DataFrame:
    """(item_id, shingle, h, n_item, rank): distinct shingles, ranked by hash within the item."""
    tokens = items.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("ws")).where(F.size("ws") >= n)
    grams = F.transform(F.sequence(F.lit(0), F.size("ws") - n), lambda i: F.array_join(F.slice("ws", i + 1, n), " "))
    out = tokens.select("item_id", F.explode(grams).alias("shingle")).distinct()
    out = out.withColumn("h", F.xxhash64(F.split("shingle", " ")))
    own = Window.partitionBy("item_id")
    return out.withColumn("n_item", F.count(F.lit(1)).over(own)).withColumn("rank", F.row_number().over(own.orderBy("h", "shingle")))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    n: int = WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, body, item_id, n_item, n_shared): every document that holds at
    least ``threshold`` of an item's shingles; ``body`` hashes the text.

    Words are lower-case runs of letters and digits. Texts and items of fewer
    than five words have no shingle and never match; nor do null texts
    and items without an id. Repeated item rows with one id are one item (shingles
    are joined); repeated document rows give one row. No rows in, no rows out;
    other columns are not read.
    """
    percent = round(threshold * 100)
    shingles = materialize(item_shingles(items, item_id_col, item_text_col, n), "items")
    rows = shingles.count()
    # size classes: an item of class c has between 2^c and 2^(c+1)-1 shingles
    floor = F.expr("shiftleft(1L, cast(floor(log2(n_item)) as int))")
    upper = floor * 2 - 1
    sketch = shingles.where(F.col("rank") <= F.floor(upper * (100 - percent) / 100) + 1).select(
        "h", "item_id", F.ceil(floor * percent / 100).alias("least")
    )
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    tokens = text.select("doc_id", F.xxhash64("text").alias("body"), words(F.col("text")).alias("ws")).where(F.size("ws") >= n)
    hashes = F.transform(F.sequence(F.lit(0), F.size("ws") - n), lambda i: F.xxhash64(F.slice("ws", i + 1, n)))
    probes = tokens.select("doc_id", "body", (F.size("ws") - n + 1).alias("most"), F.explode(hashes).alias("h"))
    candidates = (
        probes.join(broadcast_if_small(sketch, rows, BROADCAST_SHINGLES), "h")
        .where("most >= least")
        .select("doc_id", "body", "item_id")
        .distinct()
        .groupBy("doc_id", "body")
        .agg(F.collect_set("item_id").alias("item_ids"))
    )
    candidates = materialize(candidates, "candidates").select(
        F.col("doc_id").alias("c_id"), F.col("body").alias("c_body"), "item_ids"
    )
    picked = text.withColumn("body", F.xxhash64("text")).join(
        candidates, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("body") == F.col("c_body"))
    )
    # rows that repeat id and text count once, so the pairs are made distinct before they are counted
    whole = picked.withColumn("ws", words(F.col("text")))
    grams = F.transform(F.sequence(F.lit(0), F.size("ws") - n), lambda i: F.array_join(F.slice("ws", i + 1, n), " "))
    held = whole.select("doc_id", "body", "item_ids", F.explode(F.array_distinct(grams)).alias("shingle"))
    met = held.join(broadcast_if_small(shingles.select("shingle", "item_id", "n_item"), rows, BROADCAST_SHINGLES), "shingle")
    shared = met.where(F.array_contains("item_ids", F.col("item_id"))).groupBy("doc_id", "body", "item_id", "n_item")
    return shared.agg(F.count_distinct("shingle").alias("n_shared")).where(F.col("n_shared") * 100 >= F.col("n_item") * percent)


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that ``contamination`` finds; all columns, of any name, as they were."""
    name = fresh(docs.columns)
    id_, body = name("id"), name("body")
    hits = contamination(docs, items, id_col, text_col, **options).select(F.col("doc_id").alias(id_), F.col("body").alias(body)).distinct()
    hits = materialize(hits, "contaminated")
    key = F.xxhash64(F.col(text_col))
    return docs.join(hits, F.col(id_col).eqNullSafe(F.col(id_)) & (key == F.col(body)), "left_anti")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = contamination(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return hits.select("doc_id", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))


ORACLE = r"""
WITH t AS (SELECT doc_id AS id, 'd' AS k, text FROM documents UNION ALL SELECT item_id, 'i', text FROM benchmark),
w AS (SELECT id, k, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS ws FROM t),
g AS (SELECT DISTINCT id, k, unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' '))) AS s
      FROM w WHERE len(ws) >= 5),
n AS (SELECT id, count(*) AS n_item FROM g WHERE k = 'i' GROUP BY id),
m AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM g d JOIN g i ON d.s = i.s
      WHERE d.k = 'd' AND i.k = 'i' GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM m JOIN n ON n.id = m.item_id WHERE n_shared * 100 >= n_item * 80
"""
