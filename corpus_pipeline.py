"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

Every stage but the last returns the columns of documents. Rows with null ids or
texts go through every stage; each stage's docstring of its operator says how.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import decontaminate, line_dedup, ngram_join, quality_gam, sentencepiece_codec
from earshot.llm.common import materialize, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    model = quality_gam.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality_gam.keep_good(docs, model)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut out; n_chars follows the text."""
    kept = line_dedup.line_dedup(docs)
    length = F.when(F.col("removed_lines") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents."""
    return ngram_join.keep_one(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    return sentencepiece_codec.encode(docs, sentencepiece_codec.default_model(), digests=True)


STAGES = [
    ("quality", quality),
    ("line_dedup", repeated_lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", tokens),
]

#: The first stage is a learnt model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
