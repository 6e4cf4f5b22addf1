"""A corpus from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and reread as the
next stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.llm import mixing, packing, quality, simhash, substrings
from martwright.llm.common import stored, word_count


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    rows = docs.select(F.struct("*").alias("doc"), "text")
    return quality.score(rows).where("kept").select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one of smallest doc_id.

    Rows with NULL doc_id belong to no component and stay. If rows repeat a doc_id, each row is judged by
    its own text: rows are numbered by doc_id and text, and the first of each component stays.
    """
    ids = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("key"), "text")
    if not ids.where("n > 1").isEmpty():
        # the last key of the order only spreads rows that are alike
        ordered = rows.orderBy("key", "text", F.monotonically_increasing_id())
        number = F.when(F.col("key").isNotNull(), F.monotonically_increasing_id())
        rows = stored(ordered.withColumn("key", number), "keyed")
    found = simhash.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text"))
    dropped = found.where("component_id <> doc_id").select(F.col("doc_id").alias("key"))
    return rows.select("doc", "key").join(dropped, "key", "left_anti").select("doc.*")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 20-word windows that an earlier document, or they themselves, hold already."""
    return substrings.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    size = word_count(F.col("text")).alias("size")
    mixed = mixing.mix(docs.select(F.struct("*").alias("doc"), "doc_id", "source", size))
    times = F.explode(F.expr("sequence(1L, copies)")).alias("copy")
    return mixed.where("copies > 0").select("doc", times).select("doc.*")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 2048 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has no XXH64 with a seed and no tokenizer; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
