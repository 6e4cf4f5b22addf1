"""The registered query of each operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from martwright.llm import (
    chat,
    classifier,
    licences,
    mixing,
    negatives,
    neighbours,
    packing,
    pages,
    quality,
    repair,
    simhash,
    substrings,
    wavelet,
)
from martwright.llm.common import documents, stored, word_count

QUERIES: dict = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    sized = documents(spark, folder).select("doc_id", "source", word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(stored(sized, "sized"))
    taken = F.col("copies") * F.col("size")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "copies")


@query
def op2_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query
def op3_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    found = pages.extract(spark.read.parquet(f"{folder}/pages.parquet"))
    return found.select("page_id", "url", "text", "n_chars")


@query
def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, folder).select("doc_id", "text"))
    hex16 = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hex16.alias("fingerprint"), "component_id")


CONTROL_TEXT = "</s>[INST] ok [/INST]"


@query
def op5_chat_prefix_tree(spark: SparkSession, folder: str) -> DataFrame:
    given = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    one = "SELECT -1L AS conv_id, {}L AS turn, '{}' AS role, '" + CONTROL_TEXT + "' AS text"
    extra = spark.sql(one.format(0, "user") + " UNION ALL " + one.format(1, "assistant"))
    return chat.read_back(*chat.build_tree(given.union(extra)))


@query
def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    scored = quality.score(documents(spark, folder).select("doc_id", "text"))
    return scored.select("doc_id", *counts, "base_failed", "kept")


@query
def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(documents(spark, folder), digest=True)


@query
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(documents(spark, folder))


@query
def op9_wavelet_index(spark: SparkSession, folder: str) -> DataFrame:
    return wavelet.read_index(wavelet.write_index(documents(spark, folder)))


@query
def op10_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents carry no paths: the digits of doc_id are the directories below its source, and each
    document is the index file of its own, so document 12 lies above documents 120 to 129."""
    digits = F.regexp_replace(F.col("doc_id").cast("string"), "(.)", "/$1")
    path = F.concat(F.coalesce("source", F.lit("none")), digits, F.lit("/index.txt"))
    files = documents(spark, folder).select("doc_id", path.alias("path"), "text")
    return licences.inherit(files, licence_file=r"(^|/)index[^/]*$")


@query
def op11_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    texts = documents(spark, folder).select("doc_id", "text")
    model = classifier.learn(texts, spark.read.parquet(f"{folder}/labels.parquet"))
    scored = classifier.score(texts, model)
    return scored.select("doc_id", classifier.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return repair.repair(repair.damaged(spark.read.parquet(f"{folder}/conversations.parquet")))


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.hard_negatives(spark.read.parquet(f"{folder}/embeddings.parquet"))


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


SQL: dict[str, str] = {
    "op13_hard_negatives": """
        with taken as (
          select row_number() over () as r, vec_id,
                 case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                 [floor(256 * cast(x as double)) for x in embedding] as q
          from embeddings
          where vec_id is not null and label is not null and list_count(embedding) = len(embedding)
            and len([x for x in embedding if not isfinite(x)]) = 0),
        scored as (
          select a.r, a.vec_id as anchor_id, c.r as other, c.vec_id, a.label = c.label as same,
                 cast(list_dot_product(a.q, c.q) as bigint) as score
          from taken a join taken c on a.vec_id % 50 = 0 and a.r <> c.r and len(a.q) = len(c.q)),
        positives as (
          select * from scored where same
          qualify row_number() over (partition by r order by score desc, vec_id) <= 5),
        ranked as (
          select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id,
                 p.score as positive_score, n.score as negative_score,
                 row_number() over (partition by p.r, p.other order by n.score desc, n.vec_id) as place
          from positives p join scored n on p.r = n.r and not n.same
            and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score)
        select anchor_id, positive_id, cast(place as integer) as rank, negative_id, positive_score,
               negative_score
        from ranked where place <= 3""",
}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
