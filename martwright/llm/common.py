"""Helpers shared by the training-data operators: tables in the shared folder, words, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.session import shared_folder

#: A word is a run of anything but space and U+0009..U+000D (``bytes.split()`` cuts the same way).
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stored(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write a frame to a new table below ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage and survives lost executors; every executor can read the folder. The table stays
    until its owner clears the folder, as results read it lazily. Spark frees the shuffle files behind
    it only once the driver has collected the plan as garbage, so that is asked for here.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.options(**(options or {})).parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node, root) per node that has an
    edge to another one; root is the smallest node that can be reached.

    Alternating large-star and small-star steps (Kiveris et al., 2014), each a grouping with map-side
    combining and a plain equi-join that adaptive execution can split at a hub. Every round is a
    table in the shared folder. Self loops and NULL ends are ignored.
    """
    edges = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges, state = stored(edges.distinct(), "edges"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == state or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct()
            )
        state = tuple(now)
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select("a", F.col("m").alias("b")).union(
            joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        edges = stored(small.distinct(), "edges")
