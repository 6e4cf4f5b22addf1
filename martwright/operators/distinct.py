"""Exact distinct counts that merge: keys as dense numbers, sets of keys as bitmaps.

A state is one row per group and bucket of 32,768 key numbers, holding a bitmap of the keys seen. States of
finer groups (days, say) merge into states of coarser ones (months, years) by OR, without going back to the
rows, and a count is the number of bits. Building a state is an ordinary aggregate with map-side combining:
whatever the number of distinct counts, no row is copied for them.

Bitmaps suit few groups over whole-number keys that are dense, or keys numbered by ``number_keys``: a bucket
costs 4 KB however few of its keys a group has seen. Where the keys scatter over many groups, ``sparse`` states
hold buckets of 64 key numbers as the bits of one long: they never outnumber the (group, key) pairs, and their
aggregates are plain hash aggregates. Both kinds merge and count alike. Equal keys have equal numbers, NULL is
not counted.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.session import shared_folder


def number_rows(rows: DataFrame, key: str) -> DataFrame:
    """``rows``, each with a non-NULL key of its own, and ``number``: their place by key, from 0.

    The rows are dealt by range, numbered within each partition, and shifted by what lies in the
    partitions before. Only one count per partition is gathered. The dealt rows are stored, as a second
    dealing could cut the ranges elsewhere.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/keys-{uuid.uuid4().hex}"
    rows.repartitionByRange(key).withColumn("part_no", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    sizes = dealt.groupBy("part_no").agg(F.count(F.lit(1)).alias("keys"))
    before = F.sum("keys").over(Window.orderBy("part_no")) - F.col("keys")
    starts = sizes.select("part_no", before.alias("first_number"))
    within = F.row_number().over(Window.partitionBy("part_no").orderBy(key)) - 1
    numbered = dealt.withColumn("within_part", within).join(F.broadcast(starts), "part_no")
    return numbered.select(*rows.columns, (F.col("first_number") + F.col("within_part")).alias("number"))


def number_keys(rows: DataFrame, key: str) -> DataFrame:
    """(key, number): the distinct non-NULL keys in order, numbered from 0 without gaps."""
    return number_rows(rows.select(key).where(F.col(key).isNotNull()).distinct(), key)


def distinct_states(
    rows: DataFrame, groups: Sequence[Column | str], number: str, sparse: bool = False
) -> DataFrame:
    """One row per group and bucket: ``bucket`` and ``keys``, the bits of the numbers seen there, as a bitmap
    or, ``sparse``, as a long."""
    seen = rows.where(F.col(number).isNotNull())
    if sparse:
        key = F.col(number).cast("long")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(F.lit(63)).cast("int"))
        return seen.groupBy(*groups, F.shiftright(key, 6).alias("bucket")).agg(F.bit_or(bit).alias("keys"))
    return seen.groupBy(*groups, F.bitmap_bucket_number(F.col(number)).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(number))).alias("keys")
    )


def _is_sparse(states: DataFrame) -> bool:
    return isinstance(states.schema["keys"].dataType, T.LongType)


def merge_states(states: DataFrame, groups: Sequence[Column | str]) -> DataFrame:
    """The states of coarser groups, any expressions over the finer ones."""
    either = F.bit_or if _is_sparse(states) else F.bitmap_or_agg
    return states.groupBy(*groups, "bucket").agg(either("keys").alias("keys"))


def count_states(states: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Exact distinct keys per group of ``states``; each (group, bucket) must be there once."""
    bits = F.bit_count("keys") if _is_sparse(states) else F.bitmap_count("keys")
    return states.groupBy(*groups).agg(F.coalesce(F.sum(bits), F.lit(0)).cast("long").alias(name))
