"""Mix sources to target weights by systematic sampling.

Each source is a list of documents ordered by size. With ``rate`` expected copies per document, the
prefix sum of expected copies at rank k is ``rate * k``; one random offset is added, and a document is
emitted once per integer boundary that its step crosses. As neighbours in the list have nearly equal
sizes, a source's taken words miss its target by little more than one large document.

Ranks are found without collecting a source: documents are counted by (source, size, part), where
``part`` is a hash of the id that splits large groups of equal size; the counts give each cell its
first rank, and only inside a cell are rows numbered.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
SEED = 20240229
#: Parts that a group of documents of one source and one size is split into.
PARTS = 64


def source_targets(
    sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) from rows (source, source_size), one per source.

    Sources in code point order, NULL last, take the weights in turn and share ``share`` times all
    words; a target stops at ``most`` times its source and the excess is shared again by weight. That
    is a water level: with sources ordered by cap/weight, those that the level passes are a prefix.
    The windows are over one row per source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    frame = sizes.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    ).withColumn("cap", F.lit(most) * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    below = F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    frame = frame.withColumn(
        "level", (F.lit(share) * F.sum("source_size").over(everything) - below) / rest
    ).withColumn("capped", F.col("level") * F.col("weight") >= F.col("cap"))
    level = F.min(F.when(~F.col("capped"), F.struct((F.col("cap") / F.col("weight")).alias("at"), "level")))
    target = F.when(F.col("capped"), F.col("cap")).otherwise(
        F.least(F.col("weight") * level.over(everything)["level"], F.col("cap"))
    )
    return frame.select("source", "source_size", target.alias("target"))


def mix(sized: DataFrame, seed: int = SEED, parts: int = PARTS, **shares) -> DataFrame:
    """Rows of ``sized`` (doc_id, source, size and any others) with source_size, target and copies.

    Nothing is dropped: a row that the mix leaves out has 0 copies. A source without words has target
    0 and no copies. NULL is a source like any other. Rows that repeat a doc_id are documents of their
    own. An empty frame gives an empty frame. The offset comes from ``seed`` alone, ties are broken by
    a hash of doc_id and doc_id, so reruns agree. Input columns named source_size, target, copies,
    mix_part, mix_start or mix_rank are replaced.
    """
    names = ["source_size", "target", "copies", "mix_part", "mix_start", "mix_rank"]
    sized = sized.drop(*names)
    sized = sized.withColumn("mix_part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    cell = ["source", "size", "mix_part"]
    cells = sized.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("source").orderBy("size", "mix_part")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    sizes = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sizes, **shares)
    starts = _same(cells, targets, ["source"]).withColumn("mix_start", F.coalesce(before, F.lit(0)))
    rows = _same(sized, starts.drop("n"), cell)
    within = F.row_number().over(Window.partitionBy(*cell).orderBy("doc_id"))
    offset = F.lit(random.Random(seed).random())
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)

    def boundaries(rank: Column) -> Column:
        return F.floor(rate * rank + offset)

    rank = F.col("mix_rank")
    copies = F.least(boundaries(rank) - boundaries(rank - 1), F.ceil(rate))
    return (
        rows.withColumn("mix_rank", F.col("mix_start") + within)
        .withColumn("copies", copies.cast("long"))
        .drop("mix_part", "mix_start", "mix_rank")
    )


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal keys, NULL equal to NULL; the keys appear once."""
    renamed = right.withColumnsRenamed({k: f"r_{k}" for k in keys})
    on = None
    for k in keys:
        same = left[k].eqNullSafe(renamed[f"r_{k}"])
        on = same if on is None else on & same
    return left.join(renamed, on).drop(*(f"r_{k}" for k in keys))
