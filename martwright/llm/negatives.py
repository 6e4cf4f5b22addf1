"""Hard-negative mining with exact scores by the method of the Four Russians.

Vectors become integers, and a candidate is packed as bit planes of their two's complement: one byte
holds one plane of eight dimensions. For an anchor, the sums over every subset of eight of its
dimensions are tabled once (256 entries a group), so a plane's share of the inner product is one lookup
per byte. The planes are added from the sign down, doubling in between. No multiplication of
components takes place and scores are exact.

Anchors and candidates are dealt into blocks by the hash of their row, and every block of anchors meets
every block of candidates in a task of bounded size. A first round keeps the best candidates of the
anchor's label, which become its positives; a second one keeps, for each positive, the best candidates
of other labels inside its margin. Only these few rows per block leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: Margin of a negative's score, in percent of the positive's.
LOW, HIGH = 50, 95
#: Rows of a block, and bytes of packed candidates or integers of anchors in one.
CANDIDATES, ANCHORS, BLOCK_BYTES = 4096, 1024, 32 << 20
#: Squared length from which a row takes no part: products with ``HIGH`` and percent fit a long below it.
LONGEST = 2.0**55
#: Entries of the tables that are held at a time.
TABLE = 1 << 17

ENTRY = "vec_id long, label long, dim int, whole binary, packed binary"


def pack(whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Planes needed by each row of integers, and the bytes [row, plane, group of 8] of all planes."""
    need = np.where(whole < 0, ~whole, whole).max(axis=1, initial=0)
    planes = np.zeros(len(whole), np.int64)
    while (left := need >> planes > 0).any():
        planes += left
    planes += 1  # the sign
    pad = np.zeros((len(whole), -whole.shape[1] % 8), np.int64)
    wide = np.concatenate([whole, pad], axis=1)
    bits = [np.packbits(wide >> k & 1, axis=1, bitorder="little") for k in range(planes.max(initial=1))]
    return planes, np.stack(bits, axis=1)


def entries(vectors: DataFrame) -> DataFrame:
    """The rows that take part, as integers (``whole``) and bit planes (``packed``)."""
    tenth = (F.col("label").cast("decimal(20,0)") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, tenth).otherwise(F.col("label").cast("decimal(20,0)"))
    rows = vectors.where("vec_id is not null and label is not null and embedding is not null").select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), "embedding"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            sizes = np.asarray(vectors.value_lengths())
            flat = vectors.flatten()
            holes = np.asarray(flat.is_null())
            values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            found: list[tuple] = []
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                cells = (ends[at] - dim)[:, None] + np.arange(dim)
                x = values[cells]
                with np.errstate(all="ignore"):
                    x = np.floor(SCALE * x)
                    fits = ~holes[cells].any(axis=1) & np.isfinite(x).all(axis=1) & ((x * x).sum(axis=1) < LONGEST)
                whole = x[fits].astype(np.int64)
                planes, packed = pack(whole)
                for r, p, w, b in zip(at[fits].tolist(), planes.tolist(), whole, packed):
                    found.append((r, dim, w.tobytes(), b[:p].tobytes()))
            rows = pa.array([f[0] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array([f[1] for f in found], pa.int32()),
                    pa.array([f[2] for f in found], pa.binary()),
                    pa.array([f[3] for f in found], pa.binary()),
                ],
                names=["vec_id", "label", "dim", "whole", "packed"],
            )

    return rows.mapInArrow(run, ENTRY)


def tables(anchors: np.ndarray) -> np.ndarray:
    """Sums over the subsets of each group of eight dimensions: [group, subset, anchor]."""
    groups = anchors.T.reshape(anchors.shape[1] // 8, 8, len(anchors))
    out = np.zeros((len(groups), 256, len(anchors)), anchors.dtype)
    for j in range(8):
        out[:, 1 << j : 2 << j] = out[:, : 1 << j] + groups[:, j, None]
    return out


def scores(planes: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Inner products [candidate, anchor] from planes [plane, group, candidate], the last the sign."""
    of = tables(anchors)
    total = np.zeros((planes.shape[2], len(anchors)), anchors.dtype)
    for k in range(len(planes) - 1, -1, -1):
        total += total
        for g in range(planes.shape[1]):
            found = of[g].take(planes[k, g], axis=0)
            total += found
        if k == len(planes) - 1:
            np.negative(total, out=total)
    return total


@dataclass(frozen=True)
class Block:
    """Candidates of one dimension, sorted by label and vec_id."""

    vec_id: np.ndarray
    label: np.ndarray
    row: np.ndarray
    planes: np.ndarray

    @staticmethod
    def of(frame: pd.DataFrame, dim: int) -> Block:
        frame = frame.sort_values(["label", "vec_id", "row"])
        groups = -(-dim // 8)
        raw = [np.frombuffer(p, np.uint8).reshape(-1, groups) if groups else np.zeros((1, 0), np.uint8) for p in frame["packed"]]
        most = max(map(len, raw))
        planes = np.empty((len(raw), most, groups), np.uint8)
        for k, p in enumerate(raw):
            planes[k, : len(p)], planes[k, len(p) :] = p, p[-1]  # the sign goes on
        return Block(
            frame["vec_id"].to_numpy(), frame["label"].to_numpy(), frame["row"].to_numpy(),
            np.ascontiguousarray(planes.transpose(1, 2, 0)),
        )

    def part(self, low: int, high: int) -> Block:
        return Block(*(x[low:high] for x in (self.vec_id, self.label, self.row)), self.planes[:, :, low:high])


def best(score: np.ndarray, allowed: np.ndarray, vec_id: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, candidate) of the ``most`` best allowed ones per anchor; ties by smaller vec_id."""
    floor = np.iinfo(score.dtype).min
    masked = np.where(allowed, score, floor)
    if len(masked) > most:
        least = np.partition(masked, len(masked) - most, axis=0)[len(masked) - most]
        allowed = allowed & (masked >= least)
    anchor, which = np.nonzero(allowed.T)
    order = np.lexsort((vec_id[which], -score[which, anchor].astype(np.int64), anchor))
    anchor, which = anchor[order], which[order]
    first = np.searchsorted(anchor, anchor, side="left")
    keep = np.arange(len(anchor)) - first < most
    return anchor[keep], which[keep]


def meet(anchors: pd.DataFrame, candidates: pd.DataFrame, visit) -> list[tuple]:
    """``visit(anchors of one label, block, scores, its first row, its last)`` for every tile."""
    out: list[tuple] = []
    for dim, mine in anchors.groupby("dim"):
        of = candidates[candidates["dim"] == dim]
        if not len(of):
            continue
        block = Block.of(of, dim)
        width = -(-dim // 8) * 8
        tile = max(1, min(64, TABLE // max(1, 32 * width)))
        for label, same in mine.groupby("label"):
            low, high = np.searchsorted(block.label, [label, label + 1])
            for at in range(0, len(same), tile):
                part = same.iloc[at : at + tile]
                whole = np.zeros((len(part), width), np.int64)
                whole[:, :dim] = np.frombuffer(b"".join(part["whole"]), np.int64).reshape(len(part), dim)
                if np.abs(whole).sum(axis=1).max() << len(block.planes) < 2**31:
                    whole = whole.astype(np.int32)  # no sum of planes can be larger
                out += visit(part, block, whole, int(low), int(high))
    return out


def _positives(part: pd.DataFrame, block: Block, whole: np.ndarray, low: int, high: int) -> list[tuple]:
    if low == high:
        return []
    block = block.part(low, high)
    score = scores(block.planes, whole)
    other = block.row[:, None] != part["row"].to_numpy()[None, :]
    a, c = best(score, other, block.vec_id, POSITIVES)
    rows = part["row"].to_numpy()[a]
    return list(zip(rows.tolist(), block.vec_id[c].tolist(), block.row[c].tolist(), score[c, a].tolist()))


def _negatives(part: pd.DataFrame, block: Block, whole: np.ndarray, low: int, high: int) -> list[tuple]:
    out: list[tuple] = []
    targets = np.array(part["targets"].tolist(), np.int64)  # padded with -1, which allows nothing
    for side in (block.part(0, low), block.part(high, len(block.row))):
        if not len(side.row):
            continue
        score = scores(side.planes, whole)
        for k in range(targets.shape[1]):
            wanted = targets[:, k]
            least, most = -(-LOW * wanted // 100), HIGH * wanted // 100
            allowed = (score >= least) & (score <= most) & (wanted >= 0)
            if allowed.any():
                a, c = best(score, allowed, side.vec_id, NEGATIVES)
                rows = part["row"].to_numpy()[a]
                found = zip(rows.tolist(), [k] * len(a), side.vec_id[c].tolist(), score[c, a].tolist())
                out += found
    return out


def _dealt(rows: DataFrame, blocks: int, other: int, mine: str, others: str) -> DataFrame:
    """Rows with their own block and a copy for each block of the other side."""
    every = F.explode(F.sequence(F.lit(0), F.lit(other - 1))).alias(others)
    return rows.withColumn(mine, F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).select("*", every)


def _first(found: DataFrame, keys: list[str], most: int, *order: str) -> DataFrame:
    """The ``most`` best rows per key, numbered from 1; Spark drops the others before the shuffle too."""
    by = Window.partitionBy(*keys).orderBy(F.desc("score"), *order)
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= most)


def hard_negatives(vectors: DataFrame, every: int = 50, candidates: int = CANDIDATES, anchors: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors``: (vec_id, embedding, label). Rows with a NULL vec_id, label or vector, or a NULL or
    non-finite component, take no part; nor do rows of squared integer length from 2**55 on, whose scores
    may not fit a long. Vectors of different lengths do not meet; empty ones score 0. Repeated rows are
    rows of their own, positives of one another and anchors each. Ties go to the smaller vec_id.
    Vectors of any length are whole; blocks hold fewer of long ones. An anchor without positives, or
    without rows inside the margin, has no rows. Other columns are not looked at; an empty frame gives an
    empty frame.
    """
    numbered = entries(vectors).withColumn("row", F.monotonically_increasing_id())
    rows = stored(numbered, "entries")  # row numbers are fixed from here on
    is_anchor = F.col("vec_id") % every == 0
    size = rows.agg(
        F.count(F.lit(1)),
        F.coalesce(F.sum(F.length("packed") + 24), F.lit(0)),
        F.count_if(is_anchor),
        F.coalesce(F.sum(F.when(is_anchor, F.length("whole") + 24)), F.lit(0)),
    ).first()
    c_blocks = max(1, -(-size[0] // candidates), -(-size[1] // BLOCK_BYTES))
    a_blocks = max(1, -(-size[2] // anchors), -(-size[3] // BLOCK_BYTES))
    given = _dealt(rows.select("row", "vec_id", "label", "dim", "packed"), c_blocks, a_blocks, "c_block", "a_block")
    asked = rows.where(is_anchor).select("row", "vec_id", "label", "dim", "whole")
    keys = ["a_block", "c_block"]

    def matched(left: DataFrame, visit, columns: list[str], ddl: str) -> DataFrame:
        left = _dealt(left, a_blocks, c_blocks, "a_block", "c_block")
        left = left.toDF(*left.columns)  # columns of its own, as both sides come from the same rows
        run = lambda a, c: pd.DataFrame(meet(a, c, visit), columns=columns)
        return left.groupBy(*keys).cogroup(given.groupBy(*keys)).applyInPandas(run, ddl)

    found = matched(
        asked, _positives, ["anchor", "positive_id", "positive", "score"],
        "anchor long, positive_id long, positive long, score long",
    )
    positives = stored(_first(found, ["anchor"], POSITIVES, "positive_id", "positive"), "positives")
    slots = F.transform(
        F.sequence(F.lit(1), F.lit(POSITIVES)),
        lambda k: F.coalesce(F.try_element_at("scores", k), F.lit(-1).cast("long")),
    )
    targets = positives.groupBy("anchor").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "score"))).alias("scores")
    )
    targets = targets.select("anchor", slots.alias("targets"))
    aimed = asked.join(targets, F.col("row") == F.col("anchor")).drop("anchor")
    found = matched(
        aimed, _negatives, ["anchor", "slot", "negative_id", "score"],
        "anchor long, slot int, negative_id long, score long",
    )
    negatives = _first(found, ["anchor", "slot"], NEGATIVES, "negative_id")
    named = positives.join(asked.select("row", F.col("vec_id").alias("anchor_id")), F.col("anchor") == F.col("row"))
    named = named.select(
        "anchor", (F.col("rank") - 1).alias("slot"), "anchor_id", "positive_id", F.col("score").alias("positive_score")
    )
    return named.join(negatives, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score")
    )
