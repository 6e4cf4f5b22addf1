"""Best-fit-decreasing packing with lower bounds that certify each partition.

A document's ids are cut into pieces of at most ``CAPACITY`` ids. Pieces are dealt evenly to
partitions of bounded size; each is packed best-fit decreasing, and dual feasible functions give a
lower bound on the bins it needs. A partition that meets its bound is certified and stays. Partitions
with a gap give up their bins that are not full; the freed pieces of all of them are dealt anew and
packed again, as long as that saves bins.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import stored
from martwright.llm.tokens import encoder, vocabulary

CAPACITY = 2048
END_ID = 0
#: Pieces that one task packs; a few numbers each.
TASK_PIECES = 250_000
#: Exchanges at most; each one must save bins, so there are rarely more than two.
ROUNDS = 6


def cut(n: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of ``n`` ids; only the first may be shorter than ``capacity``."""
    if n <= capacity:
        return [n]
    rest = n % capacity
    return ([rest] if rest else []) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32), every id of every text in one piece; NULL text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = encoder(path, glued=True)
        end = np.array([end_id], "<u4")
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                out: list[tuple] = []
                doc_ids = part.column(0).to_pylist()
                for doc_id, ids in zip(doc_ids, tokens_of.encode(part.column(1).to_pylist())):
                    ids, start = np.concatenate([ids.astype("<u4"), end]), 0
                    for k, length in enumerate(cut(len(ids), capacity)):
                        crc = zlib.crc32(ids[start : start + length].tobytes())
                        out.append((doc_id, k, start, length, crc))
                        start += length
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def lower_bound(sizes: np.ndarray, capacity: int = CAPACITY) -> int:
    """Bins that any packing of ``sizes`` needs, the best of two families of dual feasible functions."""
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    volume = count * np.arange(capacity + 1)
    best = -(-int(volume.sum()) // capacity)
    upto, total = np.cumsum(count), np.cumsum(volume)
    # sizes over capacity - a count whole, sizes from a count by volume, smaller ones not at all
    a = np.arange(1, capacity // 2 + 1)
    whole = upto[capacity] - upto[capacity - a]
    middle = total[capacity - a] - total[a - 1]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    x = np.arange(capacity + 1, dtype=np.int64)
    for k in range(1, 33):
        exact = (k + 1) * x % capacity == 0
        # in units of 1 / (k * capacity)
        value = np.where(exact, k * x, (k + 1) * x // capacity * capacity)
        best = max(best, -(-int((value * count).sum()) // (k * capacity)))
    return best


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size, best-fit decreasing. Open bins lie in lists by the room they have left."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, n = 0, 0  # bit r: a bin with r left is open
    for i, size in zip(order.tolist(), sizes[order].tolist()):
        fits = open_rooms >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            b = room[left].pop()
            if not room[left]:
                open_rooms ^= 1 << left
        else:
            b, left, n = n, capacity, n + 1
        bins[i], offsets[i] = b, capacity - left
        left -= size
        if left:
            room[left].append(b)
            open_rooms |= 1 << left
    return bins, offsets


def _packed(items: DataFrame, round_no: int, capacity: int, task_pieces: int) -> DataFrame:
    """``items`` with sequence_id, offset and loose: in a bin with room, of a partition with a gap."""
    parts = max(1, math.ceil(items.count() / task_pieces))
    names = items.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        held = list(frames)
        if not held:
            return
        frame = pd.concat(held, ignore_index=True)
        sizes = frame["length"].to_numpy(np.int64)
        bins, offsets = best_fit(sizes, capacity)
        gap = len(sizes) and bins.max() + 1 > lower_bound(sizes, capacity)
        fill = np.bincount(bins, sizes)
        base = (round_no << 56) + (TaskContext.get().partitionId() << 32)
        frame["sequence_id"], frame["offset"] = base + bins, offsets
        frame["loose"] = bool(gap) & (fill[bins] < capacity)
        yield frame

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    dealt = items.repartition(parts).select(*names)
    return dealt.mapInPandas(run, f"{kind}, sequence_id long, offset long, loose boolean")


def pack(
    items: DataFrame, capacity: int = CAPACITY, task_pieces: int = TASK_PIECES, rounds: int = ROUNDS
) -> DataFrame:
    """Rows of ``items`` (length long, none over ``capacity``, and any others) with sequence_id and offset.

    Every row lands in one sequence, at an offset without gaps from 0. An empty frame gives an empty
    frame; equal rows are packed singly. Columns named sequence_id, offset or loose are replaced.
    """
    items = items.drop("sequence_id", "offset", "loose")
    now = stored(_packed(items, 0, capacity, task_pieces), "packed")
    done: list[DataFrame] = []
    for k in range(1, rounds + 1):
        loose = now.where("loose")
        before = loose.agg(F.count_distinct("sequence_id")).first()[0]
        if before < 2:
            break
        again = stored(_packed(loose.drop("sequence_id", "offset", "loose"), k, capacity, task_pieces), "packed")
        if again.agg(F.count_distinct("sequence_id")).first()[0] >= before:
            break
        done.append(now.where("not loose"))
        now = again
    for part in done:
        now = now.union(part)
    return now.drop("loose")


def pack_documents(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Pieces of all ``docs`` (doc_id, text) in sequences; see ``pieces`` and ``pack``.

    Rows that repeat a doc_id are documents of their own; a NULL doc_id stays NULL.
    """
    found = stored(pieces(docs, path or vocabulary("byte_bpe_50k.json")), "pieces")
    return pack(found, **options)
