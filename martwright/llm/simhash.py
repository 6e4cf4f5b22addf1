"""SimHash near-duplicates through an inverted index over byte positions.

A fingerprint has 8 positional bytes. If two fingerprints differ in at most 4 bits, at least 4 of
their positional bytes are the same. The index is keyed by ``shared`` positional bytes at a time, over
a set of position groups chosen so that any 4 equal positions contain one of them; a pair that
reaches the guaranteed minimum therefore meets in a posting list. There, its shared positional bytes
are tallied, pairs with 4 or more are kept, and their differing bits are counted.

Equal fingerprints are one entry. A posting list yields links that span its groups (at most one per
entry), never its pairs. Lists longer than ``BLOCK`` are dealt as pairs of blocks, so that no task
holds a hot list.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import components, stored

SEED = 42
SHINGLE = 4
MAX_BITS = 4
BYTES = 8
MIN_SHARED = BYTES - MAX_BITS
#: Entries of a posting list, or of one side of a block pair, that a task compares at a time.
BLOCK = 4096


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the word shingles of a text, A-Z lower-cased; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends)]
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8)).reshape(-1, 64)
    over_half = 2 * bits.sum(0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(over_half).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) per row; fp is the fingerprint as a signed long. A NULL text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t or b"") for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "doc_id long, fp long"
    )


def position_groups(shared: int) -> list[tuple[int, ...]]:
    """Groups of ``shared`` positions such that any ``MIN_SHARED`` of the 8 contain one of them."""
    if shared == MIN_SHARED:
        return list(combinations(range(BYTES), shared))
    # Turan: deal the positions to MIN_SHARED - 1 classes (for pairs), or take triples by class
    if shared == 2:
        classes = [[p for p in range(BYTES) if p % 3 == c] for c in range(3)]
        return [g for c in classes for g in combinations(c, 2)]
    if shared == 3:
        cls = {p: p % 3 for p in range(BYTES)}
        return [
            g
            for g in combinations(range(BYTES), 3)
            if len({cls[p] for p in g}) == 1
            or any(
                sum(cls[p] == c for p in g) == 2 and sum(cls[p] == (c + 1) % 3 for p in g) == 1
                for c in range(3)
            )
        ]
    raise ValueError("shared must be 2, 3 or 4")


def choose_shared(entries: int) -> int:
    """Bytes per key with the least work at this many entries: postings written plus pairs met."""
    return min(
        (2, 3, 4),
        key=lambda s: len(position_groups(s)) * (entries + entries**2 / 256.0**s),
    )


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs share at least MIN_SHARED positional bytes and differ in at most MAX_BITS bits."""
    x = a ^ b
    tally = (x.view(np.uint8).reshape(*x.shape, BYTES) == 0).sum(-1)
    return (tally >= MIN_SHARED) & (np.bitwise_count(x) <= MAX_BITS)


def spanning_links(fps: np.ndarray) -> list[tuple[int, int]]:
    """Index pairs that connect the groups of close fingerprints, at most one per entry.

    Breadth first: each reached entry is compared with all that no group has reached yet, so a tight
    group is found by few comparisons.
    """
    links, left = [], np.arange(len(fps))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = _close(fps[left], fps[at])
            if near.any():
                found = left[near]
                links.extend((int(at), int(i)) for i in found)
                queue.extend(found)
                left = left[~near]
    return links


def _short_lists(key: np.ndarray, fp: np.ndarray, rep: np.ndarray) -> Iterator[tuple]:
    """Links inside the runs of equal key: all lags of short runs at once, long runs breadth first."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    long = sizes > 32
    run = np.repeat(np.where(long, -1 - np.arange(len(sizes)), np.arange(len(sizes))), sizes)
    most = int(sizes[~long].max(initial=1))
    for lag in range(1, most):
        i = np.flatnonzero((run[lag:] == run[:-lag]) & (run[lag:] >= 0))
        i = i[_close(fp[i], fp[i + lag])] if len(i) else i
        yield rep[i], rep[i + lag]
    for s, n in zip(starts[long], sizes[long]):
        links = np.array(spanning_links(fp[s : s + n]), np.int64).reshape(-1, 2) + s
        yield rep[links[:, 0]], rep[links[:, 1]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows (key, fp, rep) that come sorted by key; a key's rows may span batches."""
    rest: list[np.ndarray] | None = None

    def out(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs = list(_short_lists(columns[0], columns[1].view(np.uint64), columns[2]))
        a = np.concatenate([p[0] for p in pairs] or [np.zeros(0, np.int64)])
        b = np.concatenate([p[1] for p in pairs] or [np.zeros(0, np.int64)])
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            now = [np.concatenate(x) for x in zip(rest, now)]
        if not len(now[0]):
            continue
        last = int(np.searchsorted(now[0], now[0][-1]))
        rest = [c[last:] for c in now]
        if last:
            yield from out([c[:last] for c in now])
    if rest is not None and len(rest[0]):
        yield from out(rest)


def near_links(entries: DataFrame, shared: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between ids of ``entries`` (fp, rep), fp distinct; they connect what is close."""
    position = F.posexplode(F.array(*(F.array(*map(F.lit, g)) for g in position_groups(shared))))
    postings = entries.select("fp", "rep", position.alias("g", "at"))
    key = F.lit(0).cast("long")
    for k in range(shared):
        byte = F.expr(f"shiftrightunsigned(fp, 8 * at[{k}]) & 255L")
        key = F.shiftleft(key, 8).bitwiseOR(byte)
    key = F.shiftleft(F.col("g").cast("long"), 8 * shared).bitwiseOR(key)
    postings = postings.select(key.alias("key"), "fp", "rep")
    sizes = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = postings.join(sizes, "key")
    # a long list becomes pairs of blocks; a short one is a single block
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("long")
    mine = F.pmod(F.xxhash64("fp"), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
    dealt = met.select("key", "fp", "rep", mine.alias("mine"), blocks.alias("blocks"), other)
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    cell = F.when(F.col("blocks") == 1, F.col("key")).otherwise(F.xxhash64("key", low, high))
    dealt = dealt.select(cell.alias("key"), "fp", "rep")
    parts = dealt.repartition("key").sortWithinPartitions("key", "fp")
    return parts.mapInArrow(_links, "a long, b long")


def near_duplicates(docs: DataFrame, shared: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs`` (doc_id, text).

    Documents whose fingerprints differ in at most 4 bits are linked, and component_id is the smallest
    doc_id reachable; texts without words have fingerprint 0 and are linked like any other. A row with
    NULL doc_id links nothing and has component_id NULL. Rows that repeat a doc_id are one node with
    several fingerprints. An empty frame gives an empty frame.
    """
    prints = stored(fingerprints(docs), "prints")
    classes = prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    classes = stored(classes, "classes")
    links = near_links(classes, shared or choose_shared(classes.count()))
    # two fingerprints of one doc_id meet in that node
    ends = prints.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y"))
    doubled = prints.join(ends.where("x <> y"), "doc_id", "left_semi")
    links = links.union(doubled.join(classes, "fp").select("doc_id", "rep"))
    roots = components(links)
    named = classes.join(roots, classes.rep == roots.node, "left").select(
        F.col("fp").alias("c_fp"), F.coalesce("root", "rep").alias("component_id")
    )
    return prints.join(named, F.col("fp") == F.col("c_fp"), "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def one_row_per_id(docs: DataFrame) -> DataFrame:
    """Of rows that repeat a doc_id, the one whose text sorts first; rows with NULL doc_id all stay."""
    repeated = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = repeated.where("n > 1").select("doc_id")
    order = Window.partitionBy("doc_id").orderBy("text", *(c for c in docs.columns if c != "text"))
    several = docs.join(repeated, "doc_id", "left_semi").withColumn("row_of_id", F.row_number().over(order))
    first = several.where("row_of_id = 1").select(*docs.columns)
    return docs.join(repeated, "doc_id", "left_anti").select(*docs.columns).union(first)
