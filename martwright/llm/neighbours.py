"""Embedding near-duplicates through a forest of random-projection trees.

A tree splits the vectors again and again by their projection on a random direction, near the median,
and vectors close to a split go to both sides. The trees are fitted on a bounded sample; every vector
is then routed through every tree. Inside each (tree, leaf, label) all vectors are compared in double
precision. A pair that shares several leaves is counted in the smallest of them only, which both sides
can tell from their lists of leaves, so no list of pairs ever leaves a task: only link counts and one
edge per vector to the smallest id of its group there, which the component step then unites.

Equal vectors of one label are one entry with a count. A leaf with more than ``BLOCK`` entries of one
label is dealt as pairs of blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from martwright.llm.common import components, stored

COSINE = 0.93
TREES = 14
#: Share of a node's sample, on each side of the split, that goes to both sides.
SPILL = 0.05
#: Vectors on which the trees are fitted, at most; collected as a model of this bounded size.
SAMPLE = 20_000
#: Entries of one label that a leaf should hold; and sampled vectors that a node needs to be split.
LEAF, NODE = 256, 32
BLOCK = 2048
SEED = 11


@dataclass(frozen=True)
class Tree:
    """Node k has children 2k+1 and 2k+2; nodes without an interval are leaves."""

    directions: np.ndarray
    low: np.ndarray
    high: np.ndarray
    split: np.ndarray

    def leaves(self, units: np.ndarray) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in units]
        at = [(0, np.arange(len(units)))]
        while at:
            node, rows = at.pop()
            if not len(rows):
                continue
            if not self.split[node]:
                for r in rows.tolist():
                    out[r].append(node)
                continue
            x = units[rows] @ self.directions[node]
            at.append((2 * node + 1, rows[x < self.high[node]]))
            at.append((2 * node + 2, rows[x >= self.low[node]]))
        return out


def fit_tree(sample: np.ndarray, depth: int, seed: int, spill: float = SPILL) -> Tree:
    rng = np.random.default_rng(seed)
    nodes, dim = 2 ** (depth + 1) - 1, sample.shape[1]
    directions = rng.normal(size=(nodes, dim))
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    low, high, split = np.zeros(nodes), np.zeros(nodes), np.zeros(nodes, bool)
    at = [(0, sample)]
    while at:
        node, rows = at.pop()
        if 2 * node + 2 >= nodes or len(rows) < NODE:
            continue
        x = rows @ directions[node]
        low[node], high[node] = np.quantile(x, [0.5 - spill, 0.5 + spill])
        if low[node] >= high[node]:
            continue
        split[node] = True
        at.append((2 * node + 1, rows[x < high[node]]))
        at.append((2 * node + 2, rows[x >= low[node]]))
    return Tree(directions, low, high, split)


def units(vectors: list) -> np.ndarray:
    found = np.array(vectors, np.float64)
    found = found / np.abs(found).max(axis=1, keepdims=True)
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def keyed(vectors: DataFrame) -> DataFrame:
    """Rows with a digest ``key`` of label and vector, NULL where the row can link with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes | None] = []
            for vec_id, vector, label in zip(*(c.to_pylist() for c in batch.columns)):
                key = None
                if vec_id is not None and label is not None and vector and None not in vector:
                    row = np.array(vector, np.float64) + 0.0  # one zero
                    if np.isfinite(row).all() and row.any():
                        name = repr(label).encode() + b"\0"
                        key = hashlib.blake2b(name + row.tobytes(), digest_size=16).digest()
                keys.append(key)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.binary())], names=[*batch.schema.names, "key"]
            )

    rows = vectors.select("vec_id", "embedding", "label")
    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("key", BinaryType())]))


def forest(entries: DataFrame, total: int, trees: int, leaf: int, sample: int) -> dict[int, list[Tree]]:
    """Trees per dimension, fitted on a sample of at most ``sample`` vectors."""
    labels = max(1, entries.agg(F.approx_count_distinct("label")).first()[0])
    part = entries.select("vector")
    if total > sample:
        part = part.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < F.lit(int(sample / total * (1 << 30))))
    rows = [r[0] for r in part.limit(sample).collect()]
    by_dim: dict[int, list] = {}
    for row in rows:
        by_dim.setdefault(len(row), []).append(row)
    depth = max(0, int(np.ceil(np.log2(max(1.0, total / labels / leaf)))))
    return {
        dim: [fit_tree(units(found), min(depth, 14), SEED + t) for t in range(trees)]
        for dim, found in by_dim.items()
    }


def route(entries: DataFrame, model: dict[int, list[Tree]]) -> DataFrame:
    """(rep, n, label, vector, leaves): sorted ids of the leaves, over all trees, that hold the entry."""
    schema = StructType.fromDDL("rep long, n long, leaves array<long>").fields
    schema = StructType([*schema[:2], entries.schema["label"], entries.schema["vector"], schema[2]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(3).to_pylist()
            leaves: list[list[int]] = [[] for _ in vectors]
            dims = np.array([len(v) for v in vectors])
            for dim in set(dims.tolist()):
                rows = np.flatnonzero(dims == dim)
                here = units([vectors[r] for r in rows])
                # a dimension that the sample missed has one leaf
                for t, tree in enumerate(model.get(dim, [])):
                    for r, found in zip(rows.tolist(), tree.leaves(here)):
                        leaves[r].extend((dim << 32) + (t << 20) + k for k in found)
                if dim not in model:
                    for r in rows.tolist():
                        leaves[r] = [dim << 32]
            leaves = [sorted(x) for x in leaves]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaves, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "leaves"],
            )

    return entries.select("rep", "n", "label", "vector").mapInArrow(run, schema)


def _local_roots(matched: np.ndarray) -> np.ndarray:
    """Smallest index of each row's component under a symmetric boolean matrix."""
    root = np.full(len(matched), -1)
    for i in range(len(matched)):
        if root[i] >= 0:
            continue
        root[i], queue = i, [i]
        while queue:
            found = np.flatnonzero(matched[queue.pop()] & (root < 0))
            root[found] = i
            queue.extend(found.tolist())
    return root


def compare(frame: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links of one cell: per entry the vectors it links with here, and the smallest id of its group."""
    frame = frame.sort_values("rep", ignore_index=True)
    here = units(frame["vector"].tolist())
    matched = here @ here.T >= cosine
    mine = frame["mine"].to_numpy()
    first, second = int(frame["low"][0]), int(frame["high"][0])
    if first != second:  # two blocks: only pairs across them
        matched &= mine[:, None] != mine[None, :]
    np.fill_diagonal(matched, False)
    i, j = np.nonzero(np.triu(matched))
    leaf = int(frame["leaf"][0])
    width = max(map(len, frame["leaves"]))
    lists = np.full((len(frame), width), -1, np.int64)
    for k, found in enumerate(frame["leaves"]):
        lists[k, : len(found)] = found
    lists[lists >= leaf] = -1
    for at in range(0, len(i), 50_000):  # a pair that meets in a smaller leaf is counted there
        a, b = lists[i[at : at + 50_000]], lists[j[at : at + 50_000]]
        met = ((a[:, :, None] == b[:, None, :]) & (a[:, :, None] >= 0)).any((1, 2))
        x, y = i[at : at + 50_000][met], j[at : at + 50_000][met]
        matched[x, y] = matched[y, x] = False
    links = matched @ frame["n"].to_numpy(np.int64)
    root = frame["rep"].to_numpy()[_local_roots(matched)]
    out = pd.DataFrame({"rep": frame["rep"], "links": links, "root": root})
    return out[out["links"] > 0]


def near_duplicates(
    vectors: DataFrame,
    cosine: float = COSINE,
    trees: int = TREES,
    leaf: int = LEAF,
    sample: int = SAMPLE,
    block: int = BLOCK,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding, label).

    Vectors of one label and one dimension link if their cosine is at least ``cosine``; pairs that no
    leaf holds together are missed, all others are exact. Rows that are NULL, zero or hold NULL or
    non-finite components, or have a NULL label or vec_id, link with nothing. Repeated rows are vectors
    of their own: each links with the others. An empty frame gives an empty frame.
    """
    rows = stored(keyed(vectors), "vectors")
    entries = rows.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("rep"),
        F.count(F.lit(1)).alias("n"),
        F.first("label").alias("label"),
        F.first("embedding").alias("vector"),
    )
    entries = stored(entries, "entries")
    model = forest(entries, entries.count(), trees, leaf, sample)
    routed = stored(route(entries, model), "routed")
    cells = routed.select("label", F.explode("leaves").alias("leaf")).groupBy("label", "leaf")
    large = cells.agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > block)
    spread = routed.select("rep", "n", "label", "vector", "leaves", F.explode("leaves").alias("leaf"))
    spread = spread.join(large, ["label", "leaf"], "left")
    blocks = F.ceil(F.coalesce("size", F.lit(1)) / F.lit(block)).cast("long")
    spread = spread.withColumn("mine", F.pmod(F.xxhash64("rep"), blocks))
    other = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("other")
    spread = spread.select("*", other).drop("size")
    spread = spread.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
    found = spread.drop("other").groupBy("label", "leaf", "low", "high").applyInPandas(
        lambda frame: compare(frame, cosine), "rep long, links long, root long"
    )
    found = stored(found, "links")
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    named = (
        entries.select("key", "rep", "n")
        .join(links, "rep", "left")
        .join(roots, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("key").alias("of_key"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("component_id"),
        )
    )
    component = F.coalesce("component_id", "vec_id")
    return rows.join(named, F.col("key") == F.col("of_key"), "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id") == component).alias("kept"),
    )
