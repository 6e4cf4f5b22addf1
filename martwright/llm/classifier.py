"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every text becomes a row of statistics taken from all of its bytes, words and lines. The trees are
fitted on a sample of labelled rows of bounded size: the statistics are cut into at most ``BINS`` bins,
and each level of a tree adds the gradients up per (node, statistic, bin) and takes the best cut. The
trees are complete binary trees in flat arrays, so a batch of documents walks down all of them at once.

Scoring is one pass over the documents without a shuffle; only the sample of statistics and the fitted
arrays, whose sizes do not depend on the corpus, pass through the driver.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Labelled rows on which the trees are fitted, at most.
SAMPLE = 30_000
TREES, DEPTH, RATE = 60, 4, 0.15
BINS = 64
#: Weight that pulls the value of a leaf to zero, and the least second-order weight in a child.
SHRINK, LEAST = 1.0, 1.0
KEEP = 0.7
FOLDS, HELD_OUT = 4, 2

#: Classes of bytes whose shares are statistics.
CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "blank": b" \t",
    "newline": b"\n\r\x0b\x0c",
    "stop": b".?!",
    "bang": b"!",
    "comma": b",;:",
    "quote": b"\"'`",
    "symbol": b"#*$%&|<>",
    "bracket": b"()[]{}",
    "other_sign": b"@^_=+~\\/-",
    "not_ascii": range(128, 256),
    "control": [*range(0, 9), *range(14, 32), 127],
}
STATISTICS = [
    "log_chars",
    "log_words",
    "log_lines",
    *CLASSES,
    "entropy",
    "word_length",
    "word_length_deviation",
    "longest_word",
    "distinct_words",
    "top_word",
    "distinct_pairs",
    "word_after_itself",
    "one_byte_words",
    "words_with_capital",
    "words_ending_in_sign",
    "words_per_stop",
    "distinct_lines",
    "line_length",
    "line_length_deviation",
    "lines_ending_in_stop",
]

_MEMBERS = np.zeros((256, len(CLASSES)))
for _k, _of in enumerate(CLASSES.values()):
    _MEMBERS[list(_of), _k] = 1
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(b"\x20\x09\x0a\x0b\x0c\x0d")] = True
_IS_CAPITAL = np.zeros(256, bool)
_IS_CAPITAL[65:91] = True
_IS_SIGN = np.ones(256, bool)
_IS_SIGN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def statistics(text: bytes) -> list[float]:
    """One value per name in ``STATISTICS``; shares and means of nothing are zero."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text, np.uint8)
    seen = np.bincount(raw, minlength=256)
    share = seen / len(raw)
    present = share[share > 0]
    chars = len(raw) - int(seen[128:192].sum())
    space = _IS_SPACE[raw]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(~space & np.concatenate((space[1:], [True])))
    words = text.split()
    n = max(1, len(words))
    lengths = ends - starts + 1 if len(words) else np.zeros(1)
    pairs = len(set(zip(words, words[1:]))) if len(words) > 1 else n
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = [x for x in text.split(b"\n") if not x.isspace() and x]
    m = max(1, len(lines))
    widths = np.fromiter(map(len, lines), np.int64, len(lines)) if lines else np.zeros(1)
    stops = sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines)
    return [
        np.log1p(chars),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        *(share @ _MEMBERS),
        float(-(present * np.log2(present)).sum()),
        lengths.mean(),
        lengths.std(),
        np.log1p(lengths.max()),
        len(set(words)) / n,
        max(Counter(words).values(), default=0) / n,
        pairs / max(1, n - 1),
        same / n,
        (lengths == 1).sum() / n,
        _IS_CAPITAL[raw[starts]].sum() / n,
        _IS_SIGN[raw[ends]].sum() / n,
        np.log1p(n / (1 + seen[46] + seen[33] + seen[63])),
        len(set(lines)) / m,
        np.log1p(widths.mean()),
        np.log1p(widths.std()),
        stops / m,
    ]


def table(column: pa.Array) -> np.ndarray:
    """Statistics of a batch of texts; NULL counts as empty."""
    texts = column.cast(pa.binary()).to_pylist()
    return np.array([statistics(t or b"") for t in texts], np.float64).reshape(-1, len(STATISTICS))


@dataclass(frozen=True)
class Trees:
    """Flat complete trees: node k of a tree goes to 2k+1, or to 2k+2 where the statistic is above
    the cut; ``value`` holds one number per leaf."""

    base: float
    feature: np.ndarray  # tree x inner node
    cut: np.ndarray  # tree x inner node
    value: np.ndarray  # tree x leaf

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 per row."""
        trees, inner = self.feature.shape
        total = np.full(len(rows), self.base)
        which = np.arange(trees)[None, :]
        for at in range(0, len(rows), 4096):
            part = rows[at : at + 4096]
            line = np.arange(len(part))[:, None]
            node = np.zeros((len(part), trees), np.int64)
            for _ in range((inner + 1).bit_length() - 1):
                above = part[line, self.feature[which, node]] > self.cut[which, node]
                node = 2 * node + 1 + above
            total[at : at + 4096] += self.value[which, node - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray, labels: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS
) -> Trees:
    """Boosted trees for 0/1 ``labels``. Without rows of both labels every score is the share of
    label 1, drawn to one half: one row of each label is counted besides."""
    count, width = rows.shape
    share = (labels.sum() + 1) / (count + 2)
    inner, leaves = 2**depth - 1, 2**depth
    feature = np.zeros((trees, inner), np.int64)
    cut = np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    base = float(np.log(share / (1 - share)))
    if not 0 < labels.sum() < count:
        return Trees(base, feature, cut, value)
    levels = np.linspace(0, 1, bins + 1)[1:-1]
    edges = [np.unique(np.quantile(rows[:, f], levels)) for f in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    slot = binned + bins * np.arange(width)
    score = np.full(count, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = p - labels, p * (1 - p)
        node = np.zeros(count, np.int64)
        for level in range(depth):
            first, here = 2**level - 1, 2**level
            cells = (slot + ((node - first) * (bins * width))[:, None]).ravel()
            shape = (here, width, bins)
            g = np.bincount(cells, np.repeat(gradient, width), here * width * bins).reshape(shape)
            h = np.bincount(cells, np.repeat(weight, width), here * width * bins).reshape(shape)
            below_g, below_h = g.cumsum(axis=2)[:, :, :-1], h.cumsum(axis=2)[:, :, :-1]
            all_g, all_h = g.sum(axis=2, keepdims=True), h.sum(axis=2, keepdims=True)
            above_g, above_h = all_g - below_g, all_h - below_h
            gain = below_g**2 / (below_h + SHRINK) + above_g**2 / (above_h + SHRINK) - all_g**2 / (all_h + SHRINK)
            gain[(below_h < LEAST) | (above_h < LEAST)] = 0
            best = gain.reshape(here, -1).argmax(axis=1)
            which, at = np.divmod(best, bins - 1)
            good = gain.reshape(here, -1)[np.arange(here), best] > 1e-9
            for k in np.flatnonzero(good).tolist():
                # a bin past the last edge is never a cut, as nothing lies above it
                feature[t, first + k], cut[t, first + k] = which[k], edges[which[k]][at[k]]
            above = rows[np.arange(count), feature[t, node]] > cut[t, node]
            node = 2 * node + 1 + above
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, leaves), np.bincount(leaf, weight, leaves)
        value[t] = -rate * g / (h + SHRINK)
        score += value[t][leaf]
    return Trees(base, feature, cut, value)


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of doc_id as text leaves 2 when divided by 4. NULL is not."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % F.lit(FOLDS)
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees from documents (doc_id, text) and labels (doc_id, quality).

    Labels of held-out rows are never read further than their doc_id. A doc_id labelled both 0 and 1
    is not learnt from, nor one with another or no label. At most ``sample`` labels are taken, by the
    hash of their doc_id, and at most as many rows, should doc_ids repeat; that bounds both the labels
    sent to the tasks and the statistics sent to the driver.
    """
    given = labels.where("quality in (0, 1)").where(~held_out(F.col("doc_id")))
    one = given.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
    one = one.where("label = most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    names = ["text", "label"]
    chosen = docs.select("doc_id", "text").join(F.broadcast(one.drop("most")), "doc_id").select(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [r.tobytes() for r in table(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(raw, pa.binary()), batch.column(1).cast(pa.int64())], names=["raw", "label"]
            )

    found = chosen.mapInArrow(run, "raw binary, label long")
    found = found.orderBy(F.xxhash64("raw"), "raw", "label").limit(sample).collect()
    rows = np.frombuffer(b"".join(r[0] for r in found), np.float64).reshape(-1, len(STATISTICS))
    return fit(rows, np.array([r[1] for r in found], np.float64))


def score(docs: DataFrame, model: Trees, keep: float = KEEP) -> DataFrame:
    """All columns of ``docs`` with score (0 to 1) and predicted (1 from ``keep`` on, else 0).

    Only ``text`` is looked at: NULL and empty texts are scored by their statistics, all zero. Texts of
    any length are counted whole. Equal texts have equal scores; input columns named like a result are
    replaced; an empty frame gives an empty frame.
    """
    docs = docs.drop("score", "predicted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            found = model.score(table(text))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found), pa.array((found >= keep).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"],
            )

    added = StructType.fromDDL("score double, predicted int").fields
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added]))
