"""Exact removal of repeated word windows through compacted de Bruijn paths.

The k-mers (windows of ``WINDOW`` words) are the edges of a de Bruijn graph over the corpus. Writing
each edge out would cost many times the text, so edges leave a document already compacted:

1. Each window has a minimizer, its ``ANCHOR``-word part of smallest hash. Consecutive windows with
   the same minimizer form a path; one row (minimizer, context, doc_id, start, edges) stands for it.
   Equal windows have equal minimizers at equal places, so equal edges always meet at a minimizer.
2. Rows whose minimizer occurs once are unique. The rest are grouped by (minimizer, context), context
   being a hash of every word on the path. A minimizer with one context is a nonbranching stretch: its first coordinate owns all its edges, and
   the edges of every other occurrence are repeats. No edge is looked at singly.
3. A minimizer with several contexts branches (a passage starts or ends there, or copies differ).
   Inside a context again the first coordinate stands for the rest; only these first occurrences are
   joined back to their text and opened into edges, and each edge's first coordinate is found.
4. The spans of a document that follow one source at one distance are put together and covered by
   windows. Each window's words are looked up at the source's coordinates: a BLAKE2b digest of them goes
   to the later document, and only windows whose own words have that digest are removed.

Keys before that are two 64-bit hashes (minimizer, and context or edge), so a chance agreement of
hashes removes nothing. A document is a doc_id together with a text: rows that repeat an id with
different texts are documents of their own, the one of smaller text hash being the earlier; rows
that repeat both are one document, and each of them keeps what that document keeps.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import stored

WINDOW = 20
ANCHOR = 6
#: Bytes of text that are hashed together.
CHUNK = 1 << 20

_U = np.uint64
_B1, _B2 = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_INV2 = _U(pow(int(_B2), -1, 2**64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHashes(dict):
    """64-bit hash of a word, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Hashed:
    """Word hashes of one text, and hashes of any of its spans."""

    def __init__(self, hashes: np.ndarray):
        self.n = len(hashes)
        powers = np.cumprod(np.r_[_U(1), np.full(self.n, _B2)])
        self.sums = np.r_[_U(0), np.cumsum(hashes * powers[:-1])]
        self.back = np.cumprod(np.r_[_U(1), np.full(self.n, _INV2)])
        self.hashes = hashes

    def span(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(_U))

    def paths(self) -> tuple[np.ndarray, ...]:
        """Per path: minimizer hash, its place, first window and last window."""
        n_windows = self.n - WINDOW + 1
        if n_windows < 1:
            return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
        m = self.n - ANCHOR + 1
        anchors = np.zeros(m, np.uint64)
        for k in range(ANCHOR):
            anchors = anchors * _B1 + self.hashes[k : k + m]
        anchors = _mix(anchors)
        value, place, width, wanted = anchors, np.arange(m), 1, WINDOW - ANCHOR + 1
        while width < wanted:  # leftmost minimum of growing ranges
            step = min(width, wanted - width)
            left = value[:-step] <= value[step:]
            place = np.where(left, place[:-step], place[step:])
            value = np.where(left, value[:-step], value[step:])
            width += step
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], n_windows] - 1
        return value[first], place[first], first, last


def _columns(**arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays.values()], names=list(arrays))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _texts(docs: DataFrame) -> tuple[Column, DataFrame]:
    """What tells texts of one doc_id apart, and the documents (doc_id, row, text in bytes), each once.

    ``row`` is 0 if no id repeats, else the hash of the text.
    """
    ids = docs.where("doc_id IS NOT NULL")
    texts = ids.select("doc_id", F.lit(0).cast("long").alias("row"), F.col("text").cast("binary").alias("text"))
    if ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return F.lit(0).cast("long"), texts
    row = F.xxhash64("text")
    texts = texts.withColumn("row", row).dropDuplicates(["doc_id", "row"])
    return row, stored(texts, "texts")


def paths(texts: DataFrame) -> DataFrame:
    """Compacted paths (m, c, doc_id, row, at, size) of ``texts``: windows at .. at + size - 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            ids, marks, pending, rows = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0, []
            for doc_id, row, text in zip(ids, marks, batch.column(2)):
                words = (text.as_py() or b"").split()
                if len(words) < WINDOW:
                    continue
                h = Hashed(known.of(words))
                m, place, first, last = h.paths()
                # where the minimizer lies is part of what must agree
                c = h.span(first, last + WINDOW) + _mix((place - first).astype(_U))
                keys = np.full(len(m), doc_id), np.full(len(m), row)
                rows.append((_signed(m), _signed(c), *keys, first, last - first + 1))
                pending += len(m)
                if pending > 200_000:
                    yield out(rows)
                    rows, pending = [], 0
            if rows:
                yield out(rows)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        m, c, doc_id, row, at, size = (np.concatenate(x) for x in zip(*rows))
        return _columns(m=m, c=c, doc_id=doc_id, row=row, at=at.astype(np.int32), size=size.astype(np.int16))

    return texts.mapInArrow(run, "m long, c long, doc_id long, row long, at int, size short")


def edges_of(firsts: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges (m, e, doc_id, row, at) of the paths ``firsts`` (m, doc_id, row, at, size), from their texts."""
    cut = F.collect_list(F.struct("at", "size", "m")).alias("cut")
    wanted = firsts.groupBy("doc_id", "row").agg(cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            pending, rows = 0, []
            ids, marks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, row, text, cut in zip(ids, marks, batch.column(2), batch.column(3)):
                h = Hashed(known.of((text.as_py() or b"").split()))
                fields = cut.values
                at, size, m = (fields.field(k).to_numpy() for k in range(3))
                inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                start = (np.repeat(at, size) + inside).astype(np.int64)
                e = _signed(h.span(start, start + WINDOW))
                keys = np.full(len(e), doc_id), np.full(len(e), row)
                rows.append((np.repeat(m, size), e, *keys, start.astype(np.int32)))
                pending += len(e)
                if pending > 200_000:
                    yield out(rows)
                    pending, rows = 0, []
            if rows:
                yield out(rows)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        m, e, doc_id, row, at = (np.concatenate(x) for x in zip(*rows))
        return _columns(m=m, e=e, doc_id=doc_id, row=row, at=at)

    joined = texts.join(wanted, ["doc_id", "row"]).select("doc_id", "row", "text", "cut")
    return joined.mapInArrow(run, "m long, e long, doc_id long, row long, at int")


def _repeats(texts: DataFrame) -> DataFrame:
    """Spans (doc_id, row, at, end, from_doc, from_row, from_at) of ``texts``, found by hashes.

    The paths are stored once, as counting and joining read them; what joins them is stored first, so
    that both sides are plain shuffles and adaptive execution can split a hot minimizer.
    """
    everything = stored(paths(texts), "all_paths")
    twice = everything.groupBy("m").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("m")
    rows = stored(everything.join(stored(twice, "twice"), "m"), "paths")
    place = F.struct("doc_id", "row", "at")
    first = F.min(place).alias("first")
    classes = rows.groupBy("m", "c").agg(first, F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    classes = stored(classes, "classes")
    ways = classes.groupBy("m").agg(F.count(F.lit(1)).alias("ways")).where("ways > 1").select("m")

    def later(found: DataFrame, firsts: DataFrame, keys: list[str], size: Column) -> DataFrame:
        again = found.join(firsts, keys).where(place > F.col("first"))
        return again.select(
            "doc_id",
            "row",
            "at",
            (F.col("at") + size).alias("end"),
            F.col("first.doc_id").alias("from_doc"),
            F.col("first.row").alias("from_row"),
            F.col("first.at").alias("from_at"),
        )

    whole = later(
        rows, classes.where("n > 1").select("m", "c", "first"), ["m", "c"], F.col("size") + F.lit(WINDOW - 1)
    )
    branching = classes.join(ways, "m").select("m", "first.*", "size")
    edges = stored(edges_of(branching, texts), "edges")
    firsts = edges.groupBy("m", "e").agg(first, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return whole.union(later(edges, stored(firsts, "first_edges"), ["m", "e"], F.lit(WINDOW)))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Spans (doc_id, at, end, from_doc, from_at) of words whose windows start earlier elsewhere.

    ``at`` to ``end`` (exclusive) are word positions; from_doc and from_at say where the first of the
    windows starts for the first time. Documents with NULL doc_id have no coordinate and no spans.
    """
    return _repeats(_texts(docs)[1]).drop("row", "from_row")


def _covers(spans: DataFrame) -> DataFrame:
    """Windows (doc_id, row, at, from_doc, from_row, from_at) that cover ``spans`` and no other words.

    Spans of a document that repeat one source at one distance and touch are one stretch; a stretch
    takes a window every ``WINDOW`` words and one at its end. A list is as long as its document at most.
    """
    fields = "at", "end", "from_doc", "from_row", "from_at"
    grouped = spans.groupBy("doc_id", "row").agg(F.collect_list(F.struct(*fields)).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            size = lists.value_lengths().to_numpy()
            which = np.repeat(np.arange(len(lists)), size)
            flat = lists.flatten()
            at, end, doc, row, source = (flat.field(k).to_numpy().astype(np.int64) for k in range(5))
            order = np.lexsort((at, source - at, row, doc, which))
            which, at, end, doc, row, source = (x[order] for x in (which, at, end, doc, row, source))
            keys = np.stack([which, doc, row, source - at])
            group = np.cumsum(np.r_[0, (keys[:, 1:] != keys[:, :-1]).any(axis=0)]) << 32
            reach = np.maximum.accumulate(group + end)
            first = np.flatnonzero(np.r_[True, (group + at)[1:] > reach[:-1]])
            length = np.r_[reach[first[1:] - 1], reach[-1:]] - group[first] - at[first]
            windows = -(-length // WINDOW)
            turn = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
            shift = np.minimum(turn * WINDOW, np.repeat(length - WINDOW, windows))
            first = np.repeat(first, windows)
            here = pa.array(which[first])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(here),
                    batch.column(1).take(here),
                    pa.array((at[first] + shift).astype(np.int32)),
                    pa.array(doc[first]),
                    pa.array(row[first]),
                    pa.array((source[first] + shift).astype(np.int32)),
                ],
                names=["doc_id", "row", "at", "from_doc", "from_row", "from_at"],
            )

    schema = "doc_id long, row long, at int, from_doc long, from_row long, from_at int"
    return grouped.mapInArrow(run, schema)


def _digest(words: list[bytes], at: int) -> bytes:
    return hashlib.blake2b(b" ".join(words[at : at + WINDOW]), digest_size=16).digest()


def _source_digests(windows: DataFrame, texts: DataFrame) -> DataFrame:
    """(from_doc, from_row, from_at, digest) of the words at the coordinates that ``windows`` repeat.

    Each coordinate is read once; a document has at most one for each of its words.
    """
    wanted = windows.groupBy(F.col("from_doc").alias("doc_id"), F.col("from_row").alias("row"))
    wanted = wanted.agg(F.collect_set("from_at").alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            digests: list[bytes] = []
            for text, places in zip(batch.column(2), lists):
                words = (text.as_py() or b"").split()
                digests += [_digest(words, at) for at in places.values.to_numpy().tolist()]
            here = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            here = pa.array(here)
            keys = [batch.column(0).take(here), batch.column(1).take(here), lists.flatten()]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(digests, pa.binary())], names=["from_doc", "from_row", "from_at", "digest"]
            )

    joined = texts.join(wanted, ["doc_id", "row"]).select("doc_id", "row", "text", "places")
    return joined.mapInArrow(run, "from_doc long, from_row long, from_at int, digest binary")


def kept_words(words: list[bytes], repeats: list | None) -> list[bytes]:
    """``words`` without those of the windows ``repeats`` (at, digest) whose words have that digest."""
    edges = np.zeros(len(words) + 1, np.int64)
    for window in repeats or ():
        at = window["at"]
        if _digest(words, at) == window["digest"]:
            edges[at] += 1
            edges[at + WINDOW] -= 1
    gone = np.cumsum(edges[:-1]) > 0
    return [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words


def without_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """``docs`` without the words that repeat an earlier window of 20 words.

    A word goes if a window that covers it starts earlier too: in a document of smaller doc_id, or
    earlier in its own. Windows are judged on the input, and the words at both places are compared.
    Texts that lose words become their kept words joined by one space (n_chars, if there, follows); all
    other rows stay as they are. No row is dropped: a text that loses all becomes empty. NULL texts and
    rows with NULL doc_id stay. Rows that repeat a doc_id: see the module. Columns of any name pass
    through. With ``digest`` the result is (doc_id, n_words, n_removed, kept_sha256) instead.
    """
    mark, texts = _texts(docs)
    windows = stored(_covers(_repeats(texts)), "windows")
    digests = stored(_source_digests(windows, texts), "digests")
    pairs = windows.join(digests, ["from_doc", "from_row", "from_at"])
    repeats = pairs.groupBy("doc_id", "row").agg(F.collect_list(F.struct("at", "digest")).alias("repeats"))
    whole = docs.select("doc_id", "text") if digest else docs
    names = whole.columns
    # the row itself is one column, so that no name of it can clash
    rows = whole.select("doc_id", mark.alias("row"), F.struct(*map(whole.__getitem__, names)).alias("doc"))
    joined = rows.join(stored(repeats, "repeats"), ["doc_id", "row"], "left").select("doc", "repeats")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = dict(zip(names, batch.column(0).flatten()))
            texts, repeats = columns["text"].cast(pa.binary()).to_pylist(), batch.column(1)
            split = [(text or b"").split() if digest or found.is_valid else None for text, found in zip(texts, repeats)]
            kept = [None if words is None else kept_words(words, r.as_py()) for words, r in zip(split, repeats)]
            if digest:
                columns = {
                    "doc_id": columns["doc_id"],
                    "n_words": pa.array([len(x) for x in split], pa.int64()),
                    "n_removed": pa.array([len(x) - len(y) for x, y in zip(split, kept)], pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256(b" ".join(x)).hexdigest() for x in kept], pa.string()),
                }
            else:
                fewer = [k is not None and len(k) < len(x) for x, k in zip(split, kept)]
                texts = [b" ".join(k) if less else text for text, k, less in zip(texts, kept, fewer)]
                columns["text"] = pa.array(texts, pa.binary()).cast(pa.string())
                if "n_chars" in columns:
                    size = pa.compute.utf8_length(columns["text"]).cast(columns["n_chars"].type)
                    columns["n_chars"] = pa.compute.if_else(pa.array(fewer, pa.bool_()), size, columns["n_chars"])
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    if digest:
        return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return joined.mapInArrow(run, docs.schema)


def verify_spans(spans: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``spans`` whose first window is not the same words at both of its coordinates."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    texts = docs.select(F.col("doc_id").alias("d"), words.alias("w"))
    here = spans.join(texts, F.col("doc_id") == F.col("d")).drop("d").withColumnRenamed("w", "here")
    both = here.join(texts, F.col("from_doc") == F.col("d")).drop("d")
    size = F.lit(WINDOW)
    at, source = F.slice("here", F.col("at") + 1, size), F.slice("w", F.col("from_at") + 1, size)
    return both.where(at != source).drop("here", "w")
