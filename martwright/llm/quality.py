"""Quality rules as a short-circuit cascade.

Every text is counted once. The rules' cost and selectivity are measured on a bounded sample, inside
the tasks; the rules then run in the order of rejections per cost, and a text that one rejects is not
shown to the next. Rules are pure functions of one text, so the order changes the time but never the
verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Rows, at most about, on which cost and selectivity are measured.
SAMPLE_ROWS = 2000

_KIND = np.zeros(256, np.uint8)
_KIND[list(SPACES)] = 1
_KIND[list(SYMBOLS)] = 2
_KIND[128:192] = 4  # continuation bytes of UTF-8


@dataclass(frozen=True)
class Counts:
    n_words: int
    word_chars: int
    n_symbols: int
    n_lines: int
    n_dup_lines: int
    n_repeat_words: int

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or (
            100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words
        )


def counts(text: bytes) -> Counts:
    words = text.split()
    kinds = np.bincount(_KIND[np.frombuffer(text, np.uint8)], minlength=5)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return Counts(
        n_words=len(words),
        word_chars=int(len(text) - kinds[1] - kinds[4]),
        n_symbols=int(kinds[2]),
        n_lines=len(lines),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=repeat_words(words),
    )


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    code, size = ids[:n], len(number)
    for k in range(1, window):
        if size * len(number) >= 2**62:  # number the codes anew so that they stay exact
            found, code = np.unique(code, return_inverse=True)
            size = len(found)
        code, size = code * len(number) + ids[k : n + k], size * len(number)
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    twice = np.zeros(n + 1, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += twice[:n]
    edges[window : window + n] -= twice[:n]
    return int((np.cumsum(edges[:-1]) > 0).sum())


Rule = Callable[[bytes, Counts], bool]


def too_many_symbols(text: bytes, c: Counts) -> bool:
    """More than one symbol for ten words."""
    return 10 * c.n_symbols > c.n_words


def odd_word_length(text: bytes, c: Counts) -> bool:
    """Mean word length below 2 or above 15 code points."""
    return c.word_chars < 2 * c.n_words or c.word_chars > 15 * c.n_words


def repeated_lines(text: bytes, c: Counts) -> bool:
    """More than three in ten lines repeat an earlier one."""
    return 10 * c.n_dup_lines > 3 * c.n_lines


def mostly_capitals(text: bytes, c: Counts) -> bool:
    """More capitals than small letters, A-Z against a-z."""
    letters = np.bincount(np.frombuffer(text, np.uint8), minlength=128)
    return bool(letters[65:91].sum() > letters[97:123].sum())


def shouted_words(text: bytes, c: Counts) -> bool:
    """More than one doubled exclamation mark for ten words."""
    return 10 * text.count(b"!!") > c.n_words


RULES: dict[str, Rule] = {
    f.__name__: f
    for f in (too_many_symbols, odd_word_length, repeated_lines, mostly_capitals, shouted_words)
}


def measure(docs: DataFrame, rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """(cost in seconds a text, share rejected) of each rule, from a sample of about ``rows`` texts.

    Every rule sees every sampled text. Only one row per rule reaches the driver. Rules of an empty
    sample cost 1 and reject nothing.
    """
    total = docs.count()
    sample = docs.select(F.col("text").cast("binary").alias("text"))
    if total > rows:
        sample = sample.sample(fraction=rows / total, seed=7)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        took, hit, seen = dict.fromkeys(RULES, 0), dict.fromkeys(RULES, 0), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                text = text or b""
                c = counts(text)
                seen += 1
                for name, rule in RULES.items():
                    began = time.perf_counter_ns()
                    hit[name] += rule(text, c)
                    took[name] += time.perf_counter_ns() - began
        yield pa.RecordBatch.from_pydict(
            {"rule": list(RULES), "ns": list(took.values()), "hit": list(hit.values())}
            | {"seen": [seen] * len(RULES)}
        )

    found = sample.mapInArrow(run, "rule string, ns long, hit long, seen long").groupBy("rule")
    rows_of = found.agg(F.sum("ns"), F.sum("hit"), F.sum("seen")).collect()
    known = {r[0]: (r[1] / 1e9 / r[3], r[2] / r[3]) for r in rows_of if r[3]}
    return {name: known.get(name, (1.0, 0.0)) for name in RULES}


def cascade(measured: dict[str, tuple[float, float]]) -> list[str]:
    """Rules by rejection per cost, the best first; equal ones by name."""
    return sorted(measured, key=lambda n: (-measured[n][1] / max(measured[n][0], 1e-12), n))


def score(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """All columns of ``docs`` and the counts, base_failed and kept.

    A NULL text has no words and fails. Repeated rows are judged alike, an empty frame gives an empty
    frame. Input columns named like a result are replaced. Needs no shuffle.
    """
    order = cascade(measure(docs)) if order is None else order
    added = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    added += ", base_failed boolean, kept boolean"
    names = [x.split()[0] for x in added.split(", ")]
    docs = docs.drop(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = [RULES[name] for name in order]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for text in batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist():
                text = text or b""
                c = counts(text)
                kept = not c.base_failed and not any(rule(text, c) for rule in rules)
                row = (c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat_words)
                for column, value in zip(rows, (*row, c.base_failed, kept)):
                    column.append(value)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(r, k) for r, k in zip(rows, kinds))],
                names=[*batch.schema.names, *names],
            )

    result = StructType([*docs.schema.fields, *StructType.fromDDL(added).fields])
    return docs.mapInArrow(run, result)
