"""Token ids in wavelet matrix files, one succinct file per shard.

A file holds the ids of consecutive documents as bit planes, the highest bit first; each plane is the
stable partition of the ids by the plane before. With the ones counted at every 512th bit, access,
rank and select of any symbol need one probe per plane (Claude, Navarro, Ordonez: The wavelet matrix).

Format, little-endian: ``WVM1``, u32 bits, u64 ids, u64 documents; per document i64 doc_id, u8 whether
it is NULL, u64 end; per plane u64 zeros, u32 ones before every 512th bit, the bits, lowest first.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import stored
from martwright.llm.tokens import encoder, forget_encoder, vocabulary

MAGIC = b"WVM1"
BLOCK = 512
END_ID = 2
BITS = 16
#: Ids after which a file is closed; a document is never divided, so a longer one makes a longer file.
FILE_IDS = 1 << 19
#: Ids of a plane that are moved together; their places take 8 bytes each.
MOVED = 1 << 16
#: About as many bytes of text are encoded together; documents are not divided.
ENCODED = 1 << 22
#: A row of the index is a file of about a megabyte: a page for each, where a hundred of them would be held, and
#: compressed at once, before Parquet looks at their size; and no dictionary of them.
FILE_PAGES = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.enable.dictionary": "false"}


def _places(bit: np.ndarray) -> Iterator[tuple[slice, np.ndarray, slice, np.ndarray]]:
    """Where the bits that are not set, and those that are, come from and go to in a stable partition: the
    stretch of the partition and the places in the plane, for both, a stretch of the plane after the other."""
    low, high = 0, len(bit) - np.count_nonzero(bit)
    for at in range(0, len(bit), MOVED):
        part = bit[at : at + MOVED]
        ones, zeros = np.flatnonzero(part) + at, np.flatnonzero(~part) + at
        yield slice(low, low + len(zeros)), zeros, slice(high, high + len(ones)), ones
        low, high = low + len(zeros), high + len(ones)


def build(ids: np.ndarray, doc_ids: list[int | None], ends: np.ndarray, bits: int = BITS) -> bytes:
    """The file of ``ids``, all below 2**bits; ``ends`` are the documents' ends."""
    null = np.array([d is None for d in doc_ids], np.uint8)
    out = [
        MAGIC,
        struct.pack("<IQQ", bits, len(ids), len(doc_ids)),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        null.tobytes(),
        np.asarray(ends, "<u8").tobytes(),
    ]
    now = np.asarray(ids)
    for level in range(bits - 1, -1, -1):
        bit = (now & now.dtype.type(1 << level)) != 0
        packed = np.packbits(bit, bitorder="little")
        padded = np.zeros(-(-len(bit) // BLOCK) * BLOCK // 8, np.uint8)
        padded[: len(packed)] = packed
        ones = np.bitwise_count(padded.view("<u8")).astype(np.int64).reshape(-1, BLOCK // 64).sum(1)
        before = np.r_[0, np.cumsum(ones)].astype("<u4")
        out += [struct.pack("<Q", len(bit) - int(ones.sum())), before.tobytes(), padded.tobytes()]
        parted = np.empty_like(now)
        for low, zeros_at, high, ones_at in _places(bit):
            parted[low], parted[high] = now[zeros_at], now[ones_at]
        now = parted
    return b"".join(out)


class WaveletMatrix:
    """Reads a file of ``build`` in place."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        self.bits, self.n, n_docs = struct.unpack_from("<IQQ", data, 4)
        at = 24

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        ids, null = take("<i8", n_docs), take("u1", n_docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(ids, null)]
        self.ends = take("<u8", n_docs).astype(np.int64)
        blocks = -(-self.n // BLOCK)
        self.zeros, self.before, self.planes = [], [], []
        for _ in range(self.bits):
            self.zeros.append(int(take("<u8", 1)[0]))
            self.before.append(take("<u4", blocks + 1).astype(np.int64))
            self.planes.append(take("u1", blocks * BLOCK // 8))

    def _ones(self, level: int, at: int) -> int:
        """Ones before position ``at`` of a plane."""
        block, plane = at // BLOCK, self.planes[level]
        low = block * BLOCK // 8
        part = int.from_bytes(plane[low : -(-at // 8)].tobytes(), "little")
        return int(self.before[level][block]) + (part & ((1 << (at - 8 * low)) - 1)).bit_count()

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        value = 0
        for level in range(self.bits):
            ones = self._ones(level, i)
            bit = int(self.planes[level][i // 8]) >> (i % 8) & 1
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _walk(self, symbol: int, at: int) -> tuple[int, int]:
        low = 0
        for level in range(self.bits):
            ones_low, ones_at = self._ones(level, low), self._ones(level, at)
            if symbol >> (self.bits - 1 - level) & 1:
                low, at = self.zeros[level] + ones_low, self.zeros[level] + ones_at
            else:
                low, at = low - ones_low, at - ones_at
        return low, at

    def rank(self, symbol: int, at: int) -> int:
        """Occurrences of ``symbol`` before position ``at``."""
        if not 0 <= symbol < 1 << self.bits:
            return 0
        low, high = self._walk(symbol, at)
        return high - low

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def select(self, symbol: int, k: int) -> int:
        """Position of occurrence ``k`` (from 0) of ``symbol``; IndexError if there are fewer."""
        if not 0 <= k < self.count(symbol):
            raise IndexError(k)
        return self._climb(symbol, np.array([self._walk(symbol, 0)[0] + k]))[0]

    def _select_bits(self, level: int, wanted: np.ndarray, one: bool) -> np.ndarray:
        """Positions of the bits numbered ``wanted`` (from 0) that are set, or not set, in a plane."""
        before = self.before[level]
        if not one:
            before = np.arange(len(before)) * BLOCK - before
        block = np.searchsorted(before, wanted, "right") - 1
        cells = block[:, None] * (BLOCK // 8) + np.arange(BLOCK // 8)
        bits = np.unpackbits(self.planes[level][cells], axis=1, bitorder="little") == one
        inside = (np.cumsum(bits, axis=1) == (wanted - before[block] + 1)[:, None]) & bits
        return block * BLOCK + inside.argmax(axis=1)

    def occurrences(self, symbol: int) -> list[int]:
        """Positions of ``symbol``, in order; 1,000 at a time climb the planes together."""
        low, n = self._walk(symbol, 0)[0], self.count(symbol)
        out: list[int] = []
        for first in range(0, n, 1000):
            out += self._climb(symbol, np.arange(low + first, low + min(n, first + 1000)))
        return out

    def _climb(self, symbol: int, at: np.ndarray) -> list[int]:
        for level in range(self.bits - 1, -1, -1):
            one = bool(symbol >> (self.bits - 1 - level) & 1)
            at = self._select_bits(level, at - self.zeros[level] if one else at, one)
        return at.tolist()

    def decode(self) -> np.ndarray:
        """All ids at once, from the last plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        now = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            bit = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            now[self.zeros[level] :] |= kind(1 << (self.bits - 1 - level))
            up = np.empty_like(now)
            for low, zeros_at, high, ones_at in _places(bit):
                up[zeros_at], up[ones_at] = now[low], now[high]
            now = up
        return now


def write_index(docs: DataFrame, path: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Files (shard, file, n_ids, data) of all ``docs`` (doc_id, text), as a table in the shared folder.

    Documents lie in ascending doc_id order through (shard, file), NULL ids first, rows of one id by
    their ids' bytes. Shards are ranges of doc_id with about equal numbers of documents; a range is cut
    into files as it is written, so no task holds more than one file. A NULL text is an empty one.
    """
    path = path or vocabulary("word_bpe_49k.json")
    spark = docs.sparkSession
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [k / shards for k in range(1, shards)]
    bounds = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, cuts)), F.lit(20 * shards))).first()[0] if cuts else []
    edges = np.array(sorted(set(bounds or [])), np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens_of = encoder(path, glued=False)
        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy().astype(np.int64)
            cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // ENCODED)) + 1
            for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(low, high - low)
                ids = part.column(0)
                shard = np.searchsorted(edges, ids.fill_null(0).to_numpy()).astype(np.int32)
                shard[ids.is_null().to_numpy(zero_copy_only=False)] = 0
                data = tokens_of.encode_words(part.column(1))
                yield pa.RecordBatch.from_arrays([pa.array(shard), ids, data], names=["shard", "doc_id", "ids"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_encoder(path, glued=False)  # all texts are encoded
        held: list[tuple] = []
        shard = file = total = 0

        def close() -> pa.RecordBatch:
            end = np.uint16(end_id).tobytes()
            ends = np.cumsum([len(x) // 2 + 1 for _, x in held])
            ids = np.frombuffer(end.join([x for _, x in held]) + end, "<u2")
            data = build(ids, [d for d, _ in held], ends)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary())
            columns = [pa.array([v], k) for v, k in zip((shard, file, int(ends[-1]), data), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["shard", "file", "n_ids", "data"])

        for batch in batches:
            for at, doc_id, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (at != shard or total >= file_ids):
                    yield close()
                    file, total, held = (file + 1 if at == shard else 0), 0, []
                shard = at
                held.append((doc_id, ids))
                total += len(ids) // 2 + 1
        if held:
            yield close()

    tokens = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encode, "shard int, doc_id long, ids binary"
    )
    sorted_ids = tokens.repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", "ids")
    files = sorted_ids.mapInArrow(write, "shard int, file int, n_ids long, data binary")
    return stored(files, "index", FILE_PAGES)


def read_index(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files.

    Starts before a file are a running sum over one small row per file: inside the shards first, then
    over the shards.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, file, data in zip(*(batch.column(k) for k in range(3))):
                matrix = WaveletMatrix(data.as_py())
                ids, ends = matrix.decode().astype("<u4"), matrix.ends
                starts = np.r_[0, ends[:-1]].astype(np.int64)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, shard.as_py(), np.int32)),
                        pa.array(np.full(n, file.as_py(), np.int32)),
                        pa.array(matrix.doc_ids, pa.int64()),
                        pa.array(starts),
                        pa.array(ends - starts),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["shard", "file", "doc_id", "at", "n_tokens", "ids_crc32"],
                )

    rows = files.select("shard", "file", "data").mapInArrow(
        read, "shard int, file int, doc_id long, at long, n_tokens long, ids_crc32 long"
    )
    sizes = files.select("shard", "file", "n_ids")
    in_shard = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    over = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    files_at = sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(in_shard), F.lit(0)))
    starts = files_at.join(shards, "shard").select("shard", "file", (F.col("base") + F.col("inside")).alias("before"))
    return rows.join(starts, ["shard", "file"]).select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
