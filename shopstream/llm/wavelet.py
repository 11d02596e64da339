"""Token ids in wavelet-matrix shards (operator 4).

Each shard is one binary value: a header, the documents it holds, and one
bit-plane per bit of the largest id, each with the number of ones before
every 512th bit.  The planes answer access, rank, select, counting and
occurrence lookup without decoding the shard; they are written by Spark as
zstd-compressed Parquet, a few shards a file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopstream.llm.common import id_and_text, sliced
from shopstream.llm.packing import with_end
from shopstream.llm.pieces import default_vocabulary, encoder

MAGIC = 0x31584D57      # "WMX1", little-endian
BLOCK = 512             # bits between two entries of a rank directory
SHARD_IDS = 1 << 20     # a shard is closed when it has so many ids
SHARD_SCHEMA = "part int, shard int, n_ids long, blob binary"
DOC_SCHEMA = "part int, shard int, doc_id long, local_start long, n_tokens long, ids_crc32 long, ids binary"


class WaveletMatrix:
    """A sequence of unsigned 32-bit ids as bit-planes, highest bit first."""

    def __init__(self, n: int, zeros: np.ndarray, planes: np.ndarray, ranks: np.ndarray):
        self.n, self.zeros, self.planes, self.ranks = n, zeros, planes, ranks
        self.levels = len(zeros)

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        levels = max(1, int(ids.max(initial=0)).bit_length())
        a = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        words = -(-len(a) // BLOCK) * BLOCK // 8
        zeros = np.zeros(levels, np.uint32)
        planes = np.zeros((levels, words), np.uint8)
        for k in range(levels):
            bit = (a & a.dtype.type(1 << (levels - 1 - k))) != 0
            packed = np.packbits(bit, bitorder="little")
            planes[k, :len(packed)] = packed
            low = a[~bit]
            zeros[k] = len(low)
            a = np.concatenate([low, a[bit]])
        return cls(len(ids), zeros, planes, cls._ranks(planes))

    @staticmethod
    def _ranks(planes: np.ndarray) -> np.ndarray:
        ones = np.bitwise_count(planes).reshape(len(planes), -1, BLOCK // 8).sum(axis=2, dtype=np.uint32)
        return np.concatenate([np.zeros((len(planes), 1), np.uint32), np.cumsum(ones, axis=1, dtype=np.uint32)], axis=1)

    # ------------------------------------------------------------- queries
    def _rank1(self, k: int, i: np.ndarray) -> np.ndarray:
        """Ones of plane k before position i."""
        i = np.asarray(i, np.int64)
        block = i // BLOCK
        out = self.ranks[k][block].astype(np.int64)
        rest = i - block * BLOCK
        width = BLOCK // 8
        at = block[..., None] * width + np.arange(width)
        got = self.planes[k][np.minimum(at, self.planes.shape[1] - 1)]
        bits = np.clip(rest[..., None] - np.arange(width) * 8, 0, 8).astype(np.uint8)
        mask = ((1 << bits.astype(np.uint16)) - 1).astype(np.uint8)
        return out + np.bitwise_count(got & mask).sum(axis=-1, dtype=np.int64)

    def _bit(self, k: int, i: np.ndarray) -> np.ndarray:
        return (self.planes[k][i >> 3] >> (i & 7).astype(np.uint8)) & 1

    def access(self, at) -> np.ndarray:
        """The ids at these positions."""
        i = np.atleast_1d(np.asarray(at, np.int64))
        out = np.zeros(len(i), np.uint32)
        for k in range(self.levels):
            one, r = self._bit(k, i).astype(bool), self._rank1(k, i)
            out = (out << np.uint32(1)) | one
            i = np.where(one, int(self.zeros[k]) + r, i - r)
        return out

    def rank(self, value: int, end: int) -> int:
        """How often ``value`` stands before position ``end``."""
        a, b = self._range(value, end)
        return b - a

    def count(self, value: int) -> int:
        return self.rank(value, self.n)

    def _range(self, value: int, end: int) -> tuple[int, int]:
        if value >> self.levels or not self.n:
            return 0, 0
        a, b = 0, end
        for k in range(self.levels):
            ra, rb = (int(x) for x in self._rank1(k, np.array([a, b])))
            if value >> (self.levels - 1 - k) & 1:
                a, b = int(self.zeros[k]) + ra, int(self.zeros[k]) + rb
            else:
                a, b = a - ra, b - rb
        return a, b

    def select(self, value: int, which) -> np.ndarray:
        """Positions of the ``which``-th occurrences (from 0), climbing the
        planes by a binary search over rank."""
        a, b = self._range(value, self.n)
        i = a + np.atleast_1d(np.asarray(which, np.int64))
        if len(i) and (i.min() < a or i.max() >= b):
            raise IndexError("no such occurrence")
        for k in reversed(range(self.levels)):
            one = value >> (self.levels - 1 - k) & 1
            want = i - int(self.zeros[k]) if one else i
            low, high = np.zeros(len(i), np.int64), np.full(len(i), self.n - 1, np.int64)
            while (low < high).any():
                mid = (low + high) // 2
                before = self._rank1(k, mid + 1)
                before = before if one else mid + 1 - before
                enough = before > want
                high, low = np.where(enough, mid, high), np.where(enough, low, np.minimum(mid + 1, high))
            i = low
        return i

    def positions(self, value: int) -> np.ndarray:
        return self.select(value, np.arange(self.count(value)))

    def decode(self) -> np.ndarray:
        """All ids, from the lowest plane up."""
        small = np.uint16 if self.levels <= 16 else np.uint32
        a = np.zeros(self.n, small)
        for k in reversed(range(self.levels)):
            bit = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            z, out = int(self.zeros[k]), np.empty(self.n, small)
            out[~bit], out[bit] = a[:z], a[z:] | small(1 << (self.levels - 1 - k))
            a = out
        return a.astype(np.uint32)

    # -------------------------------------------------------------- format
    def pack(self, doc_id: np.ndarray, known: np.ndarray, counts: np.ndarray) -> bytes:
        head = np.array([MAGIC, self.levels, self.n, len(doc_id)], "<u8")
        return b"".join(x.tobytes() for x in (
            head, doc_id.astype("<i8"), known.astype("<u1"), counts.astype("<u8"), self.zeros.astype("<u4"),
            self.ranks.astype("<u4"), self.planes))

    @classmethod
    def unpack(cls, blob: bytes):
        """The matrix, and the documents: ids, which are known, counts."""
        magic, levels, n, docs = (int(x) for x in np.frombuffer(blob, "<u8", 4))
        if magic != MAGIC:
            raise ValueError("not a wavelet-matrix shard")
        at = 32

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(blob, kind, count, at)
            at += out.nbytes
            return out

        doc_id, known, counts = take("<i8", docs), take("<u1", docs).astype(bool), take("<u8", docs).astype(np.int64)
        zeros, blocks = take("<u4", levels), -(-n // BLOCK)
        ranks = take("<u4", levels * (blocks + 1)).reshape(levels, blocks + 1)
        planes = take("<u1", levels * blocks * BLOCK // 8).reshape(levels, -1)
        return cls(n, zeros, planes, ranks), doc_id, known, counts


# ------------------------------------------------------------------ Spark
def write_shards(docs: DataFrame, path: str, end_id: int = 2, vocabulary: str | None = None,
                 shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` in ascending doc_id order and write shards to ``path``.

    ``end_id`` follows each document; a null text is empty.  A null doc_id
    stands first; repeated rows are written each (ties by text); other columns
    are ignored.  A task holds the ids of one shard: ``shard_ids`` and the rest
    of a document.
    """
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, enc = TaskContext.get().partitionId(), 0, encoder(vocabulary)
        held: list[tuple] = []

        def closed() -> pa.RecordBatch:
            ids, doc_id, known, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            blob = WaveletMatrix.of(ids).pack(doc_id, known, counts)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([blob], pa.binary())], names=["part", "shard", "n_ids", "blob"])

        for b in sliced(batches, limit=2 * shard_ids):
            ids, counts = with_end(*enc.encode(b.column("text").to_pylist()), end_id)
            known = np.asarray(b.column("doc_id").is_valid())
            doc_id = np.asarray(b.column("doc_id").fill_null(0), np.int64)
            held.append((ids, doc_id, known, counts))
            if sum(len(x[0]) for x in held) >= shard_ids:
                yield closed()
                held, shard = [], shard + 1
        if held:
            yield closed()

    ordered = id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (ordered.mapInArrow(run, SHARD_SCHEMA)
     .write.option("compression", "zstd").parquet(path))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD_SCHEMA).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """part, shard and the ids of all shards before it.  Only a total per part
    (one per writing task) meets in one place."""
    own = shards.select("part", "shard", "n_ids")
    parts = own.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("shard")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (own.withColumn("inside", inside).join(parts.select("part", before.alias("before")), "part")
            .select("part", "shard", (F.col("before") + F.col("inside")).alias("shard_start")))


def read_documents(shards: DataFrame, with_ids: bool = True) -> DataFrame:
    """Documents of the shards: doc_id, start over all shards, n_tokens,
    ids_crc32, and, if asked for, ids (little-endian unsigned 32-bit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, shard, blob in zip(*(b.column(k).to_pylist() for k in ("part", "shard", "blob")), strict=True):
                matrix, doc_id, known, counts = WaveletMatrix.unpack(blob)
                raw = memoryview(matrix.decode().astype("<u4")).cast("B")
                ends = np.cumsum(counts)
                spans = [raw[a * 4:e * 4] for a, e in zip((ends - counts).tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(counts), part, np.int32)), pa.array(np.full(len(counts), shard, np.int32)),
                     pa.array(doc_id, pa.int64(), mask=~known), pa.array(ends - counts), pa.array(counts),
                     pa.array([zlib.crc32(x) for x in spans], pa.int64()),
                     pa.array([bytes(x) for x in spans] if with_ids else [None] * len(spans), pa.binary())],
                    names=["part", "shard", "doc_id", "local_start", "n_tokens", "ids_crc32", "ids"])

    return (shards.select("part", "shard", "blob").mapInArrow(run, DOC_SCHEMA)
            .join(shard_starts(shards), ["part", "shard"])
            .select("doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32",
                    *(["ids"] if with_ids else [])))


def count_ids(shards: DataFrame, ids: list[int]) -> DataFrame:
    """How often each of ``ids`` stands in the shards, by rank alone."""
    wanted = sorted({int(i) for i in ids})

    def run(batches):
        for b in batches:
            for blob in b.column("blob").to_pylist():
                matrix = WaveletMatrix.unpack(blob)[0]
                yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()),
                                                  pa.array([matrix.count(i) for i in wanted], pa.int64())], names=["id", "n"])

    return shards.select("blob").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def find_id(shards: DataFrame, value: int) -> DataFrame:
    """Every place of one id: doc_id and position in the document, by select."""
    def run(batches):
        for b in batches:
            for blob in b.column("blob").to_pylist():
                matrix, doc_id, known, counts = WaveletMatrix.unpack(blob)
                at, ends = matrix.positions(value), np.cumsum(counts)
                doc = np.searchsorted(ends, at, side="right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_id[doc], pa.int64(), mask=~known[doc]), pa.array(at - (ends - counts)[doc])],
                    names=["doc_id", "position"])

    return shards.select("blob").mapInArrow(run, "doc_id long, position long")
