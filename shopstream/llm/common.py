"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shopstream.llm.pieces import mix, span_hashes
from shopstream.session import scratch_root

#: Texts are taken together inside a task up to so many characters.
BATCH_CHARS = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the cluster's shared folder; Spark creates it."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and
    still there when executors are lost."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, *more: str) -> DataFrame:
    """The columns an operator reads; a null text becomes the empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def as_struct(docs: DataFrame) -> DataFrame:
    """All columns as the struct ``doc``, so that none can clash with a
    result's, and the text, null as empty."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def with_doc(docs: DataFrame, ddl: str) -> StructType:
    """A schema of the struct ``doc`` and what ``ddl`` names."""
    return StructType([docs.schema["doc"], *StructType.fromDDL(ddl).fields])


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text at most, but
    of one row at least."""
    for b in batches:
        if not b.num_rows:
            continue
        size = np.asarray(pc.binary_length(b.column(column)).fill_null(0), np.int64)
        group = (np.cumsum(size) - size) // limit
        cut = np.flatnonzero(np.diff(group)) + 1
        for a, e in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows], strict=True):
            yield b.slice(a, e - a)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values of a string column, one after another, and the
    offsets of each; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(off):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]]
    return raw, off - off[0]


def binary_rows(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column whose rows hold the next ``lengths[i]`` items each."""
    ends = np.append(0, np.cumsum(lengths, dtype=np.int64)) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [
        None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def as_lists(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A list column whose rows hold the next ``lengths[i]`` items each."""
    ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


# ----------------------------------------------------------------- words
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


class Words:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the values of a string
    column after lower-casing A-Z: digits, a-z and every non-ASCII character.

    ``start``/``end`` are byte positions in ``data``; ``row`` tells the value,
    ``first[i]`` the index of the first word of value i.
    """

    def __init__(self, column: pa.Array):
        raw, off = utf8(column)
        self.data, self.off = _LOWER[raw], off
        n = len(raw)
        inside = np.zeros(n + 1, bool)
        inside[:n] = _WORD[self.data]
        begins = inside[:n].copy()
        ends = inside[:n] & ~inside[1:]
        if n:
            begins[1:] &= ~inside[:n - 1]
            edge = off[1:-1]
            edge = edge[(edge > 0) & (edge < n)]
            begins[edge] = inside[edge]     # values stand side by side
            ends[edge - 1] = inside[edge - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def shingle_hashes(words: Words, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of ``size`` words of each value, in order, and
    how many each value has; a shorter value with words has one shingle."""
    h = words.hashes()
    n = words.count
    m = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    at = np.repeat(words.first[:-1] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))
    last = np.repeat(words.first[1:], m)
    out = np.full(len(at), 0x243F6A8885A308D3, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            there = at + k < last
            w = h[np.minimum(at + k, max(len(h) - 1, 0))] if len(h) else h
            out = np.where(there, mix(out * np.uint64(0x9E3779B97F4A7C15) + w), out)
    return out, m
