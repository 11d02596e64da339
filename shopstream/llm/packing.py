"""Packing of token sequences by harmonic classes (operator 7).

Lengths are dealt into reciprocal-capacity classes: class k holds lengths from
``capacity / (k + 1)`` (not itself) to ``capacity / k``, and each of its
sequences is filled with exactly k of them.  Documents longer than the
capacity give whole sequences first; what remains is classed.  As documents
may be cut, the room that the k documents leave is filled from the front of
the next document, whose rest is classed anew.  So there is one cut a sequence
at most, and no padding.  Each task fills the sequences of its own partition;
nothing is shuffled, and a task holds one open sequence per class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import id_and_text, sliced
from shopstream.llm.pieces import default_vocabulary, encoder

SCHEMA = ("doc_id long, start long, length long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")
SEQUENCE_BITS = 44      # sequences of a task; the rest of the id tells the task


def length_class(length: int, capacity: int) -> int:
    """How many pieces of this length a sequence holds."""
    return capacity // length


class _Packer:
    """Places documents of one task.  ``open`` has the pieces of each class
    that are fewer than its number; ``short`` those of the one sequence that
    has its number and waits for ``room`` more ids."""

    def __init__(self, capacity: int, task: int):
        self.capacity, self.next = capacity, task << SEQUENCE_BITS
        self.open: dict[int, list[tuple]] = {}
        self.short: list[tuple] = []
        self.room = 0
        self.out: list[tuple] = []

    def _full(self, pieces: list[tuple]):
        offset = 0
        for doc_id, start, tokens, ids in pieces:
            n = len(ids) // 4
            self.out.append((doc_id, start, n, tokens, self.next, offset, ids))
            offset += n
        self.next += 1

    def add(self, doc_id: int | None, ids: np.ndarray):
        tokens, start = len(ids), 0
        while tokens - start >= self.capacity:
            self._full([(doc_id, start, tokens, ids[start:start + self.capacity].tobytes())])
            start += self.capacity
        if self.room and start < tokens:
            end = min(tokens, start + self.room)
            self.short.append((doc_id, start, tokens, ids[start:end].tobytes()))
            self.room -= end - start
            start = end
            if not self.room:
                self._full(self.short)
                self.short = []
        if start == tokens:
            return
        k = length_class(tokens - start, self.capacity)
        pieces = self.open.setdefault(k, [])
        pieces.append((doc_id, start, tokens, ids[start:].tobytes()))
        if len(pieces) == k:
            del self.open[k]
            self.room = self.capacity - sum(len(x[3]) // 4 for x in pieces)
            if self.room:
                self.short = pieces
            else:
                self._full(pieces)

    def close(self):
        """What is left goes, longest first, into full sequences and then into
        one for each power of two of the rest, which need no padding."""
        rest = self.short + [x for k in sorted(self.open) for x in self.open[k]]
        total = sum(len(x[3]) // 4 for x in rest)
        tail = total % self.capacity
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << b for b in reversed(range(tail.bit_length())) if tail >> b & 1] if _power(self.capacity) else [tail] * (tail > 0)
        room, pieces, sizes = 0, [], iter(sizes)
        for doc_id, start, tokens, ids in rest:
            while ids:
                room = room or next(sizes)
                head, ids = ids[:4 * room], ids[4 * room:]
                pieces.append((doc_id, start, tokens, head))
                start, room = start + len(head) // 4, room - len(head) // 4
                if not room:
                    self._full(pieces)
                    pieces = []
        self.open, self.short, self.room = {}, [], 0

    def take(self) -> pa.RecordBatch:
        out, self.out = self.out, []
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(_TYPES)], names=NAMES)


NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
_TYPES = [pa.int64()] * 6 + [pa.binary()]


def _power(n: int) -> bool:
    return n & (n - 1) == 0


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end_id`` after those of each document."""
    total = counts + 1
    out = np.empty(int(total.sum()), np.uint32)
    ends = np.cumsum(total) - 1
    body = np.ones(len(out), bool)
    body[ends] = False
    out[body], out[ends] = ids, end_id
    return out, total


def pack(docs: DataFrame, capacity: int = 1024, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """Pack every document of ``docs`` (doc_id, text) into sequences.

    Returns one row per piece: doc_id, start (ids of the document before it),
    length, doc_tokens (with the end id), sequence_id, offset in the sequence,
    and ids (little-endian unsigned 32-bit).  A null or empty text has only
    the end id.  A null doc_id stays null; repeated rows are packed each for
    itself; other columns are ignored; an empty table gives no rows.  Only a
    task's last few sequences are shorter than ``capacity``.
    """
    if capacity < 1:
        raise ValueError("capacity must be 1 at least")
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, enc = _Packer(capacity, TaskContext.get().partitionId()), encoder(path)
        for b in sliced(batches):
            ids, counts = enc.encode(b.column("text").to_pylist())
            ids, lengths = with_end(ids, counts, end_id)
            ends = np.cumsum(lengths)
            for doc_id, end, n in zip(b.column("doc_id").to_pylist(), ends.tolist(), lengths.tolist(), strict=True):
                packer.add(doc_id, ids[end - n:end])
            yield packer.take()
        packer.close()
        yield packer.take()

    return id_and_text(docs).mapInArrow(run, SCHEMA)


def packed_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with the CRC-32 of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
