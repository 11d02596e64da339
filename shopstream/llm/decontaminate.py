"""Benchmark decontamination by a prefix-filtered set join (operator 6).

Benchmark items are cut into windows of consecutive words.  A document holds a
window only if it holds the window's rarest word (the necessary prefix when
the whole window must be contained), so words are ordered by how often they
occur in all documents, documents' words are joined to that one word of each
window, the position of the word bounds where the window can lie, and the
window's words are compared there.

The benchmark side is read in slices of at most ``max_windows`` windows, each
sent to the tasks as one small table; documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import Words, as_lists, as_struct, sliced, with_doc

FILTER_BITS = 20
RESULT = "n_words long, spans array<long>, items array<string>"


class Windows:
    """The windows of some items: hashes of their words, one row a window."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        words = Words(pa.array([t for _, t in items], pa.large_string()))
        h, n = words.hashes(), words.count
        per = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
        self.item = np.repeat(np.arange(len(items)), per)
        self.length = np.repeat(np.minimum(n, size), per)
        start = np.repeat(words.first[:-1] - (np.cumsum(per) - per), per) + np.arange(int(per.sum()))
        at = start[:, None] + np.arange(size)
        self.inside = np.arange(size) < self.length[:, None]
        self.words = np.where(self.inside, h[np.minimum(at, max(len(h) - 1, 0))] if len(h) else np.zeros(at.shape, np.uint64),
                              np.uint64(0))
        self.names = np.array([i for i, _ in items], object)
        self.vocabulary = np.unique(self.words[self.inside])

    def by_rarity(self, counts: np.ndarray) -> None:
        """Choose each window's rarest word; ties to the smaller hash."""
        where = np.searchsorted(self.vocabulary, self.words).clip(max=max(len(self.vocabulary) - 1, 0))
        often = counts[where] if len(counts) else np.zeros(self.words.shape, np.int64)
        often = np.where(self.inside, often, np.iinfo(np.int64).max)
        rank = np.lexsort((self.words.ravel(), often.ravel())).argsort().reshape(often.shape)
        self.offset = np.where(self.inside, rank, rank.size).argmin(axis=1) if len(rank) else np.zeros(0, np.int64)
        prefix = self.words[np.arange(len(self.offset)), self.offset]
        self.order = np.argsort(prefix, kind="stable")
        self.prefix, self.begin, self.count = np.unique(prefix[self.order], return_index=True, return_counts=True)


class _Filter:
    """Membership of 64-bit hashes in a sorted set, most misses by one look."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.flags = keys, np.zeros(1 << FILTER_BITS, bool)
        self.flags[(keys & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` of members, and which keys they are."""
        at = np.flatnonzero(self.flags[(h & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        k = np.searchsorted(self.keys, h[at]).clip(max=len(self.keys) - 1)
        same = self.keys[k] == h[at]
        return at[same], k[same]


def _matches(words: Words, w: Windows, find: _Filter) -> tuple[np.ndarray, np.ndarray]:
    """Every occurrence of a window: its first word, and which window."""
    h = words.hashes()
    at, key = find.find(h)
    n = w.count[key]
    which = w.order[np.repeat(w.begin[key] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    start = np.repeat(at, n) - w.offset[which]
    row = np.searchsorted(words.first, np.repeat(at, n), side="right") - 1
    fits = (start >= words.first[row]) & (start + w.length[which] <= words.first[row + 1])
    start, which = start[fits], which[fits]
    for k in range(w.words.shape[1]):
        if not len(start):
            break
        here = k < w.length[which]
        same = ~here | (h[np.minimum(start + k, len(h) - 1)] == w.words[which, k])
        start, which = start[same], which[same]
    return start, which


def _marked(words: Words, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(words.start)
    level = np.zeros(n + 1, np.int64)
    np.add.at(level, start, 1)
    np.add.at(level, end, -1)
    return np.cumsum(level)[:n] > 0


def _spans(words: Words, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of hit words of each row as start, end, start, end ..."""
    n = len(hit)
    edge = np.zeros(n + 1, bool)
    edge[words.first] = True
    before = np.append(False, hit[:-1]) & ~edge[:n] if n else hit
    after = np.append(hit[1:], False) & ~edge[1:] if n else hit
    s, e = np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after) + 1
    row = np.searchsorted(words.first, s, side="right") - 1
    out = np.stack([s - words.first[row], e - words.first[row]], axis=1).ravel()
    return out.astype(np.int64), 2 * np.bincount(row, minlength=len(words.count))


def _occurrences(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """How often each word of the vocabulary occurs in all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _Filter(sent.value)
        total = np.zeros(len(sent.value), np.int64)
        for b in sliced(batches):
            total += np.bincount(find.find(Words(b.column("text")).hashes())[1], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["word", "n"])

    out = np.zeros(len(vocabulary), np.int64)
    for r in (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "word long, n long")
              .groupBy("word").agg(F.sum("n").alias("n")).collect()):   # the slice's words at most
        out[r.word] = r.n
    return out


def _slices(benchmark: DataFrame, size: int, max_windows: int) -> Iterator[Windows]:
    held, windows = [], 0
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    for r in rows.toLocalIterator():
        held.append((r.item, r.text))
        windows += len(r.text) // 2 + 1     # a word and its separator
        if windows >= max_windows:
            yield Windows(held, size)
            held, windows = [], 0
    if held:
        yield Windows(held, size)


def _joined(rows: DataFrame, w: Windows) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        find = _Filter(w.prefix)
        for b in sliced(batches):
            words = Words(b.column("text"))
            start, which = _matches(words, w, find)
            old = b.column("spans")
            own = np.asarray(old.flatten(), np.int64).reshape(-1, 2)
            shift = words.first[np.repeat(np.arange(b.num_rows), np.asarray(old.value_lengths()) // 2)]
            hit = _marked(words, np.append(start, own[:, 0] + shift), np.append(start + w.length[which], own[:, 1] + shift))
            row = np.searchsorted(words.first, start, side="right") - 1
            pair = np.unique(row * max(len(w.names), 1) + w.item[which])
            r, i = np.divmod(pair, max(len(w.names), 1))
            found = as_lists(w.names[i].tolist() or pa.array([], pa.string()), np.bincount(r, minlength=b.num_rows))
            spans = as_lists(*_spans(words, hit))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), b.column("text"), pa.array(words.count.astype(np.int64)), spans, b.column("items"), found],
                names=["doc", "text", "n_words", "spans", "items", "found"])

    out = rows.select("doc", "text", "spans", "items").mapInArrow(
        run, with_doc(rows, f"text string, {RESULT}, found array<string>"))
    return out.select("doc", "text", "n_words", "spans", F.array_union("items", "found").alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, one_in: int = 20,
                  max_windows: int = 1 << 20) -> DataFrame:
    """Benchmark windows in each row of ``docs`` (text), all of whose columns
    are returned as the struct ``doc``, with n_words, spans (hit words as
    start, end, start, end ...), items (ids of the items found, as text),
    n_hit and contaminated: ``n_hit > 0`` and ``one_in * n_hit >= n_words``.

    A window is ``size`` consecutive words of an item, or a shorter item
    whole; items without words have none.  A null text has no words.  A null
    item id is named ''; items of the same id count once; an empty table on
    either side gives no hits.  Repeated rows are answered each.
    """
    rows = as_struct(docs).selectExpr("doc", "text", "CAST(array() AS array<bigint>) AS spans",
                                      "CAST(array() AS array<string>) AS items")
    empty = True
    for w in _slices(benchmark, size, max_windows):
        w.by_rarity(_occurrences(docs, w.vocabulary))
        rows, empty = _joined(rows, w), False
    if empty:
        rows = _joined(rows, _no_windows(size))
    n_hit = F.expr("aggregate(sequence(0, greatest(size(spans) div 2 - 1, 0)), 0L, "
                   "(a, i) -> a + if(size(spans) = 0, 0L, spans[2 * i + 1] - spans[2 * i]))")
    return (rows.drop("text").withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))))


def _no_windows(size: int) -> Windows:
    w = Windows([("", "")], size)
    w.by_rarity(np.zeros(0, np.int64))
    return w


def contamination_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    return found.select(F.col("doc.doc_id").alias("doc_id"), "n_words", "n_hit",
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")
