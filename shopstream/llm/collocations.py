"""Phrase collocation mining (operator 13) by top-order marginalisation.

Only the longest windows are counted: from every word the next three, as
lead-window columns ``w1`` ... ``w4``, padded where a piece of text ends.  A
ROLLUP over the columns then sums windows that begin alike, which counts every
shorter phrase, so words are taken apart once and no order has an explosion of
its own.

The leads are taken inside the task that holds the text, and equal windows of
a batch are one row, so no word is shuffled by itself.  A window is also padded
from where its first words are surely too rare for a candidate: beginnings of
two, three and four words are counted in hashed counters first, whose number
grows with the text, and a counter below ``least`` bounds every phrase in it.
Phrases of ``least`` occurrences or more have no such beginning, so their
counts, and those of their parts, stay exact; a full sketch only pads fewer
windows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopstream.llm.common import _LOWER, binary_rows, materialized, mix, sliced, utf8
from shopstream.llm.pieces import span_hashes

ORDER = 4                       # words of the longest window
COLUMNS = [f"w{k}" for k in range(1, ORDER + 1)]
SKETCH_BITS = 24                # counters of each order's sketch, as a power of two: at least
MOST_BITS = 28                  # and at most; the bits of full counters are sent to the tasks
COUNTER_BYTES = 96              # bytes of text for each counter
BLOCK_BITS = 14                 # counters of a sketch that move together
BLOCKS_TOGETHER = 4096
HELD = 1 << 22                  # phrases that a task counts before it hands them on
BATCH_BYTES = 4 << 20
NO_LANGUAGE = "und"
SCALE = 2_000_000
_WORD, _GAP, _END = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _GAP
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _END


class Tokens:
    """Words of the texts of a column after lower-casing A-Z: ``word`` (numbers
    into ``words``), ``row``, and ``joined``: whether a word's next one follows
    in the same piece.  ``hash`` holds a hash per entry of ``words``."""

    def __init__(self, column: pa.Array):
        raw, off = utf8(column)
        kind = _KIND[_LOWER[raw]]
        n = len(raw)
        inside = np.append(kind == _WORD, False)
        begins, ends = inside[:n].copy(), inside[:n] & ~inside[1:]
        if n:
            begins[1:] &= ~inside[:n - 1]
            edge = off[1:-1]
            edge = edge[(edge > 0) & (edge < n)]
            begins[edge] = inside[edge]         # texts stand side by side
            ends[edge - 1] = inside[edge - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.row = np.searchsorted(off, start, side="right") - 1
        piece = np.cumsum(kind == _END)[start] if n else start
        self.joined = np.zeros(len(start), bool)
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (self.row[1:] == self.row[:-1])
        data, cut = _LOWER[raw][inside[:n]], np.append(0, np.cumsum(end - start))
        each = pa.Array.from_buffers(pa.large_string(), len(start), [
            None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]).dictionary_encode()
        self.word, self.words = np.asarray(each.indices, np.int64), each.dictionary
        own, at = utf8(self.words)
        self.hash = span_hashes(own, at[:-1], at[1:])


def _beginnings(t: Tokens, language: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For two words and more: the counter of each word and those after it,
    and whether they stand in one piece.  ``language`` is a hash of the
    language of each row."""
    each, n = t.hash[t.word], len(t.word)
    h, on = mix(each + language[t.row]), np.ones(n, bool)
    with np.errstate(over="ignore"):
        for k in range(1, ORDER):
            m = max(n - k, 0)
            h = mix(h[:m] * np.uint64(0x9E3779B97F4A7C15) + each[k:])
            on = on[:m] & t.joined[k - 1:k - 1 + m]
            yield (h >> np.uint64(64 - bits)).astype(np.int64) + ((k - 1) << bits), on


def _language(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Number, name and hash of each row's language."""
    named = column.dictionary_encode()
    raw, off = utf8(named.dictionary)
    number = np.asarray(named.indices, np.int64)
    return number, named.dictionary, span_hashes(raw, off[:-1], off[1:])[number]


# ------------------------------------------------------------------ sketch
def sketch_size(text_bytes: int) -> int:
    """Bits of a sketch for so many bytes of text: a counter for every
    ``COUNTER_BYTES`` of them, so that few counters reach ``least`` by phrases
    that only share them."""
    return min(max(SKETCH_BITS, math.ceil(math.log2(max(text_bytes / COUNTER_BYTES, 1)))), MOST_BITS)


def _frequent(rows: DataFrame, least: int, bits: int) -> np.ndarray:
    """Whether each counter of the sketches may hold a phrase of ``least``
    occurrences, as packed bits.  Counts stop at ``least``, which the sum then
    reaches as well.

    A task holds the counters it has met, not the sketch, and hands them on as
    places and counts by block: what it needs and what moves follow the text,
    whatever size the sketch has."""
    block = min(BLOCK_BITS, bits)
    size = 1 << block
    most = min(least, 255)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def shut():
            at, n = np.unique(np.concatenate(held), return_counts=True)
            first = np.flatnonzero(np.diff(at >> block, prepend=-1))
            ends = np.append(first, len(at))
            places, counts = (at & (size - 1)).astype(np.uint16), np.minimum(n, most).astype(np.uint8)
            for a in range(0, len(first), BLOCKS_TOGETHER):
                of = ends[a:a + BLOCKS_TOGETHER + 1]
                each = np.diff(of)
                yield pa.RecordBatch.from_arrays([pa.array((at[of[:-1]] >> block).astype(np.int32)),
                                                  binary_rows(places[of[0]:of[-1]], each), binary_rows(counts[of[0]:of[-1]], each)],
                                                 names=["block", "places", "counts"])

        for b in sliced(batches, limit=BATCH_BYTES):
            held += [bucket[on] for bucket, on in _beginnings(Tokens(b.column("text")), _language(b.column("lang"))[2], bits)]
            if sum(map(len, held)) >= HELD:
                yield from shut()
                held = []
        if held:
            yield from shut()

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, np.zeros(size, np.int64)

        def shut():
            bits = np.packbits(held >= most)
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits.tobytes()], pa.binary())],
                                              names=["block", "bits"])

        for b in batches:
            for at, places, counts in zip(b.column("block").to_pylist(), b.column("places"), b.column("counts"), strict=True):
                if at != block:
                    if block is not None and (held >= most).any():
                        yield shut()
                    block, held = at, np.zeros(size, np.int64)
                # a row names each place once
                held[np.frombuffer(places.as_buffer(), np.uint16)] += np.frombuffer(counts.as_buffer(), np.uint8)
        if block is not None and (held >= most).any():
            yield shut()

    sums = (rows.mapInArrow(count, "block int, places binary, counts binary").repartition("block").sortWithinPartitions("block")
            .mapInArrow(total, "block int, bits binary"))
    out = np.zeros((((ORDER - 1) << bits) // size, size // 8), np.uint8)
    for b in sums.toArrow().to_batches():       # 3 * 2**bits / 8 bytes in all
        for at, value in zip(b.column("block").to_pylist(), b.column("bits").to_pylist(), strict=True):
            out[at] = np.frombuffer(value, np.uint8)
    return out.ravel()


# ----------------------------------------------------------------- windows
def windows(t: Tokens, language: np.ndarray, goes_on: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct windows as rows of word numbers (-1: padded), the language of
    each, and how often it occurs.  ``goes_on[k]`` tells whether a word's window
    has another word after its first k + 1, if it has those."""
    n = len(t.word)
    cols = np.full((ORDER, n), -1, np.int64)
    cols[0], on = t.word, np.ones(n, bool)
    for k, more in enumerate(goes_on, 1):
        on = on[:len(more)] & more
        cols[k, :len(on)] = np.where(on, t.word[k:], -1)
    of = language[t.row]
    order = np.lexsort((*cols[::-1], of))
    cols, of = cols[:, order], of[order]
    new = np.ones(n, bool)
    new[1:] = (np.diff(of) != 0) | (np.diff(cols, axis=1) != 0).any(axis=0)
    at = np.flatnonzero(new)
    return cols[:, at], of[at], np.diff(np.append(at, n))


def _windows(rows: DataFrame, likely: np.ndarray, bits: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(likely)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = sent.value
        likely = lambda at: (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        for b in sliced(batches, limit=BATCH_BYTES):
            t = Tokens(b.column("text"))
            if not len(t.word):
                continue
            number, names, hashes = _language(b.column("lang"))
            cols, of, n = windows(t, number, [on & likely(bucket) for bucket, on in _beginnings(t, hashes, bits)])
            words = pa.concat_arrays([t.words, pa.array([""], t.words.type)])
            last = len(t.words)
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(of)).cast(pa.string()),
                 *[words.take(pa.array(np.where(c < 0, last, c))).cast(pa.string()) for c in cols], pa.array(n)],
                names=["lang", *COLUMNS, "n"])

    ddl = ", ".join(f"{c} string" for c in ("lang", *COLUMNS))
    return rows.mapInArrow(run, f"{ddl}, n long").groupBy("lang", *COLUMNS).agg(F.sum("n").alias("n"))


def phrase_counts(docs: DataFrame, least: int = 30, sketch_bits: int | None = None) -> DataFrame:
    """lang, phrase (space-joined), words (1 to 4) and f of every phrase of
    ``least`` occurrences or more, and per lang the row of words 0, which
    counts all word occurrences.  The sketch is sized by the text unless
    ``sketch_bits`` is given."""
    if not 1 <= least <= 255 or sketch_bits is not None and sketch_bits < 3:
        raise ValueError("least must be 1 to 255, as a byte counts, and sketch_bits 3 or more")
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if sketch_bits is None:
        sketch_bits = sketch_size(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    # read from a written table: the rollup takes its input six times
    counted = materialized(_windows(rows, _frequent(rows, least, sketch_bits), sketch_bits), "windows")
    rolled = counted.rollup("lang", *COLUMNS).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    # levels 31, 15, 7, 3, 1, 0: nothing, lang, w1, ... w4; a padded last
    # column is a shorter phrase, counted at its own level
    words = F.when(F.col("level") == 31, -1)
    for k in range(ORDER + 1):
        words = words.when(F.col("level") == (1 << (ORDER - k)) - 1, k)
    last = F.coalesce(*[F.col(c) for c in reversed(COLUMNS)])
    return (rolled.withColumn("words", words)
            .where((F.col("words") == 0) | (F.col("words") > 0) & (last != "") & (F.col("f") >= least))
            .select("lang", F.concat_ws(" ", *COLUMNS).alias("phrase"), "words", "f"))


# ------------------------------------------------------------------ scores
def _cuts(candidates: DataFrame) -> DataFrame:
    """A row per candidate and cut: k, and the first and the rest's phrase."""
    w = F.split("phrase", " ", -1)
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    return (candidates.select("lang", "phrase", "words", "a", cut)
            .withColumn("first", F.concat_ws(" ", F.slice(w, 1, F.col("k"))))
            .withColumn("rest", F.concat_ws(" ", F.slice(w, F.col("k") + 1, F.col("words") - F.col("k")))))


def collocations(docs: DataFrame, top: int = 2000, least: int = 30, sketch_bits: int | None = None) -> DataFrame:
    """Each language's ``top`` phrases of 2 to 4 words: lang, rank, phrase, a,
    l, r, n, score, k (where the phrase is cut).

    A-Z are lower-cased; ``. , ; : ! ?`` and line breaks cut texts into
    pieces, spaces and tabs cut pieces into words.  A phrase needs a = f(phrase)
    >= ``least`` occurrences, overlapping ones included; of its cuts the one of
    the lowest score floor(2000000 a / (l + r)) counts, of equal ones the
    first.  A phrase inside a longer candidate of 80 % of its occurrences or
    more goes.  Ties rank by a, then by the phrase's bytes.  A null lang is
    ``und``, a null text empty; repeated rows count each; an empty table gives
    no rows.
    """
    f = materialized(phrase_counts(docs, least, sketch_bits), "phrases")
    candidates = f.where("words > 1").withColumnRenamed("f", "a")
    part = lambda name, n: f.where("words > 0").select("lang", F.col("phrase").alias(name), F.col("f").alias(n))
    cuts = _cuts(candidates).join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = (cuts.withColumn("over", exact("a") * F.lit(SCALE)).withColumn("under", exact("l") + exact("r"))
            .withColumn("score", F.expr("cast(over div under as long)")))
    scored = cuts.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # contiguous parts of two words or more of each longer candidate
    w, size = F.split("phrase", " ", -1), F.col("size")
    longer = (candidates.where("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
              .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - size + 1)))
              .select("lang", F.concat_ws(" ", F.slice(w, F.col("at"), size)).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("inside")))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("inside").isNull() | (exact("inside") * 100 < exact("a") * 80))
    total = f.where("words = 0").select("lang", F.col("f").alias("n"))
    order = [F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # the first of each share before the first of all: no task orders all
    # phrases of a language
    shares = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    some = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").alias("score"), F.col("cut.k").cast("long").alias("k"))
