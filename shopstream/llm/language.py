"""Language identification (operator 12): multinomial naive Bayes over hashed
character n-grams.

Letters are lower-cased and every run of other characters is one space; the
n-grams of one to four characters of a text are hashed into ``BUCKETS``
features.  Training counts the features of every row with a language, inside
the tasks, and Spark adds the counts up; the smoothed log probabilities are one
small matrix, languages x buckets, which is broadcast.  A batch of texts is a
sparse matrix of features, in rows of bucket numbers, and its product with
the matrix gives each text's log likelihoods.

Very many languages are taken in slices of ``SLICE``, so the matrix at hand is
of bounded size whatever the table holds; every slice is one more look at the
texts, and carries the best language and the sum so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import as_struct, materialized, mix, sliced, with_doc

ORDERS = (1, 2, 3, 4)
BITS = 16
BUCKETS = 1 << BITS
SMOOTHING = 0.5
SLICE = 32              # languages of a matrix: 16 MB
HELD_LANGUAGES = 64     # languages whose counts a task holds: 32 MB
BATCH_BYTES = 1 << 20
UNKNOWN = "und"
_SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The lower-case form of every letter, by code point; 0 for all else."""
    out = np.zeros(0x110000, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts, one after another, and how many each has
    (a text without letters has none)."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    cp = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _letters()[cp]
    letter = low > 0
    # a space after each word; the line feed behind a text ends its last one
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    row = np.repeat(np.arange(len(texts)), lens + 1)[keep]
    c = np.where(letter, low, _SPACE)[keep].astype(np.uint64)
    out, rows = [], []
    with np.errstate(over="ignore"):
        h = np.zeros(len(c), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            if n > len(c):
                break
            h = mix(h[:len(c) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + c[n - 1:] + np.uint64(n))
            if n not in ORDERS:
                continue
            inside = row[:len(h)] == row[n - 1:]
            out.append((h[inside] >> np.uint64(64 - BITS)).astype(np.int32))
            rows.append(row[:len(h)][inside])
    if not out:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    counts = [np.bincount(r, minlength=len(texts)) for r in rows]
    total = np.sum(counts, axis=0)
    # text by text, an order after the other
    flat = np.empty(int(total.sum()), np.int32)
    begin = np.cumsum(total) - total
    for values, n in zip(out, counts, strict=True):
        flat[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(len(values))] = values
        begin = begin + n
    return flat, total


# ---------------------------------------------------------------- training
@dataclass
class Model:
    """``languages`` in ascending order, the log of the share of rows of each,
    and where the counts (language, bucket, n) are kept."""

    languages: list[str]
    prior: np.ndarray
    counts: DataFrame

    def slices(self) -> Iterator[tuple[list[int], np.ndarray]]:
        """Numbers of the languages of a slice, and their log probabilities
        (languages x buckets).  At most SLICE * BUCKETS counts come here."""
        for a in range(0, len(self.languages), SLICE):
            part = list(range(a, min(len(self.languages), a + SLICE)))
            place = {self.languages[i]: i - a for i in part}
            n = np.zeros((len(part), BUCKETS))
            for b in self.counts.where(F.col("language").isin(list(place))).toArrow().to_batches():
                at = [place[x] for x in b.column("language").to_pylist()]
                n[at, np.asarray(b.column("bucket"))] = np.asarray(b.column("n"))
            yield part, np.log(n + SMOOTHING) - np.log(n.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)


def _counted(rows: DataFrame) -> DataFrame:
    """Counts by language and bucket of rows (language, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def shut():
            for name, n in held.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                    names=["language", "bucket", "n"])
            held.clear()

        for b in sliced(batches, limit=BATCH_BYTES):
            flat, total = features(b.column("text").to_pylist())
            names = b.column("language").dictionary_encode()
            of = np.repeat(np.asarray(names.indices), total)
            for i, name in enumerate(names.dictionary.to_pylist()):
                n = np.bincount(flat[of == i], minlength=BUCKETS)
                held[name] = held[name] + n if name in held else n
            if len(held) > HELD_LANGUAGES:
                yield from shut()
        yield from shut()

    return (rows.select("language", "text").mapInArrow(run, "language string, bucket int, n long")
            .groupBy("language", "bucket").agg(F.sum("n").alias("n")))


def train(docs: DataFrame, learn: Column) -> Model:
    """Counts over all rows of ``docs`` (text, lang) where ``learn`` holds and
    lang is not null; a null text is empty and only counts for the prior."""
    rows = docs.where(learn & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("language"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # one row per language
    shares = sorted((r.language, r.n) for r in rows.groupBy("language").agg(F.count("*").alias("n")).collect())
    n = np.array([x for _, x in shares], np.float64)
    counts = materialized(_counted(rows), "language-counts")
    return Model([x for x, _ in shares], np.log(n / max(n.sum(), 1.0)), counts)


# ----------------------------------------------------------------- scoring
def log_likelihoods(flat: np.ndarray, total: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Texts x languages: the sparse rows of features times the matrix."""
    out = np.zeros((len(total), len(matrix)))
    there = np.flatnonzero(total)
    if len(there):
        begin = (np.cumsum(total) - total)[there]
        for j, line in enumerate(matrix):
            out[there, j] = np.add.reduceat(line[flat], begin)
    return out


STATE = "best int, top double, mass double"


def _scored(rows: DataFrame, part: list[int], prior: np.ndarray, matrix: np.ndarray) -> DataFrame:
    """One slice of languages: ``best`` and its log posterior ``top`` so far,
    and ``mass``, the sum of all languages' posteriors over that of ``best``."""
    sent = rows.sparkSession.sparkContext.broadcast((np.asarray(part, np.int32), prior[part], matrix))
    carried = [c for c in rows.columns if c in ("best", "top", "mass")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, prior, matrix = sent.value
        for b in sliced(batches, limit=BATCH_BYTES):
            flat, total = features(b.column("text").to_pylist())
            each = log_likelihoods(flat, total, matrix) + prior
            at = each.argmax(axis=1)
            top = each[np.arange(len(at)), at]
            mass = np.exp(each - top[:, None]).sum(axis=1)
            best = np.where(total > 0, numbers[at], -1).astype(np.int32)
            if carried:
                old = [np.asarray(b.column(c)) for c in ("best", "top", "mass")]
                high = np.maximum(old[1], top)
                mass = old[2] * np.exp(old[1] - high) + mass * np.exp(top - high)
                best, top = np.where(old[1] >= top, old[0], best).astype(np.int32), high
            yield pa.RecordBatch.from_arrays([b.column("doc"), b.column("text"), pa.array(best), pa.array(top), pa.array(mass)],
                                             names=["doc", "text", "best", "top", "mass"])

    return rows.mapInArrow(run, with_doc(rows, f"text string, {STATE}"))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` as the struct ``doc``, with lang_pred and score.

    lang_pred is the learned language of the greatest posterior (of equal ones
    the first by name), score that posterior, 0 to 1.  A null text, one
    without a letter, and every text if nothing was learned is ``und`` with
    score 0.  Only the text is looked at.  Repeated rows are answered each; an
    empty table gives no rows.
    """
    rows = as_struct(docs)
    out = rows.withColumns({"best": F.lit(-1), "top": F.lit(0.0), "mass": F.lit(1.0)}) if not model.languages else rows
    for part, matrix in model.slices():
        out = _scored(out, part, model.prior, matrix)
    known = F.col("best") >= 0
    names = F.array(*[F.lit(x) for x in model.languages]) if model.languages else F.array(F.lit(UNKNOWN))
    return out.select("doc", F.when(known, F.element_at(names, F.col("best") + 1)).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
                      F.when(known, F.least(F.lit(1.0), 1 / F.col("mass"))).otherwise(F.lit(0.0)).alias("score"))


def held_out(doc_id: str, modulus: int = 4, rest: int = 2) -> Column:
    """Whether a row is kept from training; one without doc_id is not held out
    (and not learned from either, see ``language_digests``)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % modulus == rest, F.lit(False))


def language_digests(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learned from the
    rows that are not held out."""
    model = train(docs, ~held_out("doc_id") & F.col("doc_id").isNotNull())
    return identify(docs, model).select(F.col("doc.doc_id").cast("long").alias("doc_id"), held_out("doc.doc_id").alias("held_out"),
                                        "lang_pred", "score")
