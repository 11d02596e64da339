"""Alignment of two tokenizers' tokens (operator 11) by pointer jumping.

Both tokenizers cut the same bytes.  Every token points to the token that
overlaps it and ends farthest right; where a token of either kind ends at the
same byte, the first tokenizer's one points to itself.  Doubling the pointers,
``next = next[next]`` over all tokens of a batch at once, leads every token
to the terminal one of its component, which labels the group.

A document's linked id pairs are counted once per document.  Spark adds these
up over the corpus, and joins the counts back to each document's pairs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import as_lists, materialized, sliced, utf8
from shopstream.llm.pieces import default_vocabulary, encoder, sentencepiece_encoder

BATCH_BYTES = 1 << 20
LARGE = 1 << 12             # links of a group beyond which ids are counted first
CHUNK = 1 << 20             # links, or pairs of a row, at a time
BROADCAST_PAIRS = 1 << 20   # counted pairs that are sent to all tasks: 64 MB


def second_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# ------------------------------------------------------------- token bytes
def _byte_letters() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable
    Latin-1 stands for itself, the others for 256, 257, ..."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class TokenBytes:
    """The bytes of every id: ``data[start[i]:start[i] + size[i]]``."""

    data: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, values: list[bytes]) -> TokenBytes:
        size = np.fromiter(map(len, values), np.int64, len(values))
        return cls(np.frombuffer(b"".join(values), np.uint8), np.cumsum(size) - size, size)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        return self.data[np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


@lru_cache(maxsize=2)
def byte_level(path: str) -> TokenBytes:
    """Of a byte-level ``.json`` vocabulary; added tokens, which plain text
    never yields, are empty."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    letters = _byte_letters()
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        if all(c in letters for c in token):
            out[i] = bytes(letters[c] for c in token)
    return TokenBytes.of(out)


@lru_cache(maxsize=2)
def marked(path: str) -> TokenBytes:
    """Of a sentencepiece ``.model``: marks are spaces, byte pieces a byte."""
    lib = sentencepiece_encoder(path).lib
    return TokenBytes.of([bytes([int(lib.id_to_piece(i)[3:-1], 16)]) if lib.is_byte(i)
                          else lib.id_to_piece(i).replace("▁", " ").encode() for i in range(lib.vocab_size())])


# --------------------------------------------------------------- alignment
def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group (from 0, in order) of each token of two cuttings of the same
    bytes, given the ends of their tokens."""
    n, m = len(ends_a), len(ends_b)
    over = np.searchsorted(ends_b, ends_a)          # the token that holds the last byte
    back = np.searchsorted(ends_a, ends_b)
    terminal = ends_b[over] == ends_a
    far = np.concatenate([np.where(terminal, np.arange(n), n + over), back])
    while True:
        ahead = far[far]
        if np.array_equal(ahead, far):
            break
        far = ahead
    label = (np.cumsum(terminal) - 1)[far]
    return label[:n], label[n:]


def _per_text(ids: np.ndarray, counts: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids[np.repeat(keep, counts)], counts[keep]


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values))
    return np.diff(total[np.append(0, np.cumsum(counts))])


class Aligned:
    """Tokens and groups of texts that both tokenizers give back exactly;
    ``kept`` tells which of the given texts those are."""

    def __init__(self, texts: list[str], path_a: str, path_b: str):
        spaced = [" " + t for t in texts]
        a, na = encoder(path_a, special_as_text=True).encode(spaced)
        b, nb = sentencepiece_encoder(path_b).encode(spaced)
        bytes_a, bytes_b = byte_level(path_a), marked(path_b)
        raw, off = utf8(pa.array(spaced, pa.large_string()))
        size = np.diff(off)
        ok = np.fromiter(map(bool, texts), bool, len(texts))
        ok &= (_sums(bytes_a.size[a], na) == size) & (_sums(bytes_b.size[b], nb) == size)
        raw, _ = _per_text(raw, size, ok)
        a, na = _per_text(a, na, ok)
        b, nb = _per_text(b, nb, ok)
        wrong = (bytes_a.joined(a) != raw) | (bytes_b.joined(b) != raw)
        good = _sums(wrong, size[ok]) == 0
        if not good.all():
            a, na = _per_text(a, na, good)
            b, nb = _per_text(b, nb, good)
            ok[np.flatnonzero(ok)] = good
        self.kept, self.a, self.na, self.b, self.nb = ok, a.astype(np.int64), na, b.astype(np.int64), nb
        self.group_a, self.group_b = groups(np.cumsum(bytes_a.size[a]), np.cumsum(bytes_b.size[b]))
        self.p, self.q = np.bincount(self.group_a), np.bincount(self.group_b)
        row_a = np.repeat(np.arange(len(na)), na)
        self.row = row_a[np.append(0, np.cumsum(self.p))[:-1]] if len(self.p) else np.zeros(0, np.int64)    # of a group
        self.n_groups = np.bincount(self.row, minlength=len(na))
        self.n_links = _sums(self.p * self.q, self.n_groups)

    def named(self) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        n = len(self.a) + len(self.b)
        begin_a, begin_b = np.cumsum(self.p) - self.p, np.cumsum(self.q) - self.q
        at_a = np.arange(len(self.a)) + begin_b[self.group_a]
        at_b = np.arange(len(self.b)) + (begin_a + self.p)[self.group_b]
        ids, mark = np.zeros(n, np.int64), np.full(n, ord(","), np.uint8)
        ids[at_a], ids[at_b] = self.a, self.b
        mark[(begin_a + begin_b + self.p - 1)] = ord("|")
        mark[(begin_a + begin_b + self.p + self.q - 1)] = ord(";")
        digits = np.ones(n, np.int64)
        power = 10
        while n and power <= ids.max():
            digits += ids >= power
            power *= 10
        width = digits + 1
        end = np.cumsum(width)
        out = np.empty(int(end[-1]) if n else 0, np.uint8)
        out[end - 1] = mark
        left, at, rest = np.arange(n), end - 2, ids
        while len(left):
            out[at] = 48 + rest % 10
            more = rest >= 10
            left, at, rest = left[more], at[more] - 1, rest[more] // 10
        cut = np.append(0, end)[np.append(0, np.cumsum(self.na + self.nb))].tolist()
        return [out[s:e - 1].tobytes() for s, e in zip(cut[:-1], cut[1:], strict=True)]

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Linked id pairs: text, id, id, links; a part at a time, whose pairs
        are distinct, and all pairs of the texts of small groups in one."""
        begin_a, begin_b = np.cumsum(self.p) - self.p, np.cumsum(self.q) - self.q
        large = self.p * self.q > LARGE
        texts_large = np.zeros(len(self.na), bool)
        texts_large[self.row[large]] = True
        i = np.flatnonzero(~large[self.group_a])
        n = self.q[self.group_a[i]]
        total = np.cumsum(n)
        cut = 0
        while cut < len(i):
            # texts stay whole: up to the end of the one that passes CHUNK links
            e = int(np.searchsorted(total, (total[cut - 1] if cut else 0) + CHUNK))
            if e < len(i):
                text = self.row[self.group_a[i[e]]]
                e = int(np.searchsorted(self.row[self.group_a[i]], text, side="right"))
            k, c = i[cut:e], n[cut:e]
            g = self.group_a[k]
            other = np.repeat(begin_b[g] - (np.cumsum(c) - c), c) + np.arange(int(c.sum()))
            yield _distinct(np.repeat(self.row[g], c), np.repeat(self.a[k], c), self.b[other], None)
            cut = e
        for g in np.flatnonzero(large).tolist():
            x, nx = np.unique(self.a[begin_a[g]:begin_a[g] + self.p[g]], return_counts=True)
            y, ny = np.unique(self.b[begin_b[g]:begin_b[g] + self.q[g]], return_counts=True)
            step = max(1, CHUNK // len(y))
            for s in range(0, len(x), step):
                u, nu = x[s:s + step], nx[s:s + step]
                size = len(u) * len(y)
                yield (np.full(size, self.row[g]), np.repeat(u, len(y)), np.tile(y, len(u)), np.outer(nu, ny).ravel())

    def texts_with_large(self) -> np.ndarray:
        out = np.zeros(len(self.na), bool)
        out[self.row[self.p * self.q > LARGE]] = True
        return out


def _distinct(row, a, b, n):
    order = np.lexsort((b, a, row))
    row, a, b = row[order], a[order], b[order]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)
    at = np.flatnonzero(new)
    return row[at], a[at], b[at], np.diff(np.append(at, len(row)))


ROWS = ("place long, doc_id long, first boolean, parted boolean, n_a long, n_b long, n_groups long, n_links long, "
        "groups string, a array<int>, b array<int>, n array<long>")


def _aligned(docs: DataFrame, path_a: str, path_b: str, digest: bool) -> DataFrame:
    """A row per document, and further ones (not ``first``) with more of its
    pairs; ``parted``: the document's pairs may occur in several rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, limit=BATCH_BYTES):
            al = Aligned([t or "" for t in b.column("text").to_pylist()], path_a, path_b)
            n, kept = b.num_rows, np.flatnonzero(al.kept)
            parted = np.zeros(n, bool)
            parted[kept] = al.texts_with_large()
            own = []
            for values in (al.na, al.nb, al.n_groups, al.n_links):
                full = np.zeros(n, np.int64)
                full[kept] = values
                own.append(full)
            named = [""] * n
            for i, text in zip(kept.tolist(), al.named(), strict=True):
                named[i] = hashlib.sha256(text).hexdigest() if digest else text.decode()
            none = np.zeros(n, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("place"), b.column("doc_id"), pa.array(none == 0), pa.array(parted), *map(pa.array, own),
                 pa.array(named, pa.string()), *[as_lists(np.zeros(0, t), none) for t in (np.int32, np.int32, np.int64)]],
                names=NAMES)
            for row, x, y, c in al.pairs():
                at = kept[row]
                there = np.flatnonzero(np.append(True, np.diff(at) != 0)) if len(at) else np.zeros(0, np.int64)
                size, of = np.diff(np.append(there, len(at))), pa.array(at[there])
                m = len(there)
                zero = pa.array(np.zeros(m, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [b.column("place").take(of), b.column("doc_id").take(of), pa.array(np.zeros(m, bool)), pa.array(parted[at[there]]),
                     zero, zero, zero, zero, pa.array([""] * m, pa.string()),
                     as_lists(x.astype(np.int32), size), as_lists(y.astype(np.int32), size), as_lists(c.astype(np.int64), size)],
                    names=NAMES)

    return docs.select("place", "doc_id", "text").mapInArrow(run, ROWS)


NAMES = [x.split()[0] for x in ROWS.split(", ")]


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, digest: bool = True,
          broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_a, n_b, n_groups, n_links,
    n_best, count_sum and groups (``a1,a2|b1;a3|b2,b3``, or with ``digest`` its
    SHA-256).

    ``path_a`` is a byte-level ``.json`` vocabulary, which gets a space in
    front of the text, ``path_b`` a sentencepiece ``.model``, which adds one.
    Special tokens in a text are plain text.  Bytes at which tokens of both end
    cut them into groups; all pairs of a group are linked.  The count of an id
    pair is the number of rows that hold it linked; n_best are the links whose
    count is the highest of their first id's.  A null or empty text, and one
    that either tokenizer doesn't give back byte by byte, has zeros and ''.
    Repeated rows are documents each; a null doc_id stays null; other columns
    are ignored; an empty table gives no rows.
    """
    path_a, path_b = path_a or default_vocabulary(), path_b or second_vocabulary()
    rows = docs.select(F.monotonically_increasing_id().alias("place"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))
    found = materialized(_aligned(rows, path_a, path_b, digest), "aligned")
    key = (F.col("p.a").cast("long") * (1 << 31) + F.col("p.b")).alias("key")
    each = (found.where("not first").select("place", "parted", F.explode(F.arrays_zip("a", "b", "n")).alias("p"))
            .select("place", "parted", key, F.col("p.n").alias("n")))
    # a document whose pairs come in parts is added up first
    parted = each.where("parted").groupBy("place", "key").agg(F.sum("n").alias("n"))
    pairs = each.where("not parted").select("place", "key", "n").unionByName(parted)
    counts = pairs.groupBy("key").agg(F.count("*").alias("count")).withColumn("a", F.col("key").bitwiseAND(-(1 << 31)))
    counts = materialized(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))        # a row per id of the vocabulary at most
    scored = counts.join(most, "a").select("key", "count", (F.col("count") == F.col("most")).alias("best"))
    if counts.limit(broadcast_pairs + 1).count() <= broadcast_pairs:
        scored = F.broadcast(scored)
    sums = (pairs.join(scored, "key").groupBy("place")
            .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")))
    zero = F.lit(0).cast("long")
    return (found.where("first").select("place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups").join(sums, "place", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
                    F.coalesce("count_sum", zero).alias("count_sum"), "groups"))
