"""Near-duplicate documents by ProbMinHash (operator 8).

Every distinct shingle of five words is a Poisson process whose points fall on
random registers; a register keeps the shingle of its earliest point, so two
documents agree in a register with their probability Jaccard similarity.  All
shingles weigh the same, however often a document holds them: then that is the
Jaccard similarity of the sets of shingles, by which links are defined.  A
document stops drawing points when none can come earlier than what all of its
registers hold.

Registers are banded; documents of equal words are one text first, so copies
are never compared.  Texts that share a band are candidates: in buckets of up to
``SMALL`` texts all pairs; in larger ones each text with the pivot (the text
that meets most others), with those whose signatures agree best with its own,
and with some whose agreement allows a link, the same ones in every band.
Candidates are verified exactly: links of a similarity of 0.8 or more over the
sets of shingles make classes.  Then every other pair of a large bucket whose
texts are in different classes is verified as well, tile against tile, so only
buckets whose texts stay apart cost their square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import (Words, as_lists, id_and_text, materialized, mix, new_path, shingle_hashes, sliced)
from shopstream.llm.components import apart, components, spanning

BANDS, ROWS = 24, 5
REGISTERS = BANDS * ROWS
SMALL = 24
TILE = 4096         # signatures of a large bucket that are compared in one task
BEST, ANY = 8, 16   # partners of a text in all of its large buckets
LEAST = 0.65        # agreement that may still be a similarity of 0.8 (4 deviations)
# a tile whose pairs are all verified: bytes of shingles, and what a text counts
# besides them (1,024 texts at most)
SET_TILE, TEXT = 16 << 20, 16 << 10
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def weighted(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of each row with how often they occur, and their row."""
    row = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, row))
    h, r = hashes[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    at = np.flatnonzero(new)
    return h[at], r[at], np.diff(np.append(at, len(h)))


def prob_minhash(hashes: np.ndarray, row: np.ndarray, weight: np.ndarray, rows: int,
                 registers: int = REGISTERS) -> np.ndarray:
    """Signatures: for each row and register the hash of the winning element,
    0 for rows without elements."""
    first = np.full(rows * registers, np.inf)
    winner = np.zeros(rows * registers, np.uint64)
    h, r, w = hashes, row, 1.0 / weight
    time = np.zeros(len(h))
    state = mix(h + _GOLD)
    while len(h):
        with np.errstate(over="ignore"):
            state = mix(state + _GOLD)
            draw = mix(state ^ np.uint64(0xD1B54A32D192ED03))
        u = ((state >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0 ** -53
        time = time - np.log(u) * w
        slot = r * registers + (draw % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = first[slot] == time
        winner[slot[won]] = h[won]
        last = first.reshape(rows, registers).max(axis=1)
        go = time < last[r]
        h, r, w, time, state = h[go], r[go], w[go], time[go], state[go]
    return winner.reshape(rows, registers)


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One key per row and band."""
    parts = signatures.reshape(len(signatures), bands, -1)
    out = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD), parts.shape[:2]).copy()
    with np.errstate(over="ignore"):
        for k in range(parts.shape[2]):
            out = mix(out * _GOLD + parts[:, :, k])
    return out


SIGNED = "doc_id long, key binary, bands array<long>, signature binary"


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, key (of the words in order) and the band keys of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, limit=2 << 20):
            words = Words(b.column("text"))
            s, m = shingle_hashes(words)
            h, r, _ = weighted(s, m)
            signatures = prob_minhash(h, r, np.ones(len(h)), b.num_rows)
            keys = band_keys(signatures).view(np.int64)
            there = m > 0
            small = signatures.astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(_text_keys(words), pa.binary()),
                 as_lists(keys[there].ravel(), np.where(there, BANDS, 0)),
                 pa.array([x.tobytes() for x in small], pa.binary())], names=["doc_id", "key", "bands", "signature"])

    return docs.mapInArrow(run, SIGNED)


def _text_keys(words: Words) -> list[bytes]:
    """A 128-bit key of the words of each row, in order."""
    import xxhash

    h, first = np.ascontiguousarray(words.hashes()), words.first.tolist()
    raw = memoryview(h.view(np.uint8)) if len(h) else memoryview(b"")
    return [xxhash.xxh3_128_digest(raw[a * 8:e * 8]) for a, e in zip(first[:-1], first[1:], strict=True)]


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and the sorted distinct shingle hashes of each node."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, limit=2 << 20):
            h, r, _ = weighted(*shingle_hashes(Words(b.column("text"))))
            n = np.bincount(r, minlength=b.num_rows) * 8
            ends = np.append(0, np.cumsum(n)).tolist()
            raw = h.tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([raw[a:e] for a, e in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                names=["node", "shingles"])

    return (docs.join(nodes.select(F.col("node").alias("doc_id")).hint("shuffle_hash"), "doc_id", "left_semi")
            .mapInArrow(run, "node long, shingles binary").dropDuplicates(["node"]))


def jaccard(a: bytes, b: bytes) -> float:
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if not len(x) or not len(y):
        return 0.0
    at = np.searchsorted(x, y)
    both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
    return both / (len(x) + len(y) - both)


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [jaccard(x.as_py(), y.as_py()) for x, y in zip(b.column("x"), b.column("y"), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(s, pa.float64())],
                                             names=["a", "b", "similarity"])

    x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    # sets of very different sizes can't be similar enough
    fits = F.least(F.length("x"), F.length("y")) >= threshold * F.greatest(F.length("x"), F.length("y"))
    return (pairs.join(x, "a").join(y, "b").where(fits).select("a", "b", "x", "y")
            .mapInArrow(run, "a long, b long, similarity double").where(F.col("similarity") >= threshold))


def partners(signatures: np.ndarray, nodes: np.ndarray):
    """Partners of each text of a large bucket: the BEST that agree most, and
    the first ANY, by a hash of their ids, that agree in a share LEAST of the
    registers.  Places of text and partner, agreement, hash of the partner."""
    rank = mix(nodes.astype(np.uint64))
    order = np.argsort(rank)
    sig = np.ascontiguousarray(signatures[order].T)
    n, out = len(order), []
    for a in range(0, n, 256):
        e = min(n, a + 256)
        same = np.zeros((e - a, n), np.uint8)
        for column in sig:
            same += column[a:e, None] == column[None, :]
        same[np.arange(e - a), np.arange(a, e)] = 0
        close = same >= LEAST * len(sig)
        chosen = close & (np.cumsum(close, axis=1) <= ANY)
        if n > BEST:
            best = np.argpartition(same, n - BEST, axis=1)[:, n - BEST:]
            rows = np.arange(e - a)[:, None]
            chosen[rows, best] |= close[rows, best]
        x, y = np.nonzero(chosen)
        out.append((order[x + a], order[y], same[x, y]))
    x, y, agree = (np.concatenate(c) for c in zip(*out, strict=True))
    return x, y, agree, rank[y].view(np.int64)


FOUND = "node long, found array<struct<agree: int, rank: long, other: long>>"


def _close(large: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs of each text of large buckets with its partners: they are found
    bucket by bucket, and chosen over all buckets of the text."""
    def run(t: pa.Table) -> pa.Table:
        nodes = np.asarray(t.column("node").combine_chunks(), np.int64)
        raw = np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint16)
        x, y, agree, rank = partners(raw.reshape(len(nodes), -1), nodes)
        order = np.argsort(x, kind="stable")
        found = pa.StructArray.from_arrays([pa.array(agree[order], pa.int32()), pa.array(rank[order]), pa.array(nodes[y[order]])],
                                           names=["agree", "rank", "other"])
        ends = np.append(0, np.cumsum(np.bincount(x, minlength=len(nodes))))
        return pa.table([pa.array(nodes), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)], names=["node", "found"])

    # tiles differ from band to band, so texts apart in one may meet in another
    tiles = F.ceil(F.col("n") / TILE)
    dealt = large.withColumn("tile", F.pmod(F.xxhash64("key", "node"), tiles))
    each = (dealt.join(signatures, "node").select("key", "tile", "node", "signature").groupBy("key", "tile")
            .applyInArrow(run, FOUND).where(F.size("found") > 0)
            .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found")))     # a list per band
    best = F.transform(F.slice(F.sort_array("found", asc=False), 1, BEST), lambda p: p.other)
    first = F.transform(F.slice(F.array_sort(F.transform("found", lambda p: F.struct(p["rank"], p.other))), 1, ANY),
                        lambda p: p.other)
    pairs = each.select("node", F.explode(F.array_union(best, first)).alias("other"))
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))


def _pairs(rows: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs to compare of buckets (key, node, degree)."""
    n = rows.groupBy("key").agg(F.count("*").alias("n"), F.max(F.struct("degree", F.col("node"))).alias("pivot"))
    sized = rows.join(n.select("key", "n", F.col("pivot.node").alias("pivot")), "key")
    small = (sized.where(F.col("n") <= SMALL).groupBy("key").agg(F.collect_list("node").alias("nodes"))  # SMALL at most
             .select(F.explode("nodes").alias("a"), "nodes").select("a", F.explode("nodes").alias("b")).where("a < b"))
    large = sized.where(F.col("n") > SMALL)
    star = large.where("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    return small.unionByName(star).unionByName(_close(large, signatures)).distinct()


# ---------------------------------------------------- what is left apart
def _flat(sets: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(sets), np.uint64), np.array([len(s) // 8 for s in sets], np.int64)


def similar(x: list[bytes], y: list[bytes], threshold: float, chunk: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """Places of all sets of ``x`` and ``y`` (bytes of distinct hashes) whose
    Jaccard similarity is ``threshold`` or more."""
    (hx, nx), (hy, ny) = _flat(x), _flat(y)
    order = np.argsort(hy, kind="stable")
    hy, of = hy[order], np.repeat(np.arange(len(y)), ny)[order]
    begin, out = np.append(0, np.cumsum(nx)), []
    for a in range(0, len(x), 256):
        e = min(len(x), a + 256)
        h, row = hx[begin[a]:begin[e]], np.repeat(np.arange(e - a), nx[a:e])
        first = np.searchsorted(hy, h)
        n = np.searchsorted(hy, h, side="right") - first
        total, both, cut = np.cumsum(n), np.zeros((e - a) * len(y), np.int64), 0
        while cut < len(h):
            end = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + chunk, side="right")))
            k = n[cut:end]
            at = np.repeat(first[cut:end] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
            both += np.bincount(np.repeat(row[cut:end], k) * len(y) + of[at], minlength=len(both))
            cut = end
        both = both.reshape(e - a, len(y))
        i, j = np.nonzero(both / np.maximum(nx[a:e, None] + ny - both, 1) >= threshold)
        out.append(np.stack([i + a, j]))
    return tuple(np.concatenate(out, axis=1)) if out else (np.zeros(0, np.int64),) * 2


def _across(large: DataFrame, sets: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between the components of ``classes``: of all pairs of
    texts of a bucket (key, node) that are in different ones."""
    def run(t: pa.Table) -> pa.Table:
        tile, low, high, component = (np.asarray(t.column(c).combine_chunks(), np.int64)
                                      for c in ("tile", "low", "high", "component"))
        raw = t.column("shingles").to_pylist()
        x, y = np.flatnonzero(tile == low), np.flatnonzero(tile == high)
        i, j = similar([raw[k] for k in x], [raw[k] for k in y], threshold)
        a, b = component[x[i]], component[y[j]]
        links = spanning(a[a != b], b[a != b])
        return pa.table([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    sized = large.join(sets.select("node", F.length("shingles").alias("bytes")), "node")
    tiles = apart(sized, classes, F.col("bytes") + TEXT, SET_TILE).drop("bytes")
    return (tiles.join(sets, "node").select("key", "low", "high", "tile", "component", "shingles").groupBy("key", "low", "high")
            .applyInArrow(run, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id and class_id of every document of ``docs`` (doc_id, text): the
    smallest doc_id of the texts it is linked with, directly or over others.

    Shingles are runs of five words (see ``Words``); a shorter text is one
    shingle.  Texts without words (null and empty ones too) are one class.
    Texts of equal words are copies.  Rows of one doc_id are one document;
    a row without doc_id has no class (null).  An empty table gives no rows.
    """
    rows = id_and_text(docs)
    path = new_path(docs.sparkSession, "signatures")
    _signed(rows).write.parquet(path)
    signed = docs.sparkSession.read.schema(SIGNED).parquet(path)
    texts = signed.where("doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("node"))
    members = materialized(signed.select("doc_id", "key").join(texts, "key", "left")
                           .groupBy("doc_id").agg(F.min("node").alias("node")), "texts")
    # buckets of two texts or more, and how many others each text meets
    own = signed.join(texts, [signed.key == texts.key, signed.doc_id == texts.node]).drop(texts.key)
    bands = own.select("node", F.explode("bands").alias("key")).distinct()
    # bitwise-not twice hides that the counts are dealt by key already: with a
    # shuffle stage on either side a bucket that holds many texts is split
    hidden = F.bitwise_not(F.bitwise_not("key")).alias("key")
    shared = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(hidden, "n")
    shared = materialized(bands.join(shared, "key"), "buckets")
    degree = materialized(shared.groupBy("node").agg(F.sum("n").alias("degree")), "degrees")
    signatures = own.join(degree, "node").select("node", "signature").dropDuplicates(["node"])
    pairs = materialized(_pairs(shared.select("key", "node").join(degree, "node"), signatures), "candidates")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = materialized(_sets(rows, nodes), "shingles")
    classes = components(_verified(pairs, sets, threshold).select("a", "b"))
    more = materialized(_across(shared.where(F.col("n") > SMALL).select("key", "node"), sets, classes, threshold), "across")
    if not more.isEmpty():
        classes = components(classes.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    named = members.join(classes.withColumnRenamed("component", "class_id"), "node", "left")
    return named.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "node")).alias("class_id"))
