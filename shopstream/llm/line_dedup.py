"""Fuzzy line de-duplication (operator 1).

Lines are normalised to their words.  Equal normalised lines are one node;
nodes with 64-bit SimHashes of at most three different bits share one of four
16-bit blocks (pigeonhole), and among those one of four 12-bit parts of the
rest, so candidates are found by one shuffle of four small rows per node.
Pairs are verified by edit similarity, linked nodes form groups, and the first
occurrence of each group, by doc_id and line number, stays.

In long runs of nodes that share a block and a part, and in blocks of very many
nodes, only some pairs are compared at first.  Then all others whose nodes are
in different groups are, tile against tile.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import Words, as_struct, materialized, mix, sliced, utf8
from shopstream.llm.components import apart, components

MAX_BITS = 3
SIMILARITY = 0.8
ALL_PAIRS = 64          # runs of up to so many nodes are compared pair by pair at once
BLOCK = 1 << 17         # nodes of a block that one task compares at once
TILE = 4096             # nodes of a tile whose pairs are all compared
#: Words of up to SHORT bytes count 1, longer ones WEIGHT: else the few short
#: words of a language make all of its long lines alike.
SHORT, WEIGHT = 3, 8
LINES = "doc_id long, digest long, line int, key binary, simhash long"


class Lines:
    """The lines of the texts of a column: ``row``, ``line`` and their words."""

    def __init__(self, column: pa.Array):
        raw, off = utf8(column)
        nl = np.flatnonzero(raw == 10)
        start = np.concatenate([off[:-1], nl + 1])
        row = np.concatenate([np.arange(len(off) - 1), np.searchsorted(off, nl, side="right") - 1])
        order = np.lexsort((start, row))
        self.row, start = row[order], start[order]
        count = np.bincount(self.row, minlength=len(off) - 1)
        self.count = count
        self.line = np.arange(len(start)) - np.repeat(np.cumsum(count) - count, count)
        self.words = Words(column)
        w = self.words.start
        self.first = np.searchsorted(w, np.append(start, len(raw)))

    def keys(self) -> tuple[np.ndarray, list[bytes]]:
        """Lines that have words, and a 128-bit key of the words of each."""
        import xxhash

        h = self.hashes
        at = np.flatnonzero(np.diff(self.first) > 0)
        raw = memoryview(h.view(np.uint8)) if len(h) else memoryview(b"")
        a, e = self.first[:-1][at], self.first[1:][at]
        keys = [xxhash.xxh3_128_digest(raw[x * 8:y * 8]) for x, y in zip(a.tolist(), e.tolist(), strict=True)]
        return at, keys

    @cached_property
    def hashes(self) -> np.ndarray:
        return np.ascontiguousarray(self.words.hashes())

    def simhashes(self, at: np.ndarray) -> np.ndarray:
        """The SimHash over the words of the lines ``at``."""
        weight = np.where(self.words.end - self.words.start > SHORT, WEIGHT, 1)
        begin = self.first[:-1][at]
        return simhash(self.hashes, weight, begin, self.first[1:][at] - begin)

    def normal(self, i: int) -> str:
        return b" ".join(self.words.text(k) for k in range(self.first[i], self.first[i + 1])).decode("utf-8", "replace")


RUN = 4096      # words whose weights (up to 15) a 16-bit counter holds
_LANES = np.uint64(0x0001_0001_0001_0001)


def simhash(h: np.ndarray, weight: np.ndarray, begin: np.ndarray, count: np.ndarray, chunk: int = 1 << 17) -> np.ndarray:
    """64-bit SimHash of runs of weighted hashes that follow one another.
    Bits j, j + 16, j + 32 and j + 48 are counted in one addition, over RUN
    words at most; the counts of a longer run are added up."""
    out = np.zeros(len(begin), np.uint64)
    cut = 0
    while cut < len(begin):
        end = max(cut + 1, int(np.searchsorted(begin, begin[cut] + chunk)))
        a, n = begin[cut], count[cut:end]
        parts = -(-n // RUN)
        first = np.cumsum(parts) - parts
        at = np.repeat(begin[cut:end] - a, parts) + RUN * (np.arange(int(parts.sum())) - np.repeat(first, parts))
        bits, w = mix(h[a:a + int(n.sum())]), weight[a:a + int(n.sum())].astype(np.uint64)
        ones = np.empty((end - cut, 4, 16), np.int64)
        for j in range(16):
            lanes = np.add.reduceat(((bits >> np.uint64(j)) & _LANES) * w, at)
            lanes = lanes.view(np.uint16).reshape(-1, 4)
            ones[:, :, j] = lanes if len(at) == len(n) else np.add.reduceat(lanes, first, axis=0, dtype=np.int64)
        major = 2 * ones.reshape(-1, 64) > np.add.reduceat(w, begin[cut:end] - a).astype(np.int64)[:, None]
        out[cut:end] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
        cut = end
    return out.view(np.int64)


def _lines(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            lines = Lines(b.column("text"))
            at, keys = lines.keys()
            sim = lines.simhashes(at)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(lines.row[at])), b.column("digest").take(pa.array(lines.row[at])), pa.array(lines.line[at].astype(np.int32)),
                 pa.array(keys, pa.binary()), pa.array(sim)], names=["doc_id", "digest", "line", "key", "simhash"])

    return docs.select("doc_id", "digest", "text").mapInArrow(run, LINES)


# ------------------------------------------------------------- candidates
def _runs(order: np.ndarray, keys: np.ndarray):
    k = keys[order]
    cut = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return cut, np.diff(np.append(cut, len(k)))


def _run_pairs(size: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions to compare: all pairs of small runs; in larger ones each with
    the first and with those next to it in SimHash order."""
    a, b = [], []
    for s in np.unique(size[(size > 1) & (size <= ALL_PAIRS)]):
        x, y = np.triu_indices(s, 1)
        at = begin[size == s]
        a.append((at[:, None] + x).ravel())
        b.append((at[:, None] + y).ravel())
    for at, s in zip(begin[size > ALL_PAIRS].tolist(), size[size > ALL_PAIRS].tolist(), strict=True):
        i = np.arange(1, s)
        a += [np.full(s - 1, at), *(at + i[k:] - k - 1 for k in range(4))]
        b += [at + i, *(at + i[k:] for k in range(4))]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2


def _part_keys(block: np.ndarray, sim: np.ndarray) -> Iterator[np.ndarray]:
    """Block and 12-bit part in one key, for each of the four parts of the
    SimHash outside the block; its lowest two bits tell the part."""
    sim, which = sim.view(np.uint64), (block & 3).astype(np.uint64)
    low = which * np.uint64(16)
    one = np.uint64(1)
    below = sim & ((one << low) - one)
    above = np.where(low < 48, sim >> ((low + np.uint64(16)) & np.uint64(63)), np.uint64(0))
    rest = below | (above << low)
    for part in range(4):
        sub = (rest >> np.uint64(12 * part)) & np.uint64(4095)
        yield (((block.astype(np.uint64) << np.uint64(12)) | sub) << np.uint64(2)) | np.uint64(part)


def close_pairs(block: np.ndarray, sim: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs of equal ``block`` whose SimHashes differ in at most
    MAX_BITS bits, by the four 12-bit parts outside the block; of long runs
    those that ``_run_pairs`` compares."""
    return _close(block, sim, np.zeros(len(block), bool))[:2]


def _close(block: np.ndarray, sim: np.ndarray, split: np.ndarray):
    """``close_pairs``, and positions and parts of the nodes of runs of which
    not all pairs were compared: long ones, and those of ``split`` blocks."""
    found, parts, members = [], [], []
    sim = sim.view(np.uint64)
    for part, key in enumerate(_part_keys(block, sim)):
        order = np.lexsort((sim, key))
        begin, size = _runs(order, key)
        a, b = (order[x] for x in _run_pairs(size, begin))
        near = np.bitwise_count(sim[a] ^ sim[b]) <= MAX_BITS
        found.append(np.stack([a[near], b[near]], axis=1))
        left = order[np.repeat(size > ALL_PAIRS, size) | split[order]]
        members.append(left)
        parts.append(np.full(len(left), part))
    pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1], np.concatenate(members), np.concatenate(parts)


#: Pairs (a, b); or the node b, its SimHash and its run's key, if not all pairs
#: of the run were compared.
COMPARED = "a long, b long, simhash long, key long"


def _compared(nodes: DataFrame) -> DataFrame:
    """Pairs of node ids whose SimHashes are close, and nodes of long runs."""
    block = "transform(array(0, 1, 2, 3), b -> (shiftrightunsigned(simhash, b * 16) & 65535) * 4 + b)"
    rows = nodes.select("id", "simhash", F.explode(F.expr(block)).alias("block"))
    # blocks that more than one task compares: 4 * 65536 counts at most
    hot = (rows.groupBy("block").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK)
           .select("block", F.ceil(F.col("n") / BLOCK).cast("long").alias("shares")))
    dealt = (rows.join(F.broadcast(hot), "block", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
             .withColumn("share", F.pmod(F.xxhash64("id"), "shares")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out(block, share, shares, sim, ids):
            # a share of a block is compared like a block; its lowest two bits
            # still tell which one
            new = np.cumsum(np.append(0, (np.diff(block) != 0) | (np.diff(share) != 0)))
            a, b, left, part = _close((new << 2) | (block & 3), sim, shares > 1)
            x, y, key = ids[a], ids[b], np.zeros(len(left), np.int64)
            for k, own in enumerate(_part_keys(block[left], sim[left])):
                key[part == k] = own.view(np.int64)[part == k]
            n, m = len(x), len(left)
            none = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), none, none],
                                             names=["a", "b", "simhash", "key"])
            yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.array(ids[left]), pa.array(sim[left]), pa.array(key)],
                                             names=["a", "b", "simhash", "key"])

        for b in batches:
            if not b.num_rows:
                continue
            held.append(tuple(np.asarray(b.column(c)) for c in ("block", "share", "shares", "simhash", "id")))
            if sum(len(x[0]) for x in held) < 1 << 17:
                continue
            whole = [np.concatenate(x) for x in zip(*held, strict=True)]
            last = (whole[0] == whole[0][-1]) & (whole[1] == whole[1][-1])
            done = int(np.argmax(last))         # the last block may go on
            if done:
                yield from out(*(x[:done] for x in whole))
            held = [tuple(x[done:] for x in whole)]
        if held:
            yield from out(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return (dealt.repartition("block", "share").sortWithinPartitions("block", "share")
            .select("block", "share", "shares", "simhash", "id").mapInArrow(run, COMPARED))


def _across(members: DataFrame, classes: DataFrame) -> DataFrame:
    """All pairs (a, b) of nodes of a run (key, node, simhash) that are in
    different components and whose SimHashes are close."""
    def run(t: pa.Table) -> pa.Table:
        tile, low, high, component, ids, sim = (np.asarray(t.column(c).combine_chunks(), np.int64)
                                                for c in ("tile", "low", "high", "component", "node", "simhash"))
        x, y, sim = np.flatnonzero(tile == low), np.flatnonzero(tile == high), sim.view(np.uint64)
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(x), 256):
            part = x[at:at + 256]
            near = np.bitwise_count(sim[part, None] ^ sim[None, y]) <= MAX_BITS
            i, j = np.nonzero(near & (component[part, None] != component[None, y]))
            a.append(ids[part[i]])
            b.append(ids[y[j]])
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return (apart(members, classes, F.lit(1), TILE).select("key", "low", "high", "tile", "component", "node", "simhash")
            .groupBy("key", "low", "high").applyInArrow(run, "a long, b long").distinct())


# ------------------------------------------------------------ verification
FILTER_BITS = 1 << 24


def _filter_bits(keys: np.ndarray) -> np.ndarray:
    """Two bit positions of each 128-bit key."""
    k = keys.view(np.uint64).reshape(-1, 2)
    return (k % np.uint64(FILTER_BITS)).astype(np.int64)


def _key_filter(keys: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over ``key``; a full one only lets more
    lines through."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            bit = np.unique(_filter_bits(np.frombuffer(b"".join(b.column("key").to_pylist()), np.uint8)).ravel())
            at = bit >> 3
            first = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            packed = np.bitwise_or.reduceat(128 >> (bit & 7), first)
            yield pa.RecordBatch.from_arrays([pa.array(at[first], pa.int32()), pa.array(packed.astype(np.int32))],
                                             names=["at", "bits"])

    out = np.zeros(FILTER_BITS // 8, np.uint8)
    rows = keys.mapInArrow(run, "at int, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    for b in rows.toArrow().to_batches():      # at most FILTER_BITS / 8 rows
        out[np.asarray(b.column("at"))] = np.asarray(b.column("bits")).astype(np.uint8)
    return out


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The normalised text of each node of ``wanted`` (id, key): a second look
    at the documents, where the filter keeps all other lines from moving."""
    sent = docs.sparkSession.sparkContext.broadcast(_key_filter(wanted.select("key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there = np.unpackbits(sent.value).view(bool)
        for b in sliced(batches):
            lines = Lines(b.column("text"))
            at, keys = lines.keys()
            if not len(at):
                continue
            hit = there[_filter_bits(np.frombuffer(b"".join(keys), np.uint8))].all(axis=1)
            own = {keys[i]: lines.normal(at[i]) for i in np.flatnonzero(hit).tolist()}
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()), pa.array(list(own.values()), pa.string())],
                                             names=["key", "normal"])

    lines = docs.select("text").mapInArrow(run, "key binary, normal string")
    return lines.join(wanted, "key").dropDuplicates(["id"]).select("id", "normal")


def at_most(s: str, t: str) -> int:
    """An edit distance that ``s`` and ``t`` do not exceed: words that stand
    once in either and follow one another in the same order stay, and what is
    between two of them is exchanged as a whole, but for equal words at its
    end.  Near copies are settled by it, however long they are."""
    a, b = s.split(" "), t.split(" ")
    once = ({}, {})
    for words, at in zip((a, b), once, strict=True):
        for i, w in enumerate(words):
            at[w] = -1 if w in at else i
    both = sorted((i, once[1].get(w, -1)) for w, i in once[0].items() if i >= 0)
    both = [x for x in both if x[1] >= 0]
    ends, last, before = [], [], []         # the longest ascending chain
    for k, (_, j) in enumerate(both):
        at = bisect_left(ends, j)
        before.append(last[at - 1] if at else -1)
        ends[at:at + 1], last[at:at + 1] = [j], [k]
    chain, k = [(len(a), len(b))], last[-1] if last else -1
    while k >= 0:
        chain.append(both[k])
        k = before[k]
    total = x = y = 0
    for i, j in reversed(chain):
        m, n = a[x:i], b[y:j]
        while m and n and m[-1] == n[-1]:
            m.pop()
            n.pop()
        total += max(sum(map(len, m)) + len(m), sum(map(len, n)) + len(n))      # a space after each word
        x, y = i + 1, j + 1
    return total


def _stripped(pairs: DataFrame, similarity: float) -> DataFrame:
    """Pairs without their common beginning and end; ``most`` is the distance
    they may have, and those are ``near`` that surely have no greater one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y, most, near = [], [], [], []
            for s, t in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True):
                n = min(len(s), len(t))
                u, v = (np.frombuffer(z.encode("utf-32-le"), np.uint32) for z in (s, t))
                differ = np.flatnonzero(u[:n] != v[:n])
                a = int(differ[0]) if len(differ) else n
                tail = np.flatnonzero(u[len(s) - (n - a):][::-1] != v[len(t) - (n - a):][::-1])
                e = int(tail[0]) if len(tail) else n - a
                room = int((1 - similarity) * max(len(s), len(t)) + 1e-9)
                s, t = s[a:len(s) - e], t[a:len(t) - e]
                near.append(max(len(s), len(t)) <= room or at_most(s, t) <= room)
                most.append(room)
                x.append("" if near[-1] else s)
                y.append("" if near[-1] else t)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(x, pa.string()), pa.array(y, pa.string()),
                                              pa.array(most, pa.int32()), pa.array(near, pa.bool_())],
                                             names=["a", "b", "x", "y", "most", "near"])

    return pairs.mapInArrow(run, "a long, b long, x string, y string, most int, near boolean")


def _links(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    x = texts.select(F.col("id").alias("a"), F.col("normal").alias("x"))
    y = texts.select(F.col("id").alias("b"), F.col("normal").alias("y"))
    room = (1 - similarity) * F.greatest(F.length("x"), F.length("y")) + 1e-9
    both = pairs.join(x, "a").join(y, "b").where(F.abs(F.length("x") - F.length("y")) <= room)
    # the distance is only computed where its bounds are not enough, and no
    # further than it may go
    near = F.col("near") | (F.expr("levenshtein(x, y, most)") >= 0)
    return _stripped(both.select("a", "b", "x", "y"), similarity).where(near).select("a", "b")


# ------------------------------------------------------------------ result
def duplicate_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, digest (xxhash64 of the text) and the numbers of the lines to
    remove (from 0), for documents that have such lines."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("digest"), "text")
    lines = materialized(_lines(rows), "lines")
    nodes = materialized(
        lines.groupBy("key").agg(F.min(F.struct("doc_id", "digest", "line")).alias("first"), F.count("*").alias("n"),
                                 F.min("simhash").alias("simhash"))
        .withColumn("id", F.monotonically_increasing_id()), "nodes")
    compared = materialized(_compared(nodes), "compared")
    pairs = materialized(compared.where("a is not null").select("a", "b").distinct(), "pairs")
    members = compared.where("a is null").select("key", F.col("b").alias("node"), "simhash")

    def links(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
        wanted = materialized(nodes.select("id", "key").join(ids, "id"), "wanted")
        return _links(pairs, materialized(_texts(rows, wanted), "normal"), similarity)

    classes = components(links(pairs))
    # what the long runs' first comparisons left in different groups; pairs
    # that they had and that are not similar aren't verified again
    more = materialized(_across(members, classes).join(pairs, ["a", "b"], "left_anti"), "across")
    if not more.isEmpty():
        classes = components(classes.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links(more)))
    classes = classes.withColumnRenamed("node", "id")
    grouped = nodes.join(classes, "id", "left").withColumn("component", F.coalesce("component", "id"))
    # only groups with several occurrences: fuzzy ones, and equal lines
    fuzzy = grouped.join(classes.select("id"), "id", "left_semi")
    first = fuzzy.groupBy("component").agg(F.min("first").alias("keep"))
    keep = (fuzzy.join(first, "component").select("key", "keep")
            .unionByName(nodes.join(classes, "id", "left_anti").where("n > 1").select("key", F.col("first").alias("keep"))))
    at = F.struct("doc_id", "digest", "line")
    gone = lines.select("doc_id", "digest", "line", "key").join(keep, "key").where(at != F.col("keep"))
    return gone.groupBy("doc_id", "digest").agg(F.collect_set("line").alias("lines"))     # a document's lines at most


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """All columns of ``docs`` as the struct ``doc``, with kept (the text
    without the lines removed), n_lines and n_removed.

    Lines end at a line feed and are compared by their words (runs of digits,
    a-z after lower-casing A-Z, and non-ASCII characters); lines without words
    always stay.  Of each group of linked lines the one of the smallest
    (doc_id, xxhash64 of the text, line number) stays.  A null text stays null.
    Rows without a doc_id come first; rows of one doc_id and text lose the same
    lines.  A document may
    become empty; no row is dropped.  An empty table gives no rows.
    """
    gone = duplicate_lines(docs, similarity)
    rows = as_struct(docs).withColumn("doc_id", F.col("doc.doc_id").cast("long"))
    parts = F.split("text", "\n", -1)
    rows = rows.withColumn("digest", F.xxhash64("text"))
    same = F.col("r.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("r.digest") == F.col("g.digest"))
    joined = rows.alias("r").join(gone.alias("g").hint("shuffle_hash"), same, "left")
    out = joined.select("doc", "text", F.coalesce("lines", F.expr("cast(array() as array<int>)")).alias("lines"))
    return (out.withColumn("n_lines", F.size(parts).cast("long")).withColumn("n_removed", F.size("lines").cast("long"))
            .withColumn("kept", F.when(F.col("doc.text").isNotNull(), F.when(F.size("lines") == 0, F.col("text")).otherwise(
                F.array_join(F.filter(parts, lambda x, i: ~F.array_contains("lines", i)), "\n"))))
            .select("doc", "kept", "n_lines", "n_removed"))
