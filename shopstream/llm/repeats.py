"""Suffix-array de-duplication of long repeated byte strings (operator 2).

A position is a repeat if the ``length`` bytes from it also start elsewhere.
In suffix order the previous and next smaller positions of a suffix are the
only candidates for its longest earlier match, so the longest-previous-factor
array tells which positions repeat something earlier; the mirrored array, with
greater positions, tells which are repeated later.

Suffixes meet by content: every window of ``length`` bytes is dealt by its
smallest hashed gram (its anchor), which depends on the window alone.  Runs of
windows with the same anchor are one segment.  Anchors that occur once end
there; equal segments are one with two occurrences; what is left is sorted in
bundles of bounded size.  Groups of an anchor too large for a bundle are
compared window by window, by 128-bit hashes, first in one task and, beyond
``TASK_BYTES``, as rows of a Spark aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import as_struct, materialized, mix, sliced, utf8, with_doc
from shopstream.llm.pieces import window_hashes

LENGTH = 400
GRAM = 32
PIECE = 1 << 20             # longer texts are anchored piece by piece
BUNDLE_BYTES = 1 << 20      # text sorted at a time
TASK_BYTES = 8 << 20       # of one anchor's distinct segments
_SHUFFLED = np.array([(b * 167 + 13) % 256 for b in range(256)], np.uint8)


# ---------------------------------------------------------------- anchors
def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``x[i:i+w]`` for i up to len(x) - w."""
    n = len(x)
    pad = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    pad[:n] = x
    rows = pad.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - w + 1], ahead[w - 1:n])


def anchored(raw: np.ndarray, off: np.ndarray, length: int, gram: int):
    """Segments of the texts ``raw[off[i]:off[i+1]]``: text, first window,
    number of windows, anchor hash.  Positions count from ``raw``'s start."""
    out = []
    for a, e in _pieces(off, length):
        part = raw[a:e]
        if len(part) < length:
            continue
        h = window_hashes(part, gram)
        low = np.uint64((1 << 24) - 1)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        least = _sliding_min(key, length - gram + 1)
        at = (least & low).astype(np.int64)
        # windows must lie inside one text
        start = a + np.arange(len(at))
        text = np.searchsorted(off, start, side="right") - 1
        inside = start + length <= off[text + 1]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
        run = np.flatnonzero(new & inside)
        size = np.add.reduceat(inside.astype(np.int64), np.flatnonzero(new))[inside[np.flatnonzero(new)]]
        out.append((text[run], start[run], size, h[at[run]]))
    if not out:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _pieces(off: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """Stretches of bytes in which every window of a text lies, once.  A text
    is cut every PIECE bytes from its own start, and a shorter one never, so
    its segments don't depend on the texts beside it."""
    i, n = 0, len(off) - 1
    while i < n:
        a, end = int(off[i]), int(off[i + 1])
        if end - a > PIECE:
            for cut in range(a, end, PIECE):
                yield cut, min(end, cut + PIECE + length - 1)
            i += 1
        else:
            i = int(np.searchsorted(off, a + PIECE, side="right")) - 1
            yield a, int(off[i])


# ------------------------------------------------------------ suffix order
def suffix_classes(text: np.ndarray, depth: int) -> np.ndarray:
    """Rank of each suffix by its first ``depth`` bytes (equal ones share it),
    by prefix doubling; a suffix that ends is smaller than one that goes on."""
    n = len(text)
    # up to six bytes, and where the text ends, fit in one key
    h = min(6, depth)
    pad = np.zeros(n + h, np.uint64)
    pad[:n] = text.astype(np.uint64) + np.uint64(1)
    key = np.zeros(n, np.uint64)
    for k in range(h):
        key = (key << np.uint64(9)) | pad[k:n + k]
    rank = _dense(key)
    while h < depth:
        step = min(h, depth - h)
        ahead = np.zeros(n, np.uint64)
        ahead[:n - step] = rank[step:].astype(np.uint64) + np.uint64(1)
        rank, h = _dense((rank.astype(np.uint64) << np.uint64(32)) | ahead), h + step
    return rank


def _dense(key: np.ndarray) -> np.ndarray:
    order = np.argsort(key, kind="stable")
    k = key[order]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(np.append(False, k[1:] != k[:-1]))
    return out


def _smaller_before(pos: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """For each place of a suffix order whether a smaller position stands
    before it with a common prefix of full depth all the way; ``joined[i]``
    tells that i shares it with i - 1.  Places jump over larger positions."""
    n = len(pos)
    at, link = np.arange(n) - 1, joined.copy()
    left = np.flatnonzero(link)
    found = np.zeros(n, bool)
    while len(left):
        c = at[left]
        done = pos[c] < pos[left]
        found[left[done]] = True
        left, c = left[~done], c[~done]
        go = link[c]
        jump = at[c]
        link[left], at[left] = go, jump
        left = left[go]
    return found


def repeated(rank: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of suffixes with these ranks and positions: which have an equal suffix
    at a smaller position (longest previous factor of full depth), and which
    at a greater one."""
    order = np.argsort(rank, kind="stable")
    r, p = rank[order], pos[order]
    same = np.append(False, r[1:] == r[:-1])
    turned, after = p[::-1], np.append(False, same[1:][::-1])
    earlier = _smaller_before(p, same) | _smaller_before(turned, after)[::-1]
    later = _smaller_before(-p, same) | _smaller_before(-turned, after)[::-1]
    out = np.zeros((2, len(rank)), bool)
    out[0, order], out[1, order] = earlier, later
    return out[0], out[1]


def longest_previous_factors(text: bytes, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Of one text: positions whose next ``depth`` bytes also start earlier,
    and those whose next ``depth`` bytes also start later."""
    raw = np.frombuffer(text, np.uint8)
    starts = np.arange(max(0, len(raw) - depth + 1))
    if not len(starts):
        return starts.astype(bool), starts.astype(bool)
    return repeated(suffix_classes(raw, depth)[starts], starts)


# ---------------------------------------------------------------- segments
TEXT = "k1 long, k2 long"
SEGMENT = "k1 long, k2 long, doc_id long, start long, anchor long, digest binary, windows int"


def _with_key(docs: DataFrame) -> DataFrame:
    """Texts are told apart by 128 bits of their SHA-256."""
    hexed = F.sha2("text", 256)
    half = lambda a: F.conv(F.substring(hexed, a, 15), 16, 10).cast("long")
    return docs.select("*", half(1).alias("k1"), half(16).alias("k2"))


def _anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, limit=2 << 20):
            raw, off = utf8(b.column("text"))
            text, start, _, h = anchored(raw, off, length, gram)
            yield pa.RecordBatch.from_arrays(
                [b.column("k1").take(pa.array(text)), b.column("k2").take(pa.array(text)),
                 pa.array(start - off[text], pa.int64()), pa.array(h.view(np.int64))], names=["k1", "k2", "start", "anchor"])

    return texts.select("k1", "k2", "text").mapInArrow(run, f"{TEXT}, start long, anchor long")


def _segments(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Segments whose first window is in ``starts``, with their bytes."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, limit=2 << 20):
            raw, off = utf8(b.column("text"))
            text, start, windows, h = anchored(raw, off, length, gram)
            wanted = b.column("starts")
            size = np.asarray(wanted.value_lengths(), np.int64)
            want = np.asarray(wanted.flatten(), np.int64) + np.repeat(off[:-1], size)
            keep = np.flatnonzero(np.isin(start, want))
            text, start, windows, h = text[keep], start[keep], windows[keep], h[keep]
            blobs = [raw[a:e].tobytes() for a, e in zip(start.tolist(), (start + windows + length - 1).tolist(), strict=True)]
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [b.column("k1").take(rows), b.column("k2").take(rows), b.column("doc_id").take(rows),
                 pa.array(start - off[text], pa.int64()), pa.array(h.view(np.int64)),
                 pa.array([xxhash.xxh3_128_digest(x) for x in blobs], pa.binary()),
                 pa.array(windows.astype(np.int32)), pa.array(blobs, pa.binary())],
                names=["k1", "k2", "doc_id", "start", "anchor", "digest", "windows", "bytes"])

    return texts.select("k1", "k2", "doc_id", "text", "starts").mapInArrow(run, f"{SEGMENT}, bytes binary")


def _run_lists(flags: np.ndarray, count: np.ndarray) -> pa.Array:
    """Runs of set flags of each segment, as start, end, start, end ..."""
    first = np.cumsum(count) - count
    edge = np.zeros(len(flags) + 1, bool)
    edge[first], edge[-1] = True, True
    s = np.flatnonzero(flags & (np.append(False, ~flags[:-1]) | edge[:-1]))
    e = np.flatnonzero(flags & (np.append(~flags[1:], True) | edge[1:])) + 1
    seg = np.searchsorted(first, s, side="right") - 1
    both = np.stack([s - first[seg], e - first[seg]], axis=1).ravel().astype(np.int32)
    n = 2 * np.bincount(seg, minlength=len(count))
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(both))


VERDICT = "digest binary, earlier array<int>, later array<int>"


def _judge(segs: list[tuple[bytes, bytes]], length: int, by_order: bool) -> pa.RecordBatch:
    """Repeats among distinct segments given in the order of their first
    occurrence, (digest, bytes)."""
    raw = np.frombuffer(b"".join(s for _, s in segs), np.uint8)
    size = np.array([len(s) for _, s in segs], np.int64)
    count = size - length + 1
    begin = np.cumsum(size) - size
    starts = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    if by_order:
        rank = suffix_classes(raw, length)[starts]
    else:
        rank = _dense((mix(window_hashes(raw, length)) ^ window_hashes(_SHUFFLED[raw], length))[starts])
    earlier, later = repeated(rank, starts)
    return pa.RecordBatch.from_arrays([pa.array([d for d, _ in segs], pa.binary()), _run_lists(earlier, count),
                                       _run_lists(later, count)], names=["digest", "earlier", "later"])


def _bundled(groups: DataFrame, length: int) -> DataFrame:
    """Verdicts on distinct segments, sorted by anchor inside each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes]] = []
        held_bytes = 0
        own: list[tuple[bytes, bytes]] = []     # of the last anchor
        own_bytes, anchor = 0, None

        def shut():
            nonlocal held, held_bytes, own, own_bytes
            if own_bytes > BUNDLE_BYTES:
                yield _judge(own, length, False)
            else:
                held, held_bytes = held + own, held_bytes + own_bytes
                if held_bytes > BUNDLE_BYTES:
                    yield _judge(held, length, True)
                    held, held_bytes = [], 0
            own, own_bytes = [], 0

        for b in batches:
            for a, d, s in zip(*(b.column(c).to_pylist() for c in ("anchor", "digest", "bytes")), strict=True):
                if a != anchor:
                    yield from shut()
                    anchor = a
                own.append((d, s))
                own_bytes += len(s)
        yield from shut()
        if held:
            yield _judge(held, length, True)

    return (groups.repartition("anchor").sortWithinPartitions("anchor", "first")
            .select("anchor", "digest", "bytes").mapInArrow(run, VERDICT)
            .where("size(earlier) + size(later) > 0"))


def _spread(groups: DataFrame, length: int) -> DataFrame:
    """Verdicts on the segments of very large groups, a row per window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "bytes", 1 << 18):
            blobs = b.column("bytes").to_pylist()
            raw = np.frombuffer(b"".join(blobs), np.uint8)
            size = np.array([len(s) for s in blobs], np.int64)
            count = size - length + 1
            at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
            starts = np.repeat(np.cumsum(size) - size, count) + at
            row = pa.array(np.repeat(np.arange(len(blobs)), count))
            yield pa.RecordBatch.from_arrays(
                [b.column("digest").take(row), b.column("first").take(row), pa.array(at.astype(np.int32)),
                 pa.array(window_hashes(raw, length)[starts].view(np.int64)),
                 pa.array(window_hashes(_SHUFFLED[raw], length)[starts].view(np.int64))],
                names=["digest", "first", "at", "h1", "h2"])

    order = groups.schema["first"].dataType.simpleString()
    rows = groups.select("digest", "first", "bytes").mapInArrow(
        run, f"digest binary, first {order}, at int, h1 long, h2 long")
    place = F.struct("first", "at", "digest")
    ends = rows.groupBy("h1", "h2").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high")
    runs = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.when(c, F.col("at")))),
                                           lambda x: F.array(x, x + 1)))
    me = F.struct(F.col("r.first"), F.col("r.at"), F.col("r.digest"))
    return (rows.alias("r").join(ends, ["h1", "h2"])
            .groupBy("digest").agg(runs(F.col("low") < me).alias("earlier"), runs(F.col("high") > me).alias("later")))


# ------------------------------------------------------------------ result
def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_first: bool = True,
                   task_bytes: int = TASK_BYTES) -> DataFrame:
    """k1, k2 (the text), whole (every byte is repeated), first (the smallest
    doc_id of the text) and spans (byte ranges as start, end, start, end ...,
    which may overlap) of all distinct texts of ``docs`` (doc_id, text, k1, k2)."""
    texts = materialized(docs.groupBy("k1", "k2").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max(F.octet_length("text")).alias("n_bytes")), "texts")
    anchors = materialized(_anchors(docs, length, gram), "anchors")
    place = F.xxhash64("k1", "k2", "start")
    # bitwise-not twice gives the join a shuffle stage on either side, so that a
    # hot anchor is split
    often = (anchors.groupBy("anchor").agg(F.min(place).alias("low"), F.max(place).alias("high"))
             .where("low <> high").select(F.bitwise_not(F.bitwise_not("anchor")).alias("anchor")))
    starts = (anchors.join(often, "anchor").groupBy("k1", "k2").agg(F.collect_set("start").alias("starts")))  # of one text
    wanted = starts.join(texts.select("k1", "k2", "first"), ["k1", "k2"])
    cut = docs.alias("d").join(wanted.alias("w").hint("shuffle_hash"), (F.col("d.k1") == F.col("w.k1")) & (F.col("d.k2") == F.col("w.k2"))
                               & F.col("d.doc_id").eqNullSafe(F.col("w.first")))
    segments = materialized(_segments(cut.select("d.k1", "d.k2", "d.doc_id", "d.text", "w.starts"), length, gram), "segments")
    place = F.struct("doc_id", "k1", "k2", "start")
    distinct = materialized(segments.groupBy("digest").agg(
        F.first("anchor").alias("anchor"), F.first("bytes").alias("bytes"), F.min(place).alias("first"),
        F.max(place).alias("last")), "distinct")
    group = distinct.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.length("bytes")).alias("size")).where("n > 1")
    mixed = distinct.join(group, "anchor")
    verdict = materialized(_bundled(mixed.where(F.col("size") <= task_bytes), length)
                           .unionByName(_spread(mixed.where(F.col("size") > task_bytes), length)), "verdicts")
    found = segments.select("k1", "k2", "doc_id", "start", "digest", "windows").join(
        distinct.select("digest", "first", (F.col("first") != F.col("last")).alias("again")), "digest").join(
        verdict, "digest", "left").where(F.col("again") | F.col("earlier").isNotNull())
    none, whole = F.expr("cast(array() as array<int>)"), F.array(F.lit(0), F.col("windows"))
    earlier, later = F.coalesce("earlier", none), F.coalesce("later", none)
    if keep_first:
        runs = F.when(F.col("again") & (F.struct("doc_id", "k1", "k2", "start") != F.col("first")), whole).otherwise(earlier)
    else:
        runs = F.when(F.col("again"), whole).otherwise(F.concat(earlier, later))
    spans = F.transform(runs, lambda x, i: x + F.col("start") + F.when(i % 2 == 1, length - 1).otherwise(0))
    per_text = found.select("k1", "k2", spans.alias("spans")).groupBy("k1", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return (texts.join(per_text, ["k1", "k2"], "left")
            .select("k1", "k2", "first", ((F.col("n") > 1) & (F.col("n_bytes") >= length)).alias("whole"), "spans")
            .where(F.col("whole") | F.col("spans").isNotNull()))


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_first: bool = True, gram: int = GRAM,
                   task_bytes: int = TASK_BYTES) -> DataFrame:
    """All columns of ``docs`` as the struct ``doc``, with n_bytes, spans
    (maximal byte ranges removed: start, end, start, end ...) and kept (the
    other bytes; cuts may fall inside a character).

    Texts are UTF-8 bytes, a null text is empty; matches never cross texts.  A
    byte goes if a string of ``length`` bytes over it also starts at an
    earlier place, by doc_id (of equal texts the smallest) and position; with
    ``keep_first=False`` at any other place, so that first copies go too.
    Rows without a doc_id come first.  Repeated rows are copies of each other;
    with ``keep_first`` and one doc_id for both, both stay.  An empty table
    gives no rows.
    """
    rows = _with_key(as_struct(docs).withColumn("doc_id", F.col("doc.doc_id").cast("long")))
    found = repeated_spans(rows.select("doc_id", "text", "k1", "k2"), length, gram, keep_first, task_bytes)
    joined = rows.join(found.hint("shuffle_hash"), ["k1", "k2"], "left")
    all_gone = F.coalesce("whole", F.lit(False))
    if keep_first:
        all_gone = all_gone & ~F.col("doc_id").eqNullSafe(F.col("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            raw, off = utf8(b.column("text"))
            gone = np.repeat(np.asarray(b.column("gone")), np.diff(off))
            spans = b.column("spans")
            size = np.asarray(spans.value_lengths().fill_null(0), np.int64)
            ends = np.asarray(spans.flatten(), np.int64) + np.repeat(off[:-1], size)
            level = np.zeros(len(raw) + 1, np.int64)
            np.add.at(level, ends[0::2], 1)
            np.add.at(level, ends[1::2], -1)
            gone = gone | (np.cumsum(level)[:len(raw)] > 0)
            kept = np.append(0, np.cumsum(~gone))[off]
            data, cut = raw[~gone], kept.tolist()
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array(np.diff(off)), _byte_runs(gone, off),
                 pa.array([data[a:e].tobytes() for a, e in zip(cut[:-1], cut[1:], strict=True)], pa.binary())],
                names=["doc", "n_bytes", "spans", "kept"])

    return joined.select("doc", "text", all_gone.alias("gone"), "spans").mapInArrow(
        run, with_doc(rows, "n_bytes long, spans array<long>, kept binary"))


def _byte_runs(gone: np.ndarray, off: np.ndarray) -> pa.Array:
    n = len(gone)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    s = np.flatnonzero(gone & (np.append(False, ~gone[:-1])[:n] | edge[:n]))
    e = np.flatnonzero(gone & (np.append(~gone[1:], True)[:n] | edge[1:])) + 1
    row = np.searchsorted(off, s, side="right") - 1
    both = np.stack([s - off[row], e - off[row]], axis=1).ravel()
    count = 2 * np.bincount(row, minlength=len(off) - 1)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(count)), pa.int32()), pa.array(both, pa.int64()))


def repeat_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256."""
    return found.select(F.col("doc.doc_id").alias("doc_id"), "n_bytes",
                        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                        F.expr("cast(size(spans) div 2 as long)").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
