"""Every operator on odd rows, against plain versions, and on empty tables."""
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shopstream.llm import (decontaminate, exact_topk, licenses, line_dedup, near_dup, packing, quality, repeats,
                            token_counts, wavelet)
from shopstream.llm.common import Words, new_path
from shopstream.llm.components import components
from shopstream.llm.pieces import default_vocabulary
from tests.llm import odd

VOCABULARY = default_vocabulary()


def rows(df):
    return [tuple(r) for r in df.collect()]


def same(got, want):
    assert Counter(got) == Counter(want)


# -------------------------------------------------------------- tokens
def test_packing(odd_docs, no_docs):
    ids = {}
    for (i, t), x in zip(odd.texts(), odd.token_ids(VOCABULARY, [t for _, t in odd.texts()])):
        ids.setdefault(i, []).append([*x, 0])
    got = packing.packed_digests(packing.pack(odd_docs)).collect()
    whole = Counter()
    for r in got:
        (own,) = [x for x in ids[r.doc_id] if len(x) == r.doc_tokens and odd.crc(x[r.start:r.start + r.length]) == r.ids_crc32][:1]
        whole[r.doc_id] += r.length
    assert whole == {i: sum(map(len, x)) for i, x in ids.items()}
    by = {}
    for r in sorted(got, key=lambda r: r.offset):
        assert by.get(r.sequence_id, 0) == r.offset
        by[r.sequence_id] = r.offset + r.length
    assert all(n <= 1024 and n & (n - 1) == 0 for n in by.values())
    assert not packing.pack(no_docs).collect()


@pytest.mark.parametrize("capacity", [1, 7, 100, 1024])
def test_packing_capacity(spark, capacity):
    docs = spark.createDataFrame([(i, "word " * (i * 7 % 50)) for i in range(60)], "doc_id long, text string").coalesce(2)
    length = Counter()
    for r in packing.pack(docs, capacity=capacity, end_id=5).collect():
        length[r.sequence_id] += r.length
        assert len(r.ids) == 4 * r.length
    assert max(length.values()) <= capacity


def packed_by(lengths, capacity):
    """Sequences of documents of these lengths as lists of (document, start, length)."""
    p = packing._Packer(capacity, 0)
    for i, n in enumerate(lengths):
        p.add(i, np.arange(n, dtype=np.uint32))
    filled = p.next
    p.close()
    out = {}
    for doc, start, n, tokens, seq, offset, ids in p.out:
        assert offset == sum(x[2] for x in out.get(seq, [])) and tokens == lengths[doc] and n > 0
        assert np.frombuffer(ids, np.uint32).tolist() == list(range(start, start + n))
        out.setdefault(seq, []).append((doc, start, n))
    for s in (out[i] for i in range(filled)):       # k of class k, then cuts that fill its room
        k = packing.length_class(s[0][2], capacity)
        assert [packing.length_class(x[2], capacity) for x in s[:k]] == [k] * k
        assert sum(x[2] for x in s) == capacity
    return out


@pytest.mark.parametrize("capacity", [1, 2, 10, 64, 1024])
@pytest.mark.parametrize("top", [3, 700, 5000])
def test_packing_classes(capacity, top):
    rng = np.random.default_rng(capacity + top)
    lengths = np.exp(rng.uniform(0, np.log(top), 400)).astype(int).clip(1).tolist()
    out = packed_by(lengths, capacity)
    spans = sorted(x for s in out.values() for x in s)
    at = {}
    for doc, start, n in spans:
        assert start == at.get(doc, 0)
        at[doc] = start + n
    assert [at[i] for i in range(len(lengths))] == lengths
    size = [sum(x[2] for x in s) for s in out.values()]
    short = [n for n in size if n < capacity]
    assert max(size) <= capacity and len(short) == len(set(short)) <= capacity.bit_length()
    if capacity & (capacity - 1) == 0:
        assert all(n & (n - 1) == 0 for n in short)
    assert len(spans) <= len(lengths) + 2 * (sum(lengths) // capacity) + 64


def test_packing_by_class_numbers():
    out = packed_by([400, 300, 500, 300, 1000, 300, 24, 2048 + 100], 1024)
    assert out[0] == [(0, 0, 400), (2, 0, 500), (3, 0, 124)]          # two of class 2, then the front of the next
    assert (4, 0, 1000) in out[1] and out[1][1] == (5, 0, 24)         # one of class 1
    assert (7, 0, 1024) in [x for s in out.values() for x in s if len(s) == 1]


def test_token_counts(spark, odd_docs, no_docs):
    values = [t for _, t in odd.texts()]
    want = [(i, len((t or "").encode()), len(x), len(x) > 512)
            for (i, t), x in zip(odd.texts(), odd.token_ids(VOCABULARY, values))]
    cache = new_path(spark, "cache")
    same(rows(token_counts.token_counts(odd_docs, cache_path=cache)), want)
    stored = spark.read.parquet(cache)
    n = stored.count()
    assert n == stored.select("digest").distinct().count() == len({t or "" for t in values})
    # a second run finds every count, another tokenizer none of them
    same(rows(token_counts.token_counts(odd_docs, cache_path=cache)), want)
    assert spark.read.parquet(cache).count() == n
    import public_tokenizers
    other = public_tokenizers.path("piece_bpe_32k.model")
    assert token_counts.token_counts(odd_docs, vocabulary=other, cache_path=cache).count() == len(values)
    assert spark.read.parquet(cache).count() == 2 * n
    assert not token_counts.token_counts(no_docs).collect()


def test_wavelet_shards(spark, odd_docs, no_docs):
    order = sorted(odd.texts(), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    ids = [[*x, 2] for x in odd.token_ids(VOCABULARY, [t for _, t in order])]
    path = new_path(spark, "shards")
    wavelet.write_shards(odd_docs, path, shard_ids=1000)
    shards = wavelet.read_shards(spark, path)
    got = sorted(rows(wavelet.read_documents(shards)), key=lambda r: r[1])
    starts = np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert [r[:4] for r in got] == [(i, s, len(x), odd.crc(x)) for (i, _), s, x in zip(order, starts, ids)]
    assert [np.frombuffer(r[4], "<u4").tolist() for r in got] == ids
    counts = Counter(i for x in ids for i in x)
    asked = [2, 13, 50256, *list(counts)[:5], 49999]
    assert dict(rows(wavelet.count_ids(shards, asked))) == {i: counts[i] for i in asked}
    want = Counter((d, k) for (d, _), x in zip(order, ids) for k, i in enumerate(x) if i == 50256)
    assert Counter(rows(wavelet.find_id(shards, 50256))) == want
    path = new_path(spark, "shards")
    wavelet.write_shards(no_docs, path)
    assert not wavelet.read_documents(wavelet.read_shards(spark, path)).collect()


@pytest.mark.parametrize("n, top", [(0, 1), (1, 1), (5, 1), (1000, 2), (3000, 50257), (1025, 1 << 20)])
def test_wavelet_matrix(n, top):
    a = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    m, doc, known, counts = wavelet.WaveletMatrix.unpack(
        wavelet.WaveletMatrix.of(a).pack(np.array([4]), np.array([True]), np.array([n])))
    assert m.decode().tolist() == a.tolist() and (doc.tolist(), known.tolist(), counts.tolist()) == ([4], [True], [n])
    at = np.arange(0, n, max(1, n // 50))
    assert m.access(at).tolist() == a[at].tolist()
    for v in [*a[:5].tolist(), top + 1]:
        where = np.flatnonzero(a == v)
        assert m.count(v) == len(where) and m.positions(v).tolist() == where.tolist()
        assert m.rank(v, n // 2) == int((where < n // 2).sum())
    with pytest.raises(IndexError):
        m.select(0, m.count(0))


# ------------------------------------------------------- decontamination
@pytest.mark.parametrize("max_windows", [1 << 20, 8])
def test_contamination(spark, odd_docs, no_docs, max_windows):
    bench = spark.createDataFrame(odd.items(), "item_id long, text string, score double").coalesce(1)
    found = decontaminate.contamination(odd_docs, bench, max_windows=max_windows)
    assert found.select("doc.*").columns == odd_docs.columns
    want = [(i, *x) for (i, _), x in zip(odd.texts(), odd.contamination([t for _, t in odd.texts()], odd.items()))]
    same(rows(decontaminate.contamination_digests(found)), want)
    assert any(x[-1] for x in want)


def test_contamination_empty(spark, odd_docs, no_docs):
    bench = spark.createDataFrame(odd.items(), "item_id long, text string, score double")
    assert not decontaminate.contamination(no_docs, bench).collect()
    none = decontaminate.contamination(odd_docs, bench.limit(0))
    assert none.count() == odd_docs.count() and not none.where("n_hit > 0 or contaminated").collect()


def test_words():
    values = [t for _, t in odd.texts()] + ["ab", "cd", "", "a", None, "b"]
    w = Words(pa.array(values, pa.string()))
    got = [[w.text(k).decode() for k in range(a, e)] for a, e in zip(w.first[:-1], w.first[1:])]
    assert got == [odd.words(t) for t in values]


# -------------------------------------------------------------- licences
def test_licenses(odd_docs, no_docs):
    got = {}
    for r in licenses.scan_digests(licenses.scan(odd_docs)).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in odd.texts():
        n, places = odd.base_places(t)
        at = [p for p, _ in places]
        base = ",".join(sorted({label for _, label in places}))
        (r, *_) = [r for r in got[i] if (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)
                   == (n, len(places), min(at, default=None), max(at, default=None), base)]
        assert set(filter(None, base.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert not licenses.scan(no_docs).collect()


def test_license_templates(spark):
    docs = spark.createDataFrame([(1, "x Licensed under the Apache License, Version 2.0."), (2, "apache license"),
                                  (3, "apache the license"), (4, "the MIT license"), (5, "GNU Lesser General Public License"),
                                  (6, "cc by nc"), (7, "license apache under")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, round(r.score, 2)) for r in licenses.scan_digests(licenses.scan(docs)).collect()}
    assert got[1] == ("apache-2.0", 1.0) and got[2][0] == "apache-2.0" and 0 < got[2][1] < 1
    assert got[3] == got[7] == ("", 0.0) and got[4][0] == "mit" and got[5][0] == "gpl,lgpl" and got[6][0] == "cc-by,cc-by-nc"


# ---------------------------------------------------------------- quality
def test_quality(spark, sf_dir, odd_docs, no_docs):
    docs, labels = odd_docs, spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels)
    out = quality.quality_digests(docs, model).collect()
    assert len(out) == len(odd.texts()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)
    import zlib
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    by_text = {}
    for (i, t) in odd.texts():
        by_text.setdefault(t or "", set()).add(i)
    score = {r.doc_id: r.score for r in out}
    assert score[4] == pytest.approx(score[5]) and score[8] == pytest.approx(score[9])   # ids are no input
    assert not quality.quality_scores(no_docs, model).collect()
    assert quality.train(docs, labels.limit(0)).constant == 0.5
    assert quality.train(no_docs, labels).constant == 0.5


def test_quality_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = (quality.quality_digests(docs, quality.train(docs, labels)).where("held_out").join(labels, "doc_id").collect())
    good, bad = [r.score for r in got if r.quality], [r.score for r in got if not r.quality]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.9, auc
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9


def test_attention_gradients():
    rng = np.random.default_rng(0)
    bag, y = np.array([1, 3, 2]), np.array([1.0, 0.0, 1.0])
    x = rng.random((6, 5))
    model = quality.fit(x, bag, y, hidden=4, gate=3, steps=1)
    p = model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}

    def loss():
        s = model.score(x, bag)
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for k, g in model._gradients(x, bag, y).items():
        for at in np.ndindex(p[k].shape):
            old = p[k][at]
            p[k][at] = old + 1e-5
            up = loss()
            p[k][at] = old - 1e-5
            assert g[at] == pytest.approx((up - loss()) / 2e-5, abs=1e-6)
            p[k][at] = old
    assert model.attention(x, bag)[1:4].sum() == pytest.approx(1)


# --------------------------------------------------------- repeated spans
@pytest.mark.parametrize("length, task_bytes", [(400, 64 << 20), (60, 64 << 20), (60, 500)])
def test_repeats(odd_docs, length, task_bytes):
    found = repeats.remove_repeats(odd_docs, length=length, keep_first=False, gram=min(32, length // 2), task_bytes=task_bytes)
    assert found.select("doc.*").columns == odd_docs.columns
    want = [(i, *x) for (i, _), x in zip(odd.texts(), odd.repeated([t for _, t in odd.texts()], length))]
    same(rows(repeats.repeat_digests(found)), want)


def test_repeats_keep_first(spark, no_docs):
    rng = random.Random(5)
    block = ["".join(rng.choice("ab") for _ in range(30)) for _ in range(6)]
    docs = [(i, "".join(rng.choice(block) for _ in range(rng.randint(0, 9)))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    for task_bytes in (64 << 20, 300):
        got = repeats.repeat_digests(repeats.remove_repeats(df, length=40, gram=16, task_bytes=task_bytes))
        same(rows(got), [(i, *x) for (i, _), x in zip(docs, odd.repeated([t for _, t in docs], 40, first=True))])
    assert not repeats.remove_repeats(no_docs).collect()


def test_segments_do_not_depend_on_the_batch(monkeypatch):
    """Both passes cut a long text at the same places, whatever stands before
    it in its batch."""
    monkeypatch.setattr(repeats, "PIECE", 1000)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcd") for _ in range(n)) for n in (3500, 0, 700, 300, 1000, 1001, 30, 2600)]

    def segments(order):
        raw, off = repeats.utf8(pa.array([texts[i] for i in order]))
        out = {i: [] for i in order}
        for text, start, windows, h in zip(*(x.tolist() for x in repeats.anchored(raw, off, 100, 20)), strict=True):
            out[order[text]].append((start - int(off[text]), windows, h))
        return out

    want = {i: segments([i])[i] for i in range(len(texts))}
    assert all(sum(w for _, w, _ in want[i]) == max(0, len(t) - 99) for i, t in enumerate(texts))
    for _ in range(20):
        order = rng.sample(range(len(texts)), len(texts))
        assert segments(order) == want


def test_longest_previous_factors():
    rng = random.Random(1)
    for depth in (1, 3, 6, 7, 20):
        for text in (b"", b"aaaaaaaaaaaa", bytes(rng.choice(b"ab") for _ in range(200)), b"\0\0\0\1\0\0\0\1"):
            n = len(text) - depth + 1
            earlier, later = repeats.longest_previous_factors(text, depth)
            w = [text[i:i + depth] for i in range(max(0, n))]
            assert earlier.tolist() == [w.index(x) < i for i, x in enumerate(w)]
            assert later.tolist() == [x in w[i + 1:] for i, x in enumerate(w)]


# ----------------------------------------------------------- similar rows
def test_near_duplicates(odd_docs, no_docs):
    want = odd.near_classes([(i, t) for i, t in odd.texts() if i is not None])
    got = rows(near_dup.near_duplicates(odd_docs))
    same(got, [*want.items(), (None, None)])
    assert not near_dup.near_duplicates(no_docs).collect()


def test_near_duplicates_large_group(spark):
    """More texts in a bucket than are compared pair by pair."""
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(200)]
    docs = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(200)] = f"x{rng.randint(0, 10 ** 6)}"
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, " ".join(f"y{rng.randint(0, 10 ** 6)}" for _ in range(30))) for i in range(50)]
    got = dict(rows(near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))))
    assert got == odd.near_classes(docs)


def test_near_duplicates_beyond_chosen_partners(spark, monkeypatch):
    """A link between texts of a large bucket that are not each other's chosen
    partners, nor in one tile, is found."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(1000)]
    docs = []
    for i in range(60):       # two by two similar (0.82), all of one template (0.72)
        own = [f"x{i // 2}y{k}" for k in range(76)]
        docs.append((i, " ".join(base + own + [f"z{i}y{k}" for k in range(rng.randint(115, 121))])))
    for name, value in (("SMALL", 2), ("BEST", 1), ("ANY", 1), ("TILE", 2)):
        monkeypatch.setattr(near_dup, name, value)
    for tile in (16 << 20, 8 * 16384):
        monkeypatch.setattr(near_dup, "SET_TILE", tile)
        got = dict(rows(near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))))
        assert got == odd.near_classes(docs) == {i: i // 2 * 2 for i in range(60)}


def test_near_duplicates_repeated_phrase(spark):
    """A phrase counts once, however often a text repeats it."""
    docs = []
    for i in range(20):
        words, phrase = [f"a{i}w{k}" for k in range(100)], [f"p{i}w{k}" for k in range(10)]
        docs += [(2 * i, " ".join(words + phrase)), (2 * i + 1, " ".join(words + phrase * (30, 100)[i % 2]))]
    got = dict(rows(near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))))
    assert got == odd.near_classes(docs) == {i: i // 2 * 2 for i in range(40)}


def test_similar_sets():
    rng = np.random.default_rng(9)
    sets = [np.sort(rng.choice(60, rng.integers(1, 50), replace=False).astype(np.uint64)).tobytes() for _ in range(300)]
    x, y = sets[:280], sets[200:]
    want = {(i, j) for i, a in enumerate(x) for j, b in enumerate(y) if near_dup.jaccard(a, b) >= 0.4}
    for chunk in (1 << 22, 100):
        assert set(zip(*(k.tolist() for k in near_dup.similar(x, y, 0.4, chunk)), strict=True)) == want


def test_prob_minhash_estimates():
    """Registers agree with the probability Jaccard similarity of weighted sets."""
    rng = np.random.default_rng(4)
    a = {int(h): float(w) for h, w in zip(rng.integers(1, 1 << 62, 60), rng.integers(1, 6, 60))}
    b = {h: w + rng.integers(0, 3) for h, w in list(a.items())[:45]} | {int(h): 2.0 for h in rng.integers(1, 1 << 62, 10)}
    want = sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in {*a, *b}) for i in {*a} & {*b})
    h = np.array([*a, *b], np.uint64)
    row = np.array([0] * len(a) + [1] * len(b))
    w = np.array([*a.values(), *b.values()])
    s = near_dup.prob_minhash(h, row, w, 3, registers=4096)
    assert (s[0] == s[1]).mean() == pytest.approx(want, abs=0.04) and not s[2].any()


def test_components(spark):
    rng = random.Random(7)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] \
        + [(500, i) for i in range(501, 560)] + [(3, 3)]
    groups = odd.Groups({n for e in edges for n in e})
    for a, b in edges:
        groups.link(a, b)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    got = components(spark.createDataFrame([*edges, (1, None)], "a long, b long"))
    assert dict(rows(got)) == {n: groups.of(n) for n in linked}
    assert got.count() == len(linked)
    assert not components(spark.createDataFrame([], "a long, b long")).collect()


def test_lines(odd_docs, no_docs):
    found = line_dedup.dedup_lines(odd_docs)
    assert found.select("doc.*").columns == odd_docs.columns
    got = {}
    for r in found.collect():
        got.setdefault(r.doc.doc_id, []).append(r)
    # groups of all lines with words, by comparing all pairs of similar length
    order = sorted({(i, t) for i, t in odd.texts()}, key=lambda x: (x[0] is not None, x[0] or 0))
    lines = [((i is not None, i or 0, k), " ".join(odd.words(x))) for i, t in order for k, x in enumerate((t or "").split("\n"))]
    first = {}
    for at, x in lines:
        if x:
            first[x] = min(first.get(x, at), at)
    # lines are linked by the method if their SimHashes are close, and similar
    distinct = list(first)
    sim = {x: line_dedup.Lines(pa.array([x])).simhashes(np.array([0])).view(np.uint64)[0] for x in distinct}
    groups, links = odd.Groups(first), 0
    for n, a in enumerate(distinct):
        for b in distinct[n + 1:]:
            if np.bitwise_count(sim[a] ^ sim[b]) <= 3 and 5 * odd.distance(a, b) <= max(len(a), len(b)):
                groups.link(a, b)
                links += 1
    assert links
    keep = {}
    for x, at in first.items():
        keep[groups.of(x)] = min(keep.get(groups.of(x), at), at)
    for i, t in order:
        left = [x for k, x in enumerate((t or "").split("\n")) if not odd.words(x) or keep[groups.of(" ".join(odd.words(x)))]
                == (i is not None, i or 0, k)]
        assert any(r.kept == (None if t is None else "\n".join(left)) and r.n_lines == len((t or "").split("\n"))
                   and r.n_lines - r.n_removed == len(left) for r in got[i]), i
    assert not line_dedup.dedup_lines(no_docs).collect()


def test_lines_of_one_doc_id(spark):
    """A row loses only its own lines, though another has its doc_id."""
    docs = [(0, "same line here"), (1, "same line here\nunique words in this one"),
            (1, "private words of its own\nanother line entirely"), (1, "private words of its own\nanother line entirely")]
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r.kept for r in got) == sorted(["same line here", "unique words in this one", docs[2][1], docs[2][1]])


def test_simhash_pairs():
    """The blocks find every pair of at most three different bits."""
    rng = np.random.default_rng(1)
    sim = rng.integers(0, 1 << 62, 300)
    near = sim.copy()
    for i in range(300):
        for bit in rng.choice(64, rng.integers(0, 6), replace=False):
            near[i] ^= np.int64(np.uint64(1) << np.uint64(bit)) if bit < 63 else np.int64(-(1 << 63))
    both = np.concatenate([sim, near])
    found = set()
    for b in range(4):
        block = ((both.view(np.uint64) >> np.uint64(16 * b)) & np.uint64(65535)).astype(np.int64) * 4 + b
        order = np.argsort(block, kind="stable")
        x, y = line_dedup.close_pairs(block[order], both[order])
        found |= {tuple(sorted(p)) for p in zip(order[x].tolist(), order[y].tolist())}
    bits = np.bitwise_count(both.view(np.uint64)[:, None] ^ both.view(np.uint64))
    assert found == {(i, j) for i, j in np.argwhere(bits <= 3).tolist() if i < j}


@pytest.mark.parametrize("block, tile", [(1 << 17, 4096), (1 << 17, 16), (50, 16)])
def test_lines_of_long_runs(spark, monkeypatch, block, tile):
    """Every similar pair of a long run is found, in shares of a block and
    pairs of tiles too; near SimHashes of different texts keep pairs apart."""
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    monkeypatch.setattr(line_dedup, "TILE", tile)
    rng = np.random.default_rng(5)
    monkeypatch.setattr(line_dedup, "_links", lambda pairs, texts, similarity: pairs.join(
        texts.select(F.col("id").alias("a"), F.col("normal").alias("x")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("normal").alias("y")), "b")
        .where(F.substring("x", 1, 12) == F.substring("y", 1, 12)).select("a", "b"))
    long = [f"template{k} of forty words that are the same in every one of these lines" for k in range(40)]
    docs = [(i, f"key{i % 100:08d}x " + " ".join(long) + f" n{rng.integers(10 ** 9)}") for i in range(200)]
    sim = np.array([line_dedup.Lines(pa.array([t])).simhashes(np.array([0])).view(np.uint64)[0] for _, t in docs])
    groups = odd.Groups({i: 0 for i, _ in docs})
    for i in range(100):
        if np.bitwise_count(sim[i] ^ sim[i + 100]) <= 3:
            groups.link(i, i + 100)
    want = {i: int(groups.of(i) != i) for i, _ in docs}
    assert sum(want.values()) > 80
    got = line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert {r.doc.doc_id: r.n_removed for r in got.collect()} == want


# ------------------------------------------------------------------ search
def test_exact_topk(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, rng.integers(-3, 4, 8).astype(float).tolist(), "x") for i in range(0, 130)]
    vectors += [(200, None, "x"), (201, [1.0, None], "x"), (202, [float("nan")] * 8, "x"), (220, [float("inf")] * 8, "x"),
                (None, [1.0] * 8, "x"), (240, [], "x"), (241, [2.0] * 3, "x"), (260, [1e-3] * 8, None), (40, vectors[40][1], "x")]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, score string").repartition(3)
    good = {}
    for i, v, _ in vectors:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            good[i] = np.pad(np.floor(64 * np.array(v, float)), (0, 8 - len(v))).astype(int)
    want = []
    for q in (i for i in good if i % 20 == 0):
        best = sorted((-int(good[q] @ good[c]), c) for c in good if c != q)[:20]
        want += [(q, k, c, -s) for k, (s, c) in enumerate(best, 1)]
    same(rows(exact_topk.top_k(df)), want)
    old = exact_topk.SHARD, exact_topk.BLOCK
    try:
        exact_topk.SHARD, exact_topk.BLOCK = 7, 3       # many tiles, and a tree of two levels
        same(rows(exact_topk.top_k(df)), want)
    finally:
        exact_topk.SHARD, exact_topk.BLOCK = old
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert rows(exact_topk.top_k(few)) == [(0, 1, 1, 64 * 128)]
    assert not exact_topk.top_k(df.limit(0)).collect()


def test_exact_topk_large_values(spark):
    docs = [(0, [2.0 ** 20, 1.0]), (1, [2.0 ** 22, 3.0]), (2, [2.0 ** 22, 3.0]), (3, [-(2.0 ** 22), 0.0])]
    got = rows(exact_topk.top_k(spark.createDataFrame(docs, "vec_id long, embedding array<double>")))
    s = 64 * 64 * (2 ** 42 + 3)
    assert got == [(0, 1, 1, s), (0, 2, 2, s), (0, 3, 3, -64 * 64 * 2 ** 42)]
    huge = spark.createDataFrame([(0, [1e30]), (1, [1e30]), (2, [-1e30]), (3, [1.0])], "vec_id long, embedding array<double>")
    assert rows(exact_topk.top_k(huge)) == [(0, 1, 1, exact_topk.LAST), (0, 2, 3, exact_topk.LAST), (0, 3, 2, -exact_topk.LAST)]


@pytest.mark.parametrize("bits", [10, 29, 31, 33, 50, 62])
def test_scores_are_exact_or_the_nearest(bits):
    rng = np.random.default_rng(bits)
    q, c = (rng.integers(-(1 << bits), 1 << bits, (n, 5)) for n in (40, 50))
    q[0], c[0] = [1 << bits, 1, -(1 << bits), 0, 3], [1 << bits, 2, 1 << bits, 0, 5]      # large terms that cancel
    got = exact_topk.scores(q, c)
    for i in range(len(q)):
        for j in range(len(c)):
            exact = sum(a * b for a, b in zip(q[i].tolist(), c[j].tolist()))
            assert got[i, j] == max(-exact_topk.LAST, min(exact_topk.LAST, exact))


def levenshtein(s, t):
    row = list(range(len(t) + 1))
    for i, x in enumerate(s, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(t, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_bound_of_edit_distance():
    rng = random.Random(3)
    for _ in range(3000):
        a = [rng.choice("a b cd ee f gh i jkl m n".split()) for _ in range(rng.randrange(1, 12))]
        b = list(a)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = rng.choice([[], ["x"], ["cd", "b"], ["", "m"]])
        rng.random() < .3 and rng.shuffle(b)
        s, t = " ".join(a)[rng.randrange(2):], " ".join(b)
        assert line_dedup.at_most(s, t) >= levenshtein(s, t)
    assert line_dedup.at_most("one two three four", "one 2 three four") == 4
    assert line_dedup.at_most("", "") == 0 and line_dedup.at_most("ab", "") == 3


def test_simhash_counts_bits():
    rng = np.random.default_rng(4)
    size = np.array([1, 3, line_dedup.RUN, line_dedup.RUN + 1, 3 * line_dedup.RUN + 5, 2])
    h, w = rng.integers(0, 1 << 63, int(size.sum())).astype(np.uint64), rng.integers(1, 9, int(size.sum()))
    begin = np.cumsum(size) - size
    got = line_dedup.simhash(h, w, begin, size, chunk=100).view(np.uint64)
    bits = np.unpackbits(line_dedup.mix(h)[:, None].view(np.uint8), axis=1, bitorder="little").astype(np.int64)
    for i, (a, n) in enumerate(zip(begin, size)):
        major = 2 * (bits[a:a + n] * w[a:a + n, None]).sum(axis=0) > w[a:a + n].sum()
        assert got[i] == sum(1 << b for b in range(64) if major[b])


def test_key_filter_is_no_cut(spark):
    keys = [bytes([i]) * 16 for i in range(100)]
    bits = np.unpackbits(line_dedup._key_filter(spark.createDataFrame([(bytearray(k),) for k in keys], "key binary"))).view(bool)
    at = line_dedup._filter_bits(np.frombuffer(b"".join(keys), np.uint8))
    assert bits[at].all()
