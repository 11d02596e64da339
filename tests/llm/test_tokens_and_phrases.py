"""Operators 11 to 13 on odd rows, and their parts against plain versions."""
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shopstream.llm import alignment, collocations, language, line_dedup
from tests.llm import odd

public_tokenizers = pytest.importorskip("public_tokenizers")

from shopstream.llm.pieces import SentencePieceEncoder, span_hashes  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PIECES = SentencePieceEncoder(MODEL)


# ---------------------------------------------------------------- encoders
@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(list("  \n\tabthe.é▁中ﬁ́")), st.characters(codec="utf-8")), max_size=40), max_size=4))
def test_space_pieces_give_the_librarys_ids(texts):
    ids, counts = PIECES.encode([" " + t for t in texts])
    want = [PIECES.lib.encode(t) for t in texts]
    assert counts.tolist() == [len(x) for x in want]
    assert ids.tolist() == [i for x in want for i in x]


def test_words_of_one_structure_have_hashes_of_their_own():
    """The Thue-Morse words over two letters collide under any polynomial
    modulo a power of two."""
    a = np.array([bin(i).count("1") % 2 for i in range(2048)], np.uint8) + 97
    for n in (64, 200, 1024, 2048):
        both = np.concatenate([a[:n], 195 - a[:n]])
        h = span_hashes(both, np.array([0, n]), np.array([n, 2 * n]))
        assert h[0] != h[1]


def test_lines_a_fifth_longer_are_linked(spark):
    texts = ["abcd", "abcde", "abcdf", "abc", "abcdefghij", "abcdefgh"]
    pairs = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts))]
    got = line_dedup._links(spark.createDataFrame(pairs, "a long, b long"),
                            spark.createDataFrame(list(enumerate(texts)), "id long, normal string"), 0.8).collect()
    want = {(a, b) for a, b in pairs if 5 * odd.distance(texts[a], texts[b]) <= max(len(texts[a]), len(texts[b]))}
    assert {(r.a, r.b) for r in got} == want and (0, 1) in want and (4, 5) in want


# --------------------------------------------------------------- alignment
@settings(max_examples=200, deadline=None)
@given(st.integers(1, 60), st.randoms(use_true_random=False))
def test_pointer_jumping_labels_components(n, rng):
    def ends():
        return np.array(sorted({n, *(rng.randint(1, n) for _ in range(rng.randint(0, n)))}))

    a, b = ends(), ends()
    both = sorted(set(a.tolist()) & set(b.tolist()))
    want = lambda e: [sum(c < x for c in both) for x in e.tolist()]
    ga, gb = alignment.groups(a, b)
    assert ga.tolist() == want(a) and gb.tolist() == want(b)


def _aligned(df, **more):
    return sorted((tuple(r) for r in alignment.align(df, **more).collect()), key=str)


def _want_aligned():
    return sorted(((i, *x) for (i, _), x in zip(odd.texts(), odd.aligned([t for _, t in odd.texts()]))), key=str)


def test_alignment_of_odd_rows(odd_docs, no_docs):
    assert _aligned(odd_docs) == _want_aligned()
    assert alignment.align(no_docs).collect() == []


def test_alignment_joins_where_counts_are_too_many_to_send(odd_docs):
    assert _aligned(odd_docs, broadcast_pairs=5) == _want_aligned()


def test_alignment_of_large_groups(odd_docs, monkeypatch, spark):
    texts = ["aaaa" * 30, "日本" * 20 + "x" * 33, " ab" * 9, "aaaa" * 30]
    for limit in (0, 2):    # pairs of all groups, or of most, come in parts
        monkeypatch.setattr(alignment, "LARGE", limit)
        a = alignment.Aligned(texts, public_tokenizers.path("byte_bpe_50k.json"), MODEL)
        got = {}
        for row, x, y, n in a.pairs():
            for k in zip(row.tolist(), x.tolist(), y.tolist(), n.tolist()):
                got[k[:3]] = got.get(k[:3], 0) + k[3]
        want = {}
        for i, t in enumerate(texts):
            for p, q in odd.alignment_groups(t):
                for x in p:
                    for y in q:
                        want[i, x, y] = want.get((i, x, y), 0) + 1
        assert got == want


def test_alignment_shows_its_groups(spark):
    text = "Tokenizers disagree: naïveté, 中文字 <s> <|endoftext|>"
    row = alignment.align(spark.createDataFrame([(1, text)], "doc_id int, text string"), digest=False).first()
    assert row["groups"] == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in odd.alignment_groups(text))


# ---------------------------------------------------------------- language
def test_languages_of_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, None).when(F.col("doc_id") % 2 == 0, "x").otherwise("y"))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    want = odd.languages(rows)
    got = language.language_digests(docs).collect()
    assert len(got) == len(rows) and {r.doc_id for r in got} == set(want)
    texts = {}
    for i, t, _ in rows:
        texts.setdefault(i, []).append(t)
    for r in got:
        if len(texts[r.doc_id]) > 1:        # several texts of one id
            continue
        held, name, score = want[r.doc_id]
        assert (r.held_out, r.lang_pred) == (bool(held), name) and abs(r.score - score) < 1e-6
    empty = language.language_digests(no_docs)
    assert empty.collect() == [] and empty.columns == ["doc_id", "held_out", "lang_pred", "score"]
    nothing = language.language_digests(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_many_languages_come_in_slices(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("abcdefgh" if i % 3 else "ghijklmno") + rng.choice(["", " "]) for _ in range(30)), f"l{i % 7}")
            for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    whole = sorted(map(tuple, language.language_digests(df).collect()))
    monkeypatch.setattr(language, "SLICE", 2)
    monkeypatch.setattr(language, "HELD_LANGUAGES", 1)
    parts = sorted(map(tuple, language.language_digests(df).collect()))
    assert [x[:3] for x in whole] == [x[:3] for x in parts]
    assert all(abs(x[3] - y[3]) < 1e-9 for x, y in zip(whole, parts))


def test_features_do_not_depend_on_the_texts_beside():
    texts = ["Ab c", "", "?!", "É  中", "abc", "\n", "x"]
    flat, total = language.features(texts)
    alone = [language.features([t])[0].tolist() for t in texts]
    assert total.tolist() == [len(x) for x in alone] and flat.tolist() == [i for x in alone for i in x]
    assert alone[0] == language.features(["...aB\t\tC..."])[0].tolist()


# ------------------------------------------------------------------ phrases
def _mined(df, **more):
    return sorted(tuple(r) for r in collocations.collocations(df, **more).collect())


def _wordy(n=400):
    rng = random.Random(8)
    words = ["a", "b", "B", "é", "c.", ",d", "e\t", "f\n", "中", "\x0bg", "-", " h", "i;j"]
    rows = [(" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))), rng.choice(["x", "y", None, "und"])) for _ in range(n)]
    return rows + [(None, "x"), ("", None), ("a b c d " * 60, "y"), ("a b c d " * 60, "y"), ("...", "z")]


@pytest.mark.parametrize("least, top, bits", [(30, 2000, 24), (5, 50, 16), (2, 2000, 3)])
def test_collocations(spark, least, top, bits):
    rows = _wordy()
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    want = odd.collocations(rows, top, least)
    assert want and _mined(df, least=least, top=top, sketch_bits=bits) == want


def test_collocations_of_odd_rows(odd_docs, no_docs):
    rows = [(r.text, r.lang) for r in odd_docs.select("text", "lang").collect()]
    assert _mined(odd_docs, least=2, sketch_bits=18) == odd.collocations(rows, 2000, 2)
    assert _mined(no_docs) == []


def test_windows_of_one_word_and_of_none():
    t = collocations.Tokens(pa.array(["one", None, "", " . "]))
    cols, of, n = collocations.windows(t, np.zeros(4, np.int64), [np.zeros(0, bool)] * 3)
    assert cols.tolist() == [[0], [-1], [-1], [-1]] and n.tolist() == [1]


def test_the_phrase_sketch_grows_with_the_text(spark, monkeypatch):
    """A sketch of one size fills up: every rare phrase then goes on as a
    window of four words.  Tasks hand counters on as often as they must."""
    monkeypatch.setattr(collocations, "SKETCH_BITS", 8)
    monkeypatch.setattr(collocations, "HELD", 500)
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(3_000)}" for _ in range(40)) + " so it is" for _ in range(400)]
    df = spark.createDataFrame([(t, "x") for t in texts], "text string, lang string").repartition(3)
    bits = collocations.sketch_size(sum(map(len, texts)))
    small, fit = (collocations._frequent(df, 30, k) for k in (8, bits))
    assert np.unpackbits(small).mean() == 1 and 0 < np.unpackbits(fit).mean() < 0.05
    long = lambda bits, likely: collocations._windows(df, likely, bits).where("w4 != ''").count()
    assert long(8, small) > 15_000 and long(bits, fit) < 800
    rows = [(t, "x") for t in texts]
    assert _mined(df) == odd.collocations(rows, 2000, 30) != []
    assert collocations.sketch_size(6 * 10**9) == 26 and collocations.sketch_size(0) == 8
