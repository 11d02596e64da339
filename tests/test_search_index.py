"""The inverted index against plain counting over the same documents."""
import contextlib
import io
import math
import random
import re

import pytest

from shopstream.session import scratch_path
from shopstream.sources.search_index import SearchIndex

WORDS = ["red", "blue", "of", "the", "and", "widget", "été"] + [f"w{i}" for i in range(20)]


def tokens(text):
    return [t for t in re.split(r"[\W_]+", (text or "").lower()) if t]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x") for i, t in docs], "id long, text string, dl string")


def bm25(docs, words, k):
    tok = {i: tokens(t) for i, t in docs.items()}
    mean = sum(map(len, tok.values())) / len(tok)
    score = {}
    for w in set(words):
        holds = [i for i in tok if w in tok[i]]
        idf = math.log(1 + (len(tok) - len(holds) + 0.5) / (len(holds) + 0.5))
        for i in holds:
            tf = tok[i].count(w)
            score[i] = score.get(i, 0) + idf * tf / (tf + 1.2 * (0.25 + 0.75 * len(tok[i]) / mean))
    return sorted(((i, round(s, 9)) for i, s in score.items()), key=lambda x: (-x[1], x[0]))[:k]


def check(index, docs):
    tok = {i: tokens(t) for i, t in docs.items()}
    hits = lambda f: {i: f(t) for i, t in tok.items() if f(t)}
    count = lambda *w: lambda t: sum(x in w for x in t)
    assert {r.id: r.n_hits for r in index.match_any("RED été, red").collect()} == hits(count("red", "été"))
    both = lambda t: count("red", "of")(t) if {"red", "of"} <= set(t) else 0
    assert {r.id: r.n_hits for r in index.match_all("of red").collect()} == hits(both)
    places = lambda *p: lambda t: sum(t[i:i + len(p)] == list(p) for i in range(len(t)))
    assert {r.id: r.n_hits for r in index.match_phrase("of the").collect()} == hits(places("of", "the"))
    assert {r.id: r.n_hits for r in index.match_phrase("red red").collect()} == hits(places("red", "red"))
    for k in (1, 5, 1000):
        got = [(r.id, round(r.score, 9)) for r in index.ranked("the red of", k).collect()]
        want = bm25(docs, ["the", "red", "of"], k)
        assert [s for _, s in got] == pytest.approx([s for _, s in want])
        assert {i for i, s in got if s > want[-1][1] + 1e-8} == {i for i, s in want if s > want[-1][1] + 1e-8}
    n, total = index.statistics()
    assert (n, total) == (len(tok), sum(map(len, tok.values())))


def random_docs(rng, ids):
    return [(i, " ".join(rng.choices(WORDS, [9, 1, 9, 9] + [1] * 23, k=rng.choice([0, 1, 5, 30, 400])))) for i in ids]


def test_versions_deletions_repeats_and_merges(spark):
    rng, live = random.Random(5), {}
    index = SearchIndex(spark, scratch_path(spark, "test-index"), buckets=5, blocks=40)
    batches = [(random_docs(rng, range(0, 300)), []), (random_docs(rng, range(200, 400)), [3, 4, 999]),
               (random_docs(rng, [3, 250, 251]), [5, 300])]
    for b, (docs, deleted) in enumerate(batches):
        gone = spark.createDataFrame([(i,) for i in deleted], "id long")
        for _ in range(2 if b else 1):          # a batch that is repeated replaces itself
            index.write_batch(frame(spark, docs), b, deleted=gone)
        for i in deleted:
            live.pop(i, None)
        live.update(docs)
        if b == 1:
            index.merge()
    check(index, live)
    index.merge()
    assert not index._read("dead").count() and index._read("docs").count() == len(live)
    check(index, live)


def test_odd_texts_and_empty_index(spark):
    index = SearchIndex(spark, scratch_path(spark, "test-index"), buckets=3, blocks=4)
    index.merge()
    assert not index.match_any("red").collect() and not index.ranked("red").collect()
    index.write_batch(frame(spark, []), 0)
    assert not index.match_all("red").collect() and index.statistics() == (0, 0)
    docs = [(1, None), (2, ""), (3, "Red red RED_of,the"), (4, "ПИСЬМО red " * 3000), (5, "...")]
    index.write_batch(frame(spark, [*docs, (None, "red")]), 1)
    assert {r.id: (r.n_terms, r.n_hits) for r in index.match_any("red the").collect()} == {3: (2, 4), 4: (1, 3000)}
    assert {r.id: r.n_hits for r in index.match_phrase("red письмо red").collect()} == {4: 2999}
    assert not index.match_any("").collect() and not index.match_all(" ,").collect() and not index.match_phrase("").collect()
    assert index.statistics() == (5, 6005)


def test_requests_read_only_their_terms_buckets(spark):
    index = SearchIndex(spark, scratch_path(spark, "test-index"), buckets=16, blocks=4)
    index.write_batch(frame(spark, random_docs(random.Random(1), range(50))), 0)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        index.match_any("red").explain("formatted")
    filters = [ln for ln in buf.getvalue().splitlines() if "PartitionFilters" in ln and "bucket" in ln]
    assert filters and any("PushedFilters" in ln and "term" in ln for ln in buf.getvalue().splitlines())
    assert "positions" not in next(ln for ln in buf.getvalue().splitlines() if "ReadSchema" in ln and "term" in ln)


def test_stream_of_batches_restarts(spark):
    source, checkpoint = scratch_path(spark, "test-index-in"), scratch_path(spark, "test-index-cp")
    index, live = SearchIndex(spark, scratch_path(spark, "test-index"), buckets=3, blocks=8), {}
    rng = random.Random(2)
    for ids in (range(0, 40), range(30, 60)):      # a run, and one that goes on from its checkpoint
        docs = random_docs(rng, ids)
        live.update(docs)
        frame(spark, docs).coalesce(1).write.mode("append").parquet(source)
        (spark.readStream.schema("id long, text string, dl string").parquet(source).writeStream
         .foreachBatch(lambda df, b: index.write_batch(df, b)).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start().awaitTermination())
    check(index, live)


def test_terms_are_counted_where_a_document_is_read():
    import pyarrow as pa

    from shopstream.sources.search_index import _postings
    tok = [[], ["b", "a", "b"], [], ["a", "a"]]
    docs = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array([0, 3, 0, 2]), pa.array(tok, pa.list_(pa.string()))],
                                      ["id", "dl", "tok"])
    rows = [tuple(r.values()) for b in _postings(iter([docs.slice(0, 1), docs, docs.slice(1, 3)])) for r in b.to_pylist()]
    want = [(2, 3, "a", 1, [1]), (2, 3, "b", 2, [0, 2]), (4, 2, "a", 2, [0, 1])]
    assert sorted(rows) == sorted(want * 2)


def test_an_id_that_stands_twice_has_one_posting_for_a_term(spark):
    index = SearchIndex(spark, scratch_path(spark, "t-index-twice"), buckets=2, blocks=2)
    index.write_batch(frame(spark, [(1, "red of"), (1, "of red"), (2, "red")]), 0)
    assert {r.id: (r.n_terms, r.n_hits) for r in index.match_any("red").collect()} == {1: (1, 2), 2: (1, 1)}
