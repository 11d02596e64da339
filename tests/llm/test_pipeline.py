"""The pipeline's stages on odd tables, each against a plain version on its own
input, and run() against the stages."""
from collections import Counter

import corpus_pipeline as cp
from shopstream.llm import line_dedup, quality
from shopstream.llm.pieces import default_vocabulary
from tests.llm import odd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def values(df):
    return Counter(tuple(r) for r in df.collect())


def stage(name):
    return dict(cp.STAGES)[name]


def test_stages_and_run(spark, sf_dir, no_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "line dedup", "MinHash near-dedup", "benchmark decontamination",
                                         "packing"]
    kept = docs
    outs = []
    for name, f in cp.STAGES[:-1]:
        kept = spark.createDataFrame(f(spark, kept, sf_dir).collect(), docs.schema)
        assert kept.schema == docs.schema
        outs.append(kept)
    first, lines, near, clean = outs
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.quality_scores(docs, quality.train(docs, labels))
    assert values(first) == values(scored.where("score >= 0.3").select("doc.*"))
    got = Counter((r.doc.doc_id, r.kept) for r in line_dedup.dedup_lines(first).collect())
    assert Counter((r.doc_id, r.text) for r in lines.collect()) == got
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in lines.collect())
    before = [(r.doc_id, r.text) for r in lines.collect()]
    classes = odd.near_classes([x for x in before if x[0] is not None])
    assert sorted(r.doc_id for r in near.collect() if r.doc_id is not None) == sorted(set(classes.values()))
    assert Counter(r.text for r in near.collect() if r.doc_id is None) == Counter(t for i, t in before if i is None)
    before = [tuple(r) for r in near.collect()]
    judged = odd.contamination([r[1] for r in before], odd.items())
    assert values(clean) == Counter(r for r, x in zip(before, judged) if not x[-1])
    last = [(r.doc_id, r.text) for r in clean.collect()]
    ids = [len(x) + 1 for x in odd.token_ids(default_vocabulary(), [t for _, t in last])]
    want = Counter()
    for (i, _), n in zip(last, ids):
        want[i] += n
    whole = Counter()
    for r in cp.run(spark, sf_dir).collect():
        whole[r.doc_id] += r.length
    assert whole == want


def test_stages_on_empty_tables(spark, sf_dir, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    for name, f in cp.STAGES:
        assert not f(spark, docs, sf_dir).collect(), name
    one = spark.createDataFrame([(1, None, None, None, None), (1, None, None, None, None)], SCHEMA)
    empty = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    sizes = [2, 2, 1, 2, 2]
    assert [f(spark, one, empty).count() for _, f in cp.STAGES] == sizes


def test_planted_copies(spark, tmp_path):
    """Copies and near copies go, contaminated documents go, others stay."""
    import random
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    item = text(40)
    plain = [text(120) for _ in range(30)]
    near = plain[0].split(" ")
    near[60] = "other"
    rows = list(enumerate([*plain, plain[3], " ".join(near), item + " " + text(30), text(400) + " " + item[:60]]))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)
    d = str(tmp_path)
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    left = stage("MinHash near-dedup")(spark, docs, d)
    assert {r.doc_id for r in left.collect()} == set(range(30)) | {32, 33}
    left = stage("benchmark decontamination")(spark, left, d)
    assert {r.doc_id for r in left.collect()} == set(range(30)) | {33}
