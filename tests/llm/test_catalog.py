"""The registered queries on the smallest tables, against SQL where there is
some, else against plain versions over the whole tables."""
import duckdb
import pytest

import __spark_entry__ as E
from shopstream.llm import catalog
from tests.llm import odd
from tests.oracle_harness import compare

SF = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = sorted(catalog.QUERIES, key=lambda n: int(n[2:].split("_")[0]))
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(E.queries()) and set(catalog.ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_sql(spark, name):
    assert compare(spark, SF, [name], verbose=False)[name] == "OK"


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()


def _rows(spark, name):
    return {r[0]: tuple(r)[1:] for r in catalog.QUERIES[name](spark, SF).collect()}


def test_repeated_spans(spark, documents):
    want = odd.repeated([t for _, t in documents], 400)
    assert _rows(spark, "op2_repeated_spans") == {i: x for (i, _), x in zip(documents, want)}


def test_decontamination(spark, documents):
    items = duckdb.sql(f"select item_id, text from '{SF}/benchmark.parquet'").fetchall()
    want = odd.contamination([t for _, t in documents], items)
    assert _rows(spark, "op6_prefix_decontamination") == {i: x for (i, _), x in zip(documents, want)}


def test_near_duplicates(spark, documents):
    assert _rows(spark, "op8_prob_minhash") == {i: (c,) for i, c in odd.near_classes(documents).items()}


def test_license_places(spark, documents):
    got = _rows(spark, "op10_license_index")
    for i, t in documents:
        n, places = odd.base_places(t)
        at = [p for p, _ in places]
        assert got[i][:5] == (n, len(places), min(at, default=None), max(at, default=None),
                              ",".join(sorted({label for _, label in places})))


def test_alignment(spark, documents):
    want = odd.aligned([t for _, t in documents])
    assert _rows(spark, "op11_pointer_alignment") == {i: x for (i, _), x in zip(documents, want)}


def test_language_of_held_out_documents(spark):
    rows = duckdb.sql(f"select doc_id, text, lang from '{SF}/documents.parquet'").fetchall()
    got, want = _rows(spark, "op12_language_bayes"), odd.languages(rows)
    assert {i: x[:2] for i, x in got.items()} == {i: x[:2] for i, x in want.items()}
    assert all(abs(got[i][2] - x[2]) < 1e-6 for i, x in want.items())
    held = [got[i][1] == lang for i, _, lang in rows if got[i][0]]
    assert len(held) > 20 and sum(held) >= 0.9 * len(held)
