"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import pytest

import __spark_entry__ as E
from shopstream.plans import catalog, oracle
from tests.oracle_harness import compare

NAMES = sorted(catalog.QUERIES)


def test_every_query_is_checked():
    assert set(catalog.QUERIES) == set(oracle.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, name):
    res = compare(spark, sf_small, [name], verbose=False)[name]
    assert res == "OK" or res.startswith("rows-only"), res


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [f.name for f in df.schema.fields] == ["name", "value"]
    assert len(rows) == 3
