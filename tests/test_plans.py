"""Plan guards: what every batch query must not contain, and scan pruning."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from shopstream.plans import catalog

# Queries that run a stream or write a table when called (their plans are
# covered by the streaming tests and PLANS.md).
EAGER = {"src_topic_replay", "dau_dedup_stream", "order_wide_stream", "batch_progress",
         "dau_daily_partition", "upsert_latest", "append_docs", "cdc_split_stream",
         "order_wide_ttl_stream", "search_ranked", "search_indexed_ranked", "cdc_to_wide", "dim_snapshot"}
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
             "BroadcastNestedLoopJoin"]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - EAGER))
def test_no_python_udf_cross_join_or_nested_loop(spark, sf_small, name):
    plan = _plan(E.queries()[name](spark, sf_small))
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"


def test_scans_read_only_needed_columns(spark, sf_small):
    plan = _plan(E.queries()["dau_total"](spark, sf_small))
    events = [ln for ln in plan.splitlines() if "ReadSchema" in ln]
    assert events and all("props" not in ln and "value:" not in ln for ln in events)
    plan = _plan(E.queries()["search_match_all"](spark, sf_small))
    part = [ln for ln in plan.splitlines() if "ReadSchema" in ln and "p_name" in ln]
    assert part and all("p_type" not in ln and "p_brand" not in ln for ln in part)


def test_a_message_is_parsed_once(spark):
    from shopstream.operators import cdc as C
    from shopstream.operators import orders as O

    topic = spark.range(1).selectExpr("cast(id as string) as value", "current_timestamp() as timestamp")
    for df in (O.parse_order_info(topic), O.parse_order_detail(topic), C.parse_envelopes(topic),
               topic.where(O.is_bad_order()), topic.where(O.is_bad_detail()), topic.where(C.is_bad_envelope())):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1, plan


def test_the_audit_parses_both_topics_once(spark, sf_small):
    plan = _plan(E.queries()["orphans_interval"](spark, sf_small))
    assert "from_json" not in plan and "lineitem" not in plan
