"""Replays, change-data and wide streams at size: copies, shuffles and state that
stay on the disk, batches of bounded rows, messages parsed once."""

import json
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from shopstream.operators import cdc as C
from shopstream.plans import catalog
from shopstream.session import scratch_path
from shopstream.sources import sinks as K
from shopstream.sources.tables import tables
from shopstream.sources.topics import read_topic, write_replay
from shopstream.streaming import jobs as J
from tests.test_streaming import START, TOPIC, _append, _line, _order, _provinces, _users


def _names(spark, path):
    return [r.f for r in spark.read.parquet(path).selectExpr("input_file_name() as f").distinct().collect()]


def _shuffles(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(k).getName() for k in range(files.size())) if n.startswith("shuffle_")}


# --------------------------------------------------------------- F5, replays
def test_a_replay_leaves_neither_copies_nor_shuffles(spark):
    stage, path = scratch_path(spark, "t-stage"), scratch_path(spark, "t-replay")
    rows = spark.range(0, 20_000, 1, 4).selectExpr("repeat('x', 50) as value", "timestamp_seconds(id) as timestamp")
    rows.write.parquet(stage)
    before = _shuffles(spark)
    layout = write_replay(spark.read.parquet(stage), path, 3, rows_per_file=2_000, drop=stage)
    assert not K.path_exists(spark, stage)
    assert not any(K.path_exists(spark, f"{path}.staged/slice={k}") for k in range(3))
    for _ in range(100):        # files go a little later
        left = {n for n in _shuffles(spark) - before if n.endswith(".data")}
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert layout.files_per_slice > 1 and spark.read.json(path).count() == 20_000


def test_the_change_log_is_the_same_in_passes(spark, sf_small, monkeypatch):
    v = tables(spark, sf_small).views
    monkeypatch.setattr(catalog, "LINES_A_PASS", 1_000)
    assert catalog._pass_count(v) == catalog.PASSES
    stage = catalog._stage_cdc(spark, v, lambda log: log)

    def plain(df):
        rows = []
        for r in df.collect():
            e = json.loads(r.value)
            e["data"] = sorted(json.dumps(x, sort_keys=True) for x in e["data"])
            rows.append((r.seq, r.timestamp, json.dumps(e, sort_keys=True)))
        return sorted(rows)

    assert plain(spark.read.parquet(stage)) == plain(v.cdc_log)


def test_the_split_keeps_bad_texts_and_packs_facts(spark):
    src, dims, facts, ck = (scratch_path(spark, f"t-bad-{k}") for k in ("src", "dims", "facts", "ck"))
    good = json.dumps({"table": "order_info", "type": "INSERT", "data": [{"id": "9"}], "pkNames": ["id"]})
    texts = [good, good[:-9], json.dumps({"type": "INSERT", "data": [{"id": "1"}]}), "", None]
    _append(spark, src, [(t, START) for t in texts])
    J.run_cdc_split(spark, read_topic(spark, replay_path=src), dims, facts, ck)
    assert [json.loads(r.value) for r in spark.read.parquet(facts).collect()] == [{"id": "9"}]
    bad = spark.read.parquet(f"{facts}.bad")
    assert sorted(map(str, [r.value for r in bad.collect()])) == sorted(map(str, texts[1:]))
    assert {"value", "timestamp", "partition", "offset", "run", "batch_id"} == set(bad.columns)
    assert all(f.endswith(".zstd.parquet") for f in _names(spark, facts))
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    checked = C.checked_envelopes(df)
    assert C.good_envelopes(checked).collect() == C.parse_envelopes(df).collect()


# ------------------------------------------------------ F2, the interval form
def test_the_wide_stream_keeps_two_batches_to_go_back_to(spark):
    o_src, l_src, out, ck = (scratch_path(spark, f"t-keep-{k}") for k in ("o", "l", "out", "ck"))
    for k in range(1, 7):
        _append(spark, o_src, [_order(k, k)])
        _append(spark, l_src, [_line(10 * k, k, k + 5)])
    J.run_order_wide(spark, read_topic(spark, replay_path=o_src), read_topic(spark, replay_path=l_src),
                     lambda: (_users(spark), _provinces(spark)), out, ck, state_partitions=2)
    assert {r.detail_id for r in J.read_wide(spark, out).collect()} == {10 * k for k in range(1, 7)}
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{ck}/offsets")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    for _ in range(100):        # logs are purged a little later
        kept = [f.getPath().getName() for f in fs.listStatus(p) if not f.getPath().getName().startswith(".")]
        if len(kept) <= 4:
            break
        time.sleep(0.1)
    assert len(kept) <= 4


@pytest.mark.parametrize("few", [10_000, 2])
def test_few_repeats_read_alike(spark, monkeypatch, few):
    monkeypatch.setattr(K, "FEW", few)
    table = scratch_path(spark, "t-few")
    for b, ids in enumerate(([1, 2, 3, None], [3, 4, None], [2, 5, 3])):
        rows = spark.createDataFrame([(i, b, f"{i}-{b}") for i in ids], "id long, at long, value string")
        K.upsert_batch(rows, table, b, "id", "at")
    want = sorted(map(str, K.read_latest(spark, table, "id").collect()))
    got = K.read_latest(spark, table, "id", few_repeats=True)
    assert sorted(map(str, got.collect())) == want and len(want) == 6


def test_an_upsert_moves_a_row_once(spark):
    table = scratch_path(spark, "t-once")
    rows = spark.createDataFrame([(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d")], "id long, at long, value string")
    K.upsert_batch(rows, table, 0, "id", "at")
    assert sorted((r.id, r["at"], r.value) for r in spark.read.parquet(table).collect() if r["at"]) == [(1, 7, "c")]
    assert spark.read.parquet(table).count() == 2
    assert all(f.endswith(".zstd.parquet") for f in _names(spark, table))


# ----------------------------------------------------------- F3, the chain
def test_facts_are_cut_by_batches_and_rows_within_one_are_not_late(spark):
    """Two split batches of several days each, in many files: a batch of the
    wide stream may end inside one, and no line or order is late for that."""
    facts = scratch_path(spark, "t-facts")
    day = 86_400
    rows = [("DWD_ORDER_INFO_I", *_order(k, k * day)) for k in range(8)]
    rows += [("DWD_ORDER_DETAIL_I", *_line(10 * k, k, k * day + 5)) for k in range(8)]
    for batch, part in enumerate(([r for r in rows if r[2] < START + timedelta(days=4)],
                                  [r for r in rows if r[2] >= START + timedelta(days=4)])):
        part.reverse()          # the newest first
        df = spark.createDataFrame(part, f"topic string, {TOPIC}").withColumns(
            {"seq": F.lit(0).cast("long"), "run": F.lit(1).cast("long"), "batch_id": F.lit(batch).cast("long")})
        for k in range(len(part)):
            df.where((F.col("topic") == part[k][0]) & (F.col("timestamp") == part[k][2])).coalesce(1).write.mode("append") \
                .option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch_id").parquet(facts)
    topics = ["DWD_ORDER_INFO_I", "DWD_ORDER_DETAIL_I"]
    cut = J.facts_cut(spark, facts, topics, batches=1)
    assert cut.files == 8 and 3 * day + 5 <= cut.span_seconds <= 3 * day + 7
    assert J.facts_cut(spark, facts, topics).files == 32
    out = scratch_path(spark, "t-chain")
    J.run_order_wide_ttl(spark, *[J.stream_facts(spark, facts, t, 3) for t in topics], lambda: (_users(spark), _provinces(spark)),
                         out, scratch_path(spark, "t-chain-ck"), delay_seconds=max(day, cut.span_seconds), state_partitions=2)
    assert {r.detail_id for r in J.read_wide(spark, out).collect()} == {10 * k for k in range(8)}
    assert not K.path_exists(spark, f"{out}.late")


# -------------------------------------------------------- F4, the exact form
def test_slices_hold_the_rows_asked_for(spark):
    rows = spark.range(0, 40_000, 1, 4).selectExpr("'x' as value", "timestamp_seconds(id) as timestamp")
    cores = spark.sparkContext.defaultParallelism
    slices = [len(write_replay(rows, scratch_path(spark, "t-rows"), rows_per_core=n // cores).bounds) + 1 for n in (4_000, 8_000)]
    assert slices == [10, 5]


def test_the_exact_stream_lists_bad_messages(spark):
    o_src, l_src, out, ck = (scratch_path(spark, f"t-badw-{k}") for k in ("o", "l", "out", "ck"))
    _append(spark, o_src, [_order(1, 1), ("{broken", START), (json.dumps({"id": "x"}), START)])
    _append(spark, l_src, [_line(10, 1, 5), (json.dumps({"id": "3"}), START), (None, START)])
    J.run_order_wide_ttl(spark, read_topic(spark, replay_path=o_src), read_topic(spark, replay_path=l_src),
                         lambda: (_users(spark), _provinces(spark)), out, ck, state_partitions=2)
    assert [r.detail_id for r in J.read_wide(spark, out).collect()] == [10]
    bad = sorted((r.kind, str(r.value)) for r in spark.read.parquet(f"{out}.bad").collect())
    assert bad == [("line", "None"), ("line", '{"id": "3"}'), ("order", '{"id": "x"}'), ("order", "{broken")]
