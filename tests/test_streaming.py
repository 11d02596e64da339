"""Stream = batch, restart from checkpoint, and late data under a watermark."""

import json
import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from shopstream.operators import dau as D
from shopstream.session import scratch_path
from shopstream.sources import sinks as K
from shopstream.sources.tables import tables
from shopstream.sources.topics import read_topic, write_replay
from shopstream.streaming import jobs as J
from tests.test_properties import TTL, simulate


def _batch_dau(spark, sf):
    v = tables(spark, sf).views
    return {(r.dt, r.mid) for r in
            D.dedup_first_visits(D.first_visits(D.parse_app_log(v.app_log_topic))).collect()}


@pytest.mark.parametrize("n_slices", [1, 3])
def test_dau_stream_equals_batch_for_any_split(spark, sf_small, n_slices):
    v = tables(spark, sf_small).views
    src = scratch_path(spark, "t-replay")
    write_replay(v.app_log_topic, src, n_slices)
    out, ck = scratch_path(spark, "t-dau"), scratch_path(spark, "t-ck")
    J.run_dau(spark, read_topic(spark, replay_path=src), out, ck, timeout_s=300)
    got = {(r.dt, r.mid) for r in spark.read.parquet(out).collect()}
    assert got == _batch_dau(spark, sf_small)


def test_dau_stream_resumes_from_checkpoint(spark, sf_small):
    v = tables(spark, sf_small).views
    topic = v.app_log_topic
    cut = topic.select(F.percentile_approx(F.unix_micros("timestamp"), 0.5)).first()[0]
    src = scratch_path(spark, "t-replay")
    out, ck = scratch_path(spark, "t-dau"), scratch_path(spark, "t-ck")
    write_replay(topic.where(F.unix_micros("timestamp") < cut), src, 2)
    J.run_dau(spark, read_topic(spark, replay_path=src), out, ck, timeout_s=300)
    first = spark.read.parquet(out).count()
    write_replay(topic.where(F.unix_micros("timestamp") >= cut), src, 2)
    J.run_dau(spark, read_topic(spark, replay_path=src), out, ck, timeout_s=300)
    rows = spark.read.parquet(out).select("dt", "mid").collect()
    assert 0 < first < len(rows)
    assert len(rows) == len(set(rows))               # nothing emitted twice
    assert set(rows) == _batch_dau(spark, sf_small)


def _msg(eid, mid, ts):
    ms = int(datetime.fromisoformat(ts).replace(tzinfo=timezone.utc).timestamp() * 1000)
    return json.dumps({"event_id": eid, "common": {"mid": mid}, "page": {"page_id": "p"},
                       "ts": ms}), datetime.fromtimestamp(ms / 1000, timezone.utc)


def test_late_record_is_dropped_by_the_watermark(spark):
    src = scratch_path(spark, "t-late")
    out, ck = scratch_path(spark, "t-late-out"), scratch_path(spark, "t-late-ck")
    first = [_msg(1, "a", "2024-01-10 00:00:00"), _msg(2, "b", "2024-01-10 01:00:00")]
    spark.createDataFrame(first, "value string, timestamp timestamp").coalesce(1) \
        .write.mode("append").json(src)
    J.run_dau(spark, read_topic(spark, replay_path=src), out, ck, timeout_s=300)
    late = [_msg(3, "c", "2024-01-01 00:00:00"), _msg(4, "d", "2024-01-10 02:00:00")]
    spark.createDataFrame(late, "value string, timestamp timestamp").coalesce(1) \
        .write.mode("append").json(src)
    listener = J.LateRows()
    spark.streams.addListener(listener)
    try:
        q = J.run_dau(spark, read_topic(spark, replay_path=src), out, ck, timeout_s=300)
        mids = {r.mid for r in spark.read.parquet(out).collect()}
        assert mids == {"a", "b", "d"}
        for _ in range(100):            # progress events come a little later
            if listener.dropped.get(str(q.id)):
                break
            time.sleep(0.1)
        assert listener.dropped[str(q.id)] == 1
    finally:
        spark.streams.removeListener(listener)


def test_dau_stream_with_several_files_per_slice(spark, sf_small):
    v = tables(spark, sf_small).views
    src = scratch_path(spark, "t-replay-multi")
    layout = write_replay(v.app_log_topic, src, 3, rows_per_file=100)
    assert layout.files_per_slice > 1
    out, ck = scratch_path(spark, "t-dau-m"), scratch_path(spark, "t-ck-m")
    J.run_dau(spark, read_topic(spark, replay_path=src,
                                max_files_per_trigger=layout.files_per_slice),
              out, ck, timeout_s=300)
    got = {(r.dt, r.mid) for r in spark.read.parquet(out).collect()}
    assert got == _batch_dau(spark, sf_small)


# ------------------------------------------------------------ the wide stream
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
TOPIC = "value string, timestamp timestamp"


def _order(oid, at, user=1, **more):
    return json.dumps({"id": str(oid), "user_id": str(user), "province_id": "1",
                       "create_time": "2024-01-01 00:00:00", **more}), START + timedelta(seconds=at)


def _line(lid, oid, at):
    return json.dumps({"id": str(lid), "order_id": str(oid), "sku_name": "x",
                       "create_time": "2024-01-01 00:00:00"}), START + timedelta(seconds=at)


def _users(spark, name="u", birthday="1990-01-01"):
    return spark.createDataFrame([(1, name, birthday, "F")], "id long, name string, birthday string, gender string")


def _provinces(spark):
    return spark.createDataFrame([(1, "p", "1", "i", "c")],
                                 "id long, name string, area_code string, iso_code string, iso_3166_2 string")


def _append(spark, path, records):
    spark.createDataFrame(records, TOPIC).coalesce(1).write.mode("append").json(path)


@pytest.mark.parametrize("seed", range(4))
def test_wide_stream_is_exact_for_any_arrival_order(spark, seed):
    """Random splits of the same events over micro-batches, repeats among them."""
    rng = random.Random(seed)
    orders = {o: rng.randint(0, 4000) for o in range(6)}
    lines = [(i, rng.randrange(6), rng.randint(0, 5000)) for i in range(60)]
    lines += [(i, o, rng.randint(0, 5000)) for i, o, _ in rng.sample(lines, 8)]     # delivered again
    events = [("o", _order(o, t)) for o, t in orders.items()] + [("l", _line(*x)) for x in lines]
    rng.shuffle(events)
    o_src, l_src, out, ck = (scratch_path(spark, f"t-wide-{k}") for k in ("o", "l", "out", "ck"))
    n = 3
    for part in (events[k::n] for k in range(n)):
        _append(spark, o_src, [e for k, e in part if k == "o"])
        _append(spark, l_src, [e for k, e in part if k == "l"])
        # the query is stopped and started again for every part
        J.run_order_wide_ttl(spark, read_topic(spark, replay_path=o_src), read_topic(spark, replay_path=l_src),
                             lambda: (_users(spark), _provinces(spark)), out, ck, TTL)
    got = [r.detail_id for r in J.read_wide(spark, out).collect()]
    assert len(got) == len(set(got))
    assert set(got) == simulate(orders, lines)


def _runs_long(spark, parts, slot_seconds, delay_seconds):
    o_src, l_src, out, ck = (scratch_path(spark, f"t-long-{k}") for k in ("o", "l", "out", "ck"))
    for part in parts:
        _append(spark, o_src, [e for k, e in part if k == "o"])
        _append(spark, l_src, [e for k, e in part if k == "l"])
        J.run_order_wide_ttl(spark, read_topic(spark, replay_path=o_src), read_topic(spark, replay_path=l_src),
                             lambda: (_users(spark), _provinces(spark)), out, ck, TTL,
                             slot_seconds=slot_seconds, delay_seconds=delay_seconds)
    return out


@pytest.mark.parametrize("delay", [0, 3600])
def test_lines_kept_alive_for_three_days(spark, delay):
    """A line every nine minutes for three days, then the order; another
    order's lines fall silent once, and those before are lost."""
    day = 86_400
    kept = [(i, 1, t) for i, t in enumerate(range(0, 3 * day, 540))]
    lost = [(10_000 + i, 2, t) for i, t in enumerate(range(0, 3 * day, 540)) if t not in (540 * 200, 540 * 201)]
    orders = {1: 3 * day + 10, 2: 3 * day + 10, 3: 50}
    lines = kept + lost + [(20_000, 3, 649), (20_001, 3, 651)]
    events = [(t, "o", _order(o, t)) for o, t in orders.items()] + [(x[2], "l", _line(*x)) for x in lines]
    events = [(k, e) for _, k, e in sorted(events, key=lambda e: (e[0], e[1], e[2][0]))]
    cut = [0, len(events) // 3, len(events) - 5, len(events) - 1, len(events)]
    out = _runs_long(spark, [events[a:b] for a, b in zip(cut, cut[1:])], 3600, delay)
    got = {r.detail_id for r in J.read_wide(spark, out).collect()}
    assert got == simulate(orders, lines) and {i for i, *_ in kept} <= got and 10_000 not in got
    # what is kept between batches is a row per run, in two versions
    assert spark.read.parquet(f"{out}.runs").where("order_id is not null").count() <= 6


@pytest.mark.parametrize("seed", range(2))
def test_wide_stream_in_slots_of_any_width(spark, seed):
    rng = random.Random(100 + seed)
    orders = {o: rng.randint(0, 9000) for o in range(4)}
    lines = [(i, rng.randrange(4), rng.randint(0, 9000)) for i in range(70)]
    events = [("o", _order(o, t)) for o, t in orders.items()] + [("l", _line(*x)) for x in lines]
    rng.shuffle(events)
    out = _runs_long(spark, [events[k::3] for k in range(3)], 100, 86_400)
    assert {r.detail_id for r in J.read_wide(spark, out).collect()} == simulate(orders, lines)


def test_late_rows_are_listed(spark):
    parts = [[("l", _line(1, 1, 5000))], [("o", _order(1, 100)), ("l", _line(2, 1, 4500))]]
    out = _runs_long(spark, parts, 3600, 600)
    assert spark.read.parquet(f"{out}.late").count() == 1


# ------------------------------------------------- daily actives that expire
def _expiring(records):
    """dt -> device sets that expire a day after their last touch."""
    last, sets, out = {}, {}, []
    for at, eid, dt, mid in sorted(records):
        if dt not in last or at - last[dt] >= 86_400:
            sets[dt] = set()
        last[dt] = at
        if mid not in sets[dt]:
            sets[dt].add(mid)
            out.append((dt, mid, eid))
    return sorted(out)


@pytest.mark.parametrize("seed", range(2))
def test_expiring_actives_for_any_split(spark, seed):
    rng = random.Random(seed)
    base = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(rng.randint(0, 12 * 86_400), i, rng.randint(0, 3), f"m{rng.randint(0, 5)}") for i in range(70)]
    rows += [(86_400, 900, 1, "edge"), (2 * 86_400, 901, 1, "edge"), (2 * 86_400 + 5, 901, 1, "edge")]
    text = lambda eid, day, mid: json.dumps({"event_id": eid, "common": {"mid": mid}, "page": {"page_id": "p"},
                                             "ts": int((base + timedelta(days=day)).timestamp() * 1000)})
    records = [(text(eid, day, mid), base + timedelta(seconds=at)) for at, eid, day, mid in rows]
    want = _expiring([(at, eid, f"2024-01-0{day + 1}", mid) for at, eid, day, mid in rows])
    rng.shuffle(records)
    src, out, ck = (scratch_path(spark, f"t-expiring-{k}") for k in ("src", "out", "ck"))
    for part in (records[:20], records[20:], records[:5]):      # some are delivered again
        _append(spark, src, part)
        J.run_dau_expiring(spark, read_topic(spark, replay_path=src), out, ck)
    got = sorted((r.dt, r.mid, r.event_id) for r in J.read_dau_expiring(spark, out).collect())
    assert got == want
    batch = D.parse_app_log(spark.createDataFrame(records, TOPIC), arr_col="timestamp")
    rows = D.expiring_first_visits(D.touch_buckets(D.first_visits(batch))).collect()
    assert sorted((r.dt, r.mid, r.event_id) for r in rows) == want


# ------------------------------------------------------------------- orphans
def test_orphans_come_out_once_and_over_a_restart(spark):
    o_src, l_src, out, ck = (scratch_path(spark, f"t-orphan-{k}") for k in ("o", "l", "out", "ck"))
    run = lambda: J.run_orphans(spark, read_topic(spark, replay_path=o_src), read_topic(spark, replay_path=l_src), out, ck, TTL)
    got = lambda: sorted((r.kind, r.id) for r in spark.read.parquet(out).collect())
    _append(spark, o_src, [_order(1, 0), _order(2, 0), _order(3, 1500)])
    _append(spark, l_src, [_line(10, 1, 599), _line(11, 1, 600), _line(12, 9, 3), _line(13, 3, 1500)])
    run()
    assert ("line", 10) not in got()
    _append(spark, o_src, [_order(4, 5000)])
    _append(spark, l_src, [_line(14, 4, 5001)])
    run()
    want = [("line", 11), ("line", 12), ("order", 2)]
    assert got() == want
    _append(spark, o_src, [_order(5, 90_000)])
    _append(spark, l_src, [_line(15, 6, 90_000)])
    run()
    assert got() == want        # each once; the last ones may still be met


def test_wide_stream_sees_a_changed_user_and_keeps_bad_messages(spark):
    o_src, l_src, out, ck = (scratch_path(spark, f"t-dim-{k}") for k in ("o", "l", "out", "ck"))
    users = [_users(spark, birthday="1990-01-01")]
    run = lambda: J.run_order_wide_ttl(
        spark, read_topic(spark, replay_path=o_src), read_topic(spark, replay_path=l_src),
        lambda: (users[0], _provinces(spark)), out, ck, TTL)
    _append(spark, o_src, [_order(1, 0), ('{"id": "7", "user', START), ("", START)])
    _append(spark, l_src, [_line(10, 1, 5), (json.dumps({"id": "x", "order_id": "1"}), START)])
    run()
    users[0] = _users(spark, birthday="1970-01-01")
    _append(spark, o_src, [_order(2, 20)])
    _append(spark, l_src, [_line(20, 2, 25)])
    run()
    rows = {r.detail_id: r for r in J.read_wide(spark, out).collect()}
    assert {k: (r.user_age, r.user_gender, r.province_name) for k, r in rows.items()} == {
        10: (34, "F", "p"), 20: (54, "F", "p")}
    assert spark.read.parquet(f"{out}.bad").count() == 3
    assert {r.create_date for r in spark.read.parquet(out).select("create_date").collect()} \
        == {datetime(2024, 1, 1).date()}


def _envelope(table, typ, rows, at):
    return json.dumps({"table": table, "type": typ, "data": rows, "pkNames": ["id"]}), START, 0, at


def test_cdc_split_orders_by_offset_restarts_and_starts_anew(spark):
    src, dims, facts = (scratch_path(spark, f"t-cdc-{k}") for k in ("src", "dims", "facts"))
    put = lambda rows, path=src: spark.createDataFrame(
        rows, "value string, timestamp timestamp, partition int, offset long").coalesce(1).write.mode("append").json(path)
    user = lambda name: [{"id": "1", "name": name}]
    # two changes of one row in the same millisecond: the offset decides
    put([_envelope("user_info", "UPDATE", user("b"), 2), _envelope("user_info", "INSERT", user("a"), 1),
         ("{broken", START, 0, 3), _envelope("order_info", "INSERT", [{"id": "5"}], 4)])
    ck = scratch_path(spark, "t-cdc-ck")
    name = lambda: [json.loads(r.value)["name"] for r in K.read_latest(spark, dims, "key").collect()]
    J.run_cdc_split(spark, read_topic(spark, replay_path=src), dims, facts, ck, compact_every=1)
    assert name() == ["b"]
    put([_envelope("user_info", "UPDATE", user("c"), 5)])
    J.run_cdc_split(spark, read_topic(spark, replay_path=src), dims, facts, ck, compact_every=1)
    assert name() == ["c"]
    assert spark.read.parquet(facts).count() == 1 and spark.read.parquet(f"{facts}.bad").count() == 1
    # a new checkpoint counts its batches from 0 again, and still wins
    again = scratch_path(spark, "t-cdc-src2")
    put([_envelope("user_info", "INSERT", user("d"), 1)], again)
    J.run_cdc_split(spark, read_topic(spark, replay_path=again), dims, facts, scratch_path(spark, "t-cdc-ck2"))
    assert name() == ["d"]


def test_a_batch_joins_its_rows_once(spark):
    o_src, l_src, out, ck = (scratch_path(spark, f"t-once-{k}") for k in ("o", "l", "out", "ck"))
    _append(spark, o_src, [_order(k, k) for k in range(1, 9)])
    _append(spark, l_src, [_line(10 * k, k, k + 5) for k in range(1, 9)])
    q = J.run_order_wide(spark, read_topic(spark, replay_path=o_src), read_topic(spark, replay_path=l_src),
                         lambda: (_users(spark), _provinces(spark)), out, ck, state_partitions=2)
    assert {r.detail_id for r in J.read_wide(spark, out).collect()} == {10 * k for k in range(1, 9)}
    # state takes each of the 16 rows once, however often the batch is used
    assert sum(op.numRowsUpdated for p in q.recentProgress for op in p.stateOperators) == 16


def test_replay_slices_grow_with_the_cluster_and_are_compressed(spark):
    from shopstream.sources import topics as TP
    rows = spark.range(0, 20_000, 1, 4).selectExpr("repeat('x', 50) as value", "timestamp_seconds(id) as timestamp")
    path = scratch_path(spark, "t-replay")
    layout = write_replay(rows, path, 3, rows_per_file=2_000)
    files = [r.f for r in spark.read.json(path).selectExpr("input_file_name() as f").distinct().collect()]
    assert len(files) == 3 * layout.files_per_slice and all(f.endswith(".json.gz") for f in files)
    assert spark.read.json(path).count() == 20_000
    # 0.1 GB of order lines on 12 cores
    assert TP.slice_count(3_600_000, TP.ROWS_PER_CORE * 12) == 4


def test_bases_come_at_doubling_sizes(spark):
    table = scratch_path(spark, "t-bases")
    for b in range(8):
        K.upsert_batch(spark.range(b * 10, b * 10 + 10).selectExpr("id", "id as at", "id as value"), table, b, "id", "at")
        K.compact_if_grown(spark, table, "id")
    bases = spark.read.parquet(f"{table}.bases").orderBy("batch_id").collect()
    assert [spark.read.parquet(r.path).count() for r in bases] == [10, 20, 40, 80]
    assert K.read_latest(spark, table, "id").count() == 80
