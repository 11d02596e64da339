"""Request-level API, fact topics sink, day tables and the streaming CDC split."""

import contextlib
import io
import json

from pyspark.sql import functions as F

from shopstream.operators import cdc as C
from shopstream.plans import api
from shopstream.session import scratch_path
from shopstream.sources import sinks as K
from shopstream.sources.topics import read_topic, write_replay
from shopstream.streaming import jobs as J


def _dau(spark):
    return spark.createDataFrame(
        [("2024-01-02", "a", "01"), ("2024-01-02", "b", "05"), ("2024-01-01", "a", "05")],
        "dt string, mid string, hr string")


def test_realtime_total_and_hour_dispatch(spark):
    t = {r.id: r.value for r in api.realtime_total(_dau(spark), "2024-01-02").collect()}
    assert t == {"dau": 2, "new_mid": 1}
    assert api.realtime_hour("order", _dau(spark), "2024-01-02") is None
    h = api.realtime_hour("dau", _dau(spark), "2024-01-02").orderBy("hr").collect()
    assert len(h) == 24 and (h[5].today, h[5].yesterday) == (1, 1)
    assert len(api.today()) == 10


def test_requests_for_a_day_without_rows(spark):
    for dau in (_dau(spark), _dau(spark).limit(0)):
        t = {r.id: r.value for r in api.realtime_total(dau, "2030-01-01").collect()}
        assert t == {"dau": 0, "new_mid": 0}
        h = api.realtime_hour("dau", dau, "2030-01-01").collect()
        assert [r.hr for r in h] == [f"{k:02d}" for k in range(24)] and not any(r.today + r.yesterday for r in h)


def test_hour_request_reads_two_days_only(spark):
    path = scratch_path(spark, "t-hour-days")
    K.write_daily(_dau(spark), path, 0)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        api.realtime_hour("dau", spark.read.parquet(path), "2024-01-02").explain()
    assert "PartitionFilters: [dt" in buf.getvalue().replace("cast(dt", "dt").replace("(dt", "dt") or "PartitionFilters: [cast(dt" in buf.getvalue()


def test_sale_detail_json(spark):
    wide = spark.createDataFrame(
        [(i, 1, "red widget" if i % 2 else "blue gear", 1, 1.0, 15 + i, "M" if i % 3 else "F",
          "P", "2024-01-02", "2024-01-02 10:00:00") for i in range(10)],
        "detail_id long, order_id long, sku_name string, sku_num long, order_price double, "
        "user_age int, user_gender string, province_name string, create_date string, "
        "create_time string")
    doc = json.loads(api.sale_detail(wide, "red", 1, 3, "2024-01-02").collect()[0].json)
    assert doc["total"] == 5 and len(doc["detail"]) == 3
    assert [s["title"] for s in doc["stat"]] == ["gender share", "age share"]
    assert sum(o["value"] for o in doc["stat"][1]["options"]) == 100.0


def test_fact_topics_and_day_tables(spark):
    facts = spark.createDataFrame([("DWD_A_I", '{"id":"1"}'), ("DWD_A_U", '{"id":"1"}'),
                                   ("DWD_A_I", '{"id":"2"}')], "topic string, value string")
    path = scratch_path(spark, "t-facts")
    K.write_fact_topics(facts, path)
    got = {(r.topic, r.n) for r in spark.read.json(path).groupBy("topic")
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("DWD_A_I", 2), ("DWD_A_U", 1)}
    keyed = scratch_path(spark, "t-facts-keyed")
    K.write_fact_topics(facts.withColumn("id", F.get_json_object("value", "$.id")), keyed,
                        key_col="id")
    assert sorted(r.key for r in spark.read.json(keyed).collect()) == ["1", "1", "2"]

    day_path = scratch_path(spark, "t-days")
    K.write_daily(_dau(spark), day_path, "2024-01-03")
    one = K.read_day(spark, day_path, "2024-01-02")
    assert one.count() == 2 and {str(r.load_id) for r in one.collect()} == {"2024-01-03"}
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        one.explain()
    assert "PartitionFilters: [isnotnull(dt" in buf.getvalue()   # partition pruning (S14)


def test_cdc_split_stream_routes_and_upserts(spark):
    env = lambda t, typ, rows: json.dumps({"table": t, "type": typ, "data": rows,
                                           "pkNames": ["id"]})
    recs = [(env("user_info", "INSERT", [{"id": "1", "name": "a"}]), 1),
            (env("order_info", "INSERT", [{"id": "9"}]), 2),
            (env("user_info", "UPDATE", [{"id": "1", "name": "b"}]), 3),
            (env("order_info", "UPDATE", [{"id": "9"}]), 4)]
    topic = spark.createDataFrame(recs, "value string, seq long") \
        .select("value", F.timestamp_micros("seq").alias("timestamp"))
    src = scratch_path(spark, "t-cdc")
    write_replay(topic, src, 2)
    dims, facts = scratch_path(spark, "t-dims"), scratch_path(spark, "t-facts2")
    J.run_cdc_split(spark, read_topic(spark, replay_path=src), dims, facts,
                    scratch_path(spark, "t-cdc-ck"), timeout_s=300)
    latest = {r.key: json.loads(r.value)["name"] for r in K.read_latest(spark, dims, "key").collect()}
    assert latest == {"DIM:USER_INFO:1": "b"}
    topics = sorted(r.topic for r in spark.read.parquet(facts).collect())
    assert topics == ["DWD_ORDER_INFO_I", "DWD_ORDER_INFO_U"]
    env_df = C.parse_envelopes(topic.select("value", F.unix_micros("timestamp").alias("seq")))
    assert C.dim_latest(env_df).count() == 1
