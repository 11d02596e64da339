
import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from shopstream.functions.numeric import percent_one_decimal
from shopstream.operators import cdc as C
from shopstream.operators import dau as D
from shopstream.operators import orders as O
from shopstream.operators import sales as SL
from shopstream.operators import search as S
from shopstream.operators.beans import select_scalar_columns


def _topic(spark, msgs):
    return spark.createDataFrame([(json.dumps(m) if isinstance(m, dict) else m,) for m in msgs],
                                 "value string")


def _ms(s):
    return int(datetime.fromisoformat(s).replace(tzinfo=timezone.utc).timestamp() * 1000)


# --- logs -------------------------------------------------------------------
def test_first_visit_branches_and_quarantine(spark):
    common = {"mid": "m1", "uid": "1", "ar": "a", "ch": "web", "vc": "v1"}
    msgs = [
        {"event_id": 1, "common": common, "page": {"page_id": "p"}, "ts": _ms("2024-01-01 00:00:01")},
        {"event_id": 2, "common": common, "page": {"page_id": "p", "last_page_id": ""},
         "ts": _ms("2024-01-01 00:00:02")},
        {"event_id": 3, "common": common, "page": {"page_id": "p", "last_page_id": "home"},
         "ts": _ms("2024-01-01 00:00:03")},
        {"event_id": 4, "common": common, "ts": _ms("2024-01-01 00:00:04")},  # no page
        '{"event_id": 5, "common": {"mid": "m',                                # cut short
        "",                                                                    # empty
    ]
    t = _topic(spark, msgs)
    fv = D.first_visits(D.parse_app_log(t)).select("event_id").collect()
    assert sorted(r.event_id for r in fv) == [1, 2]
    q = D.quarantine_counts(t).collect()[0]
    assert (q.n_ok, q.n_bad) == (4, 2)


def test_day_and_hour_follow_the_zone_argument(spark):
    # H2: 2024-01-01 20:30 UTC is the next day 04:30 in UTC+8
    t = _topic(spark, [{"event_id": 1, "common": {"mid": "m"}, "page": {},
                        "ts": _ms("2024-01-01 20:30:00")}])
    utc = D.parse_app_log(t, "UTC").select("dt", "hr").collect()[0]
    sh = D.parse_app_log(t, "Asia/Shanghai").select("dt", "hr").collect()[0]
    assert (utc.dt, utc.hr) == ("2024-01-01", "20")
    assert (sh.dt, sh.hr) == ("2024-01-02", "04")


def test_dedup_keeps_first_by_time_then_id_per_day(spark):
    rows = [("2024-01-01", "m1", 5, 10, "01"), ("2024-01-01", "m1", 5, 9, "02"),
            ("2024-01-01", "m1", 7, 1, "03"), ("2024-01-02", "m1", 1, 2, "00")]
    df = spark.createDataFrame(rows, "dt string, mid string, ts long, event_id long, hr string") \
        .select("*", F.lit("u").alias("uid"), F.lit("a").alias("ar"), F.lit("c").alias("ch"),
                F.lit("v").alias("vc"), F.timestamp_millis("ts").alias("event_time"))
    out = {(r.dt, r.event_id) for r in D.dedup_first_visits(df).collect()}
    assert out == {("2024-01-01", 9), ("2024-01-02", 2)}


def test_hour_compare_zero_fills_and_uses_previous_day(spark):
    df = spark.createDataFrame([("2024-01-02", "m1", "05"), ("2024-01-01", "m2", "05"),
                                ("2024-01-01", "m3", "07")], "dt string, mid string, hr string")
    r = D.dau_hour_compare(df, "2024-01-02").orderBy("hr").collect()
    assert len(r) == 24
    assert (r[5].today, r[5].yesterday) == (1, 1)
    assert (r[7].today, r[7].yesterday) == (0, 1)
    assert sum(x.today for x in r) == 1


# --- change data ------------------------------------------------------------
def _env(table, typ, rows, seq):
    return (seq, json.dumps({"table": table, "type": typ, "data": rows, "pkNames": ["id"]}))


def test_cdc_routing_and_dimension_upserts(spark):
    cdc = spark.createDataFrame([
        _env("order_info", "INSERT", [{"id": "1"}, {"id": "2"}], 1),
        _env("order_info", "insert", [{"id": "3"}], 2),          # wrong case: dropped (P10)
        _env("order_info", "CREATE", [{"id": "4"}], 3),          # other type: dropped
        _env("order_detail", "DELETE", [{"id": "5"}], 4),
        _env("user_info", "INSERT", [{"id": "7", "name": "a"}], 5),
        _env("user_info", "UPDATE", [{"id": "7", "name": "b"}], 6),
        _env("user_info", "DELETE", [{"id": "7", "name": "b"}], 7),  # H8: kept as upsert
        _env("user_info", "INSERT", [{"id": "8", "name": "c"}], 8),
    ], "seq long, value string")
    env = C.parse_envelopes(cdc)
    topics = {(r.topic, json.loads(r.value)["id"]) for r in C.route_facts(env).collect()}
    assert topics == {("DWD_ORDER_INFO_I", "1"), ("DWD_ORDER_INFO_I", "2"),
                      ("DWD_ORDER_DETAIL_D", "5")}
    latest = {r.key: r.row["name"] for r in C.dim_latest(env).collect()}
    assert latest == {"DIM:USER_INFO:7": "b", "DIM:USER_INFO:8": "c"}
    kept = {r.key for r in C.dim_latest(env, apply_deletes=True).collect()}
    assert kept == {"DIM:USER_INFO:8"}


def test_snapshot_envelopes_are_bounded(spark):
    df = spark.range(0, 1234).select(F.col("id"), F.col("id").cast("string").alias("name"))
    e = C.snapshot_to_envelopes(df, "t", "id", 500).collect()
    assert sorted(r.n_rows for r in e) == [234, 500, 500]
    assert all(json.loads(r.value)["type"] == "INSERT" for r in e)


# --- orders -----------------------------------------------------------------
def test_string_valued_messages_parse_with_defaults(spark):
    # Numbers arrive as text; bad numbers fall back to the default
    t = spark.createDataFrame([(json.dumps({"id": "12", "total_amount": "12.5", "user_id": "x",
                                            "create_time": "2024-03-04 05:06:07"}),
                                datetime(2024, 3, 4, 5, 6, 7))], "value string, timestamp timestamp")
    r = O.parse_order_info(t).collect()[0]
    assert (r.id, r.total_amount, r.user_id, r.feight_fee) == (12, 12.5, 0, 0.0)
    assert (r.create_date, r.create_hour) == ("2024-03-04", "05")


def _orders(spark, rows):
    return spark.createDataFrame(rows, "id long, user_id long, province_id long, "
                                       "create_time string, arr timestamp")


def test_age_gender_province_lookups(spark):
    orders = _orders(spark, [(1, 10, 1, "2020-02-28 23:00:00", None),
                             (2, 11, 1, "2020-01-01 00:00:00", None),
                             (3, 99, 9, "2020-01-01 00:00:00", None)])
    users = spark.createDataFrame([(10, "2000-02-29", "F"), (11, "2020-06-01", "")],
                                  "id long, birthday string, gender string")
    prov = spark.createDataFrame([(1, "P1", "11", "ISO-1", "CN-1")],
                                 "id int, name string, area_code string, iso_code string, iso_3166_2 string")
    r = {x.id: x for x in O.enrich_orders(orders, users, prov).collect()}
    # H6: 7304 days / 365 = 20.01 -> 20; negative gap under a year -> 0
    assert (r[1].user_age, r[1].user_gender, r[1].province_name) == (20, "F", "P1")
    assert (r[2].user_age, r[2].user_gender) == (0, None)       # F4: empty gender -> null
    assert (r[3].user_age, r[3].province_name) == (0, None)     # H3: unknown user -> 0


def test_wide_row_takes_line_create_time(spark):
    # H7
    o = spark.createDataFrame([(1, "2024-01-01 10:00:00", "2024-01-01", "10")],
                              "id long, create_time string, create_date string, create_hour string")
    for c in ["province_id", "user_id"]:
        o = o.withColumn(c, F.lit(0).cast("long"))
    for c in ["order_status", "expire_time", "refundable_time", "operate_time", "province_name",
              "province_area_code", "province_3166_2_code", "province_iso_code", "user_gender"]:
        o = o.withColumn(c, F.lit(None).cast("string"))
    for c in ["total_amount", "activity_reduce_amount", "coupon_reduce_amount",
              "original_total_amount", "feight_fee", "feight_fee_reduce"]:
        o = o.withColumn(c, F.lit(0.0))
    o = o.withColumn("user_age", F.lit(0))
    d = spark.createDataFrame([(7, 1, 3, 1.0, 2, "red widget", "2024-01-01 10:01:00", 2.0, 0.0, 0.0)],
                              "id long, order_id long, sku_id long, order_price double, sku_num long, "
                              "sku_name string, create_time string, split_total_amount double, "
                              "split_activity_amount double, split_coupon_amount double")
    w = O.merge_wide(O.inner_join(o, d)).collect()[0]
    assert (w.detail_id, w.order_id, w.create_time, w.create_hour) == \
        (7, 1, "2024-01-01 10:01:00", "10")


def test_full_outer_join_sides(spark):
    o = spark.createDataFrame([(1,), (2,)], "id long")
    d = spark.createDataFrame([(10, 1), (11, 1), (30, 3)], "id long, order_id long")
    r = {(x.order_id, x.detail_id, x.side) for x in O.full_outer_join(o, d).collect()}
    assert r == {(1, 10, "both"), (1, 11, "both"), (2, None, "order_only"),
                 (3, 30, "detail_only")}


def test_ttl_refresh_chain_vs_interval(spark):
    # Order arrives at t=2000 s.  Lines at 100 (gap 700 to the next: dropped),
    # 800, 1300, 1850 (chain of gaps < 600 up to the order: kept), 2599
    # (after, < 600: kept), 2600 (after, = 600: dropped).
    base = datetime(2024, 1, 1)
    ts = lambda s: datetime.fromtimestamp(base.replace(tzinfo=timezone.utc).timestamp() + s,
                                          tz=timezone.utc).replace(tzinfo=None)
    o = spark.createDataFrame([(1, ts(2000))], "id long, arr timestamp")
    d = spark.createDataFrame([(i, 1, ts(t)) for i, t in
                               enumerate([100, 800, 1300, 1850, 2599, 2600])],
                              "id long, order_id long, arr timestamp")
    ttl = {r.detail_id for r in O.ttl_refresh_join(o, d, 600).collect()}
    assert ttl == {1, 2, 3, 4}
    itv = {r.id for r in O.interval_join(o, d, 600).collect()}
    assert itv == {3, 4}  # H21: the interval form misses the refreshed chain


# --- sales and search -------------------------------------------------------
def test_half_up_percent(spark):
    r = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 0), (1, 1600)], "a long, b long") \
        .select(percent_one_decimal("a", "b").alias("p")).collect()
    assert [x.p for x in r] == [12.5, 33.3, 66.7, 0.0, 0.1]


def test_shares_with_missing_gender_and_unknown_age(spark):
    # H3, H4, H5: no 'M' bucket -> 0.0; null gender counts in the total only
    m = spark.createDataFrame([(0, "F"), (25, "F"), (40, None), (41, None)],
                              "user_age int, user_gender string")
    g = {r.name: r.value for r in SL.gender_share(m).collect()}
    assert g == {"male": 0.0, "female": 50.0}
    a = {r.name: r.value for r in SL.age_share(m).collect()}
    assert a == {"under 20": 25.0, "20 to 29": 25.0, "30 and over": 50.0}


def test_match_all_any_and_empty_keyword(spark):
    df = spark.createDataFrame([(1, "Red Widget"), (2, "red-bolt"), (3, "blue gear")],
                               "id long, name string")
    assert {r.id for r in S.match_all(df, "name", "widget red").collect()} == {1}
    assert {r.id for r in S.match_any(df, "name", "red").collect()} == {1, 2}
    assert S.match_all(df, "name", "").count() == 0           # dashboard default
    h = S.highlight(df, "name", "red").orderBy("id").collect()
    assert h[0].highlight == "<em>Red</em> Widget" and h[2].highlight == "blue gear"


def test_page_numbers(spark):
    df = spark.range(1, 26).select(F.col("id").alias("detail_id"))
    p = S.page(df, 3, 10, [F.col("detail_id")]).collect()
    assert [r.detail_id for r in p] == [21, 22, 23, 24, 25]


def test_scalar_columns_only(spark):
    df = spark.sql("select 1L as id, 'x' as name, date'1970-01-02' as d, "
                   "named_struct('a', 1) as s, array(1) as arr")
    r = select_scalar_columns(df)
    assert r.columns == ["id", "name", "d"]
    assert r.collect()[0].d == 86_400_000


def test_wall_clock_conversions_ignore_the_session_zone(spark):
    # 1995-04-02 02:46:40 does not exist in Los Angeles (clocks jump 2 -> 3);
    # read as UTC it must keep its own epoch whatever the session zone.
    from shopstream.functions.timefn import ntz_to_epoch_ms
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = spark.sql("select timestamp_ntz'1995-04-02 02:46:40' as a, "
                      "timestamp_ntz'1995-04-02 03:46:40' as b") \
            .select(ntz_to_epoch_ms("a").alias("a"), ntz_to_epoch_ms("b").alias("b")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    utc = lambda *a: int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1000)
    assert (r.a, r.b) == (utc(1995, 4, 2, 2, 46, 40), utc(1995, 4, 2, 3, 46, 40))
