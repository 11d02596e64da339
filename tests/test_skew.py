"""A key holding a third of the rows: results stay exact and AQE splits the
skewed join partition instead of giving it to one task."""

import contextlib
import io
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shopstream.operators import dau as D
from shopstream.operators import orders as O

BASE = datetime(2024, 1, 1)


@contextlib.contextmanager
def _conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _skewed(spark, n=60_000):
    # order 0 holds a third of all lines; the rest spread over 10k orders
    lines = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 10_000 + 1).alias("order_id"),
        (F.lit(BASE).cast("timestamp") + F.make_dt_interval(secs=(F.col("id") % 900))).alias("arr"))
    orders = spark.range(0, 10_001).select(
        F.col("id"), (F.lit(BASE).cast("timestamp") + F.make_dt_interval(secs=F.lit(450))).alias("arr"))
    return orders, lines


def test_hot_order_is_split_and_exact(spark):
    orders, lines = _skewed(spark)
    with _conf(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1",
                         "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                         "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                         "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
                         "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        j = O.interval_join(orders, lines, 600).select("id", "order_id")
        n = j.count()
        j2 = O.interval_join(orders, lines, 600).select("id", "order_id")
        j2.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j2.explain()
        assert "SortMergeJoin(skew=true)" in buf.getvalue()   # the hot key is split
        j3 = O.ttl_refresh_join(orders, lines, 600)
        ttl = len(j3.collect())
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j3.explain()
        assert "SortMergeJoin(skew=true)" in buf.getvalue()   # and in the TTL form
    # every line arrives within 450 s of its order: all join, both forms
    assert n == 60_000 and ttl == 60_000


def test_hot_device_dedup_is_exact(spark):
    rows = spark.range(90_000).select(
        F.lit("2024-01-01").alias("dt"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
            F.concat(F.lit("m"), (F.col("id") % 1000).cast("string"))).alias("mid"),
        (F.lit(1_000_000) - F.col("id")).alias("ts"), F.col("id").alias("event_id"),
        F.lit("00").alias("hr"), F.lit("u").alias("uid"), F.lit("a").alias("ar"),
        F.lit("c").alias("ch"), F.lit("v").alias("vc"), F.lit(None).cast("timestamp").alias("event_time"))
    out = {r.mid: r.event_id for r in D.dedup_first_visits(rows).collect()}
    assert len(out) == 1001
    assert out["hot"] == 89_997   # the latest id divisible by 3 has the smallest ts
