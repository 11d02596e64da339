"""The analytics requests of the reference's service, as DataFrame functions.

Each request is a composition of the operators over a daily-active table
(``dt, mid, hr``) or the order-wide table; results stay DataFrames (the
caller renders them).  ``date`` defaults to today in ``tz`` (P19).
"""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.operators import dau as D
from shopstream.operators import sales as SL

# Metric ids of the totals request and the one hourly metric.
METRIC_DAU = "dau"
METRIC_NEW_MID = "new_mid"
HOURLY_METRICS = (METRIC_DAU,)


def today(tz: str = "UTC") -> str:
    """Current date ``yyyy-MM-dd`` in zone ``tz``."""
    return datetime.now(ZoneInfo(tz)).strftime("%Y-%m-%d")


def realtime_total(dau: DataFrame, date: str | None = None, tz: str = "UTC") -> DataFrame:
    """``[{id, name, value}]``: active devices and new devices of the day
    (A1, A12), always both, 0 without any.  One scan: a device is new when its
    first active day is the day."""
    d = F.lit(date or today(tz))
    devices = dau.where(F.col("dt") <= d).groupBy("mid").agg(F.min("dt").alias("first"), F.max("dt").alias("last"))
    n = devices.agg(F.count_if(F.col("last") == d).alias("day"), F.count_if(F.col("first") == d).alias("new"))
    both = F.array(F.struct(F.lit(METRIC_DAU).alias("id"), F.lit("daily active devices").alias("name"), F.col("day").alias("value")),
                   F.struct(F.lit(METRIC_NEW_MID).alias("id"), F.lit("new devices").alias("name"), F.col("new").alias("value")))
    return n.select(F.inline(both))


def realtime_hour(metric_id: str, dau: DataFrame, date: str | None = None,
                  tz: str = "UTC") -> DataFrame | None:
    """Today's and yesterday's counts per hour for a known metric, else None
    (F9, A3, A4): always 24 rows."""
    if metric_id not in HOURLY_METRICS:
        return None
    return D.dau_hour_compare(dau, date or today(tz))


def sale_detail(wide: DataFrame, keyword: str, start_page: int, size: int,
                date: str | None = None, tz: str = "UTC") -> DataFrame:
    """``{total, stat, detail}`` JSON for one day's keyword search."""
    m = SL.match_set(wide, keyword, date or today(tz))
    return SL.stat_json(m, start_page, size)
