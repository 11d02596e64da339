"""Orders and order lines: parse, enrich with dimensions, join into a wide row.

Join forms, all keyed on the order id:

* :func:`inner_join` / :func:`full_outer_join` — one batch (J3, J4);
* :func:`interval_join` — lines within ``ttl`` of their order, both ways (J5);
  the same function runs on streaming frames with watermarks;
* :func:`ttl_refresh_join` — the exact cache semantics (J6): an order is kept
  ``ttl`` after it arrives; lines that come first wait in a set whose expiry
  is refreshed by every new line of the same order.

Skew: an order id or a user id may hold a large share of the rows.  The big
side is always the probe side of an equi-join against a side that is unique
per key, which AQE splits when skewed; per-order state is reduced with
map-side aggregates, never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.functions.jsonfn import parse_string_map, typed_from_map
from shopstream.functions.timefn import split_datetime_text, whole_years_between
from shopstream.operators.joins import broadcast_if_bounded
from shopstream.schemas import ORDER_DETAIL_FIELDS, ORDER_INFO_FIELDS, ORDER_WIDE_COLUMNS

ORDER_INFO_COLUMNS = [f[0] for f in ORDER_INFO_FIELDS] + ["create_date", "create_hour"]
ORDER_DETAIL_COLUMNS = [f[0] for f in ORDER_DETAIL_FIELDS]
DIM_COLUMNS = ["province_name", "province_area_code", "province_3166_2_code",
               "province_iso_code", "user_age", "user_gender"]


# ------------------------------------------------------------------ parsing
def _lacks(m: Column, *ids: str) -> Column:
    """Broken text, or one of the ids missing or no number."""
    bad = m.isNull()
    for name in ids:
        bad = bad | m.getItem(name).try_cast("bigint").isNull()
    return bad


def is_bad_order(value="value") -> Column:
    """Order messages for the quarantine output."""
    return F.exists(F.array(parse_string_map(value)), lambda m: _lacks(m, "id"))


def is_bad_detail(value="value") -> Column:
    """Line messages for the quarantine output."""
    return F.exists(F.array(parse_string_map(value)), lambda m: _lacks(m, "id", "order_id"))


def _readable(topic: DataFrame, arrival_col: str, *ids: str) -> DataFrame:
    """Messages as string maps ``m`` with arrival ``arr``, without those that
    lack one of the ids.  A plain filter would be pushed below the projection
    and parse the text again for each use of the map; as the element of an
    array it is parsed once."""
    good = F.filter(F.array(parse_string_map("value")), lambda m: ~_lacks(m, *ids))
    return topic.select(F.explode(good).alias("m"), F.col(arrival_col).alias("arr"))


def parse_order_info(topic: DataFrame, arrival_col: str = "timestamp") -> DataFrame:
    """``DWD_ORDER_INFO_I`` messages -> typed rows (P2) with ``create_date``
    and ``create_hour`` split from ``create_time`` (P5) and arrival ``arr``.
    Messages without a readable id are left out; see :func:`is_bad_order`."""
    t = _readable(topic, arrival_col, "id").select(*typed_from_map("m", ORDER_INFO_FIELDS), "arr")
    d, h = split_datetime_text("create_time")
    return t.select(*[f[0] for f in ORDER_INFO_FIELDS], d.alias("create_date"),
                    h.alias("create_hour"), "arr")


def parse_order_detail(topic: DataFrame, arrival_col: str = "timestamp") -> DataFrame:
    """``DWD_ORDER_DETAIL_I`` messages -> typed rows; messages without a
    readable id and order id are left out; see :func:`is_bad_detail`."""
    return _readable(topic, arrival_col, "id", "order_id").select(*typed_from_map("m", ORDER_DETAIL_FIELDS), "arr")


# --------------------------------------------------------------- dimensions
def enrich_orders(orders: DataFrame, users: DataFrame, provinces: DataFrame,
                  unknown_age_as_zero: bool = True) -> DataFrame:
    """Left lookups of the user (age, gender) and province (4 codes) (J1, J2,
    P14, F4).  Province is a bounded table, broadcast after a size check;
    users grow with the data and are left to the planner (AQE broadcasts
    them when the measured side is small, otherwise a shuffled join with
    skew splitting on the order side)."""
    u = users.select(F.col("id").alias("u_id"),
                     F.nullif(F.col("birthday").cast("string"), F.lit("")).alias("u_birthday"),
                     F.nullif(F.col("gender"), F.lit("")).alias("user_gender"))
    p = broadcast_if_bounded(provinces.select(
        F.col("id").cast("bigint").alias("p_id"),
        F.col("name").alias("province_name"),
        F.col("area_code").alias("province_area_code"),
        F.col("iso_3166_2").alias("province_3166_2_code"),
        F.col("iso_code").alias("province_iso_code")), 100_000)
    j = (orders.join(u, F.col("user_id") == u.u_id, "left")
              .join(p, F.col("province_id") == p.p_id, "left"))
    age = whole_years_between(F.col("u_birthday"), F.col("create_time"))
    if unknown_age_as_zero:
        age = F.coalesce(age, F.lit(0))
    keep = [c for c in orders.columns]
    return j.select(*keep, "province_name", "province_area_code", "province_3166_2_code",
                    "province_iso_code", age.alias("user_age"), "user_gender")


# ---------------------------------------------------------------- join forms
def _o(orders: DataFrame) -> DataFrame:
    return orders.select(*[F.col(c).alias(f"o_{c}") for c in orders.columns])


def inner_join(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Lines with their order, one batch."""
    o = _o(orders)
    return details.join(o, details.order_id == o.o_id, "inner")


def full_outer_join(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Full outer join on the order id with a ``side`` flag.

    Written as ``lines LEFT JOIN orders`` plus ``orders ANTI distinct line
    order ids``: both halves keep the skew-splittable side on the left, and
    the distinct is combined map-side, so a hot order id is never one task
    (a plain full outer join cannot be split by AQE)."""
    o = _o(orders)
    left = details.join(o, details.order_id == o.o_id, "left").select(
        F.coalesce(F.col("o_id"), F.col("order_id")).alias("order_id"),
        F.col("id").alias("detail_id"),
        F.when(F.col("o_id").isNull(), "detail_only").otherwise("both").alias("side"))
    line_orders = details.select(F.col("order_id").alias("l_oid")).distinct()
    only = orders.join(line_orders, orders.id == line_orders.l_oid, "left_anti").select(
        F.col("id").alias("order_id"), F.lit(None).cast("bigint").alias("detail_id"),
        F.lit("order_only").alias("side"))
    return left.unionByName(only)


def merge_wide(joined: DataFrame, *more: str) -> DataFrame:
    """Wide row from a line and its (prefixed ``o_``) order (P7): order
    columns first, then line columns override equal names, plus
    ``order_id := order.id`` and ``detail_id := line.id``.  So ``create_time``
    is the line's while ``create_date``/``create_hour`` stay the order's."""
    src = {
        "detail_id": F.col("id"), "order_id": F.col("o_id"),
        "sku_id": F.col("sku_id"), "order_price": F.col("order_price"),
        "sku_num": F.col("sku_num"), "sku_name": F.col("sku_name"),
        "split_total_amount": F.col("split_total_amount"),
        "split_activity_amount": F.col("split_activity_amount"),
        "split_coupon_amount": F.col("split_coupon_amount"),
        "create_time": F.col("create_time"),
    }
    cols = []
    for c in ORDER_WIDE_COLUMNS:
        cols.append((src[c] if c in src else F.col(f"o_{c}")).alias(c))
    return joined.select(*cols, *more)


def interval_join(orders: DataFrame, details: DataFrame, ttl_seconds: int = 600) -> DataFrame:
    """Lines arriving less than ``ttl`` before or after their order.

    Equi-join on the order id plus a strict range on the arrival times; on
    streaming frames with watermarks on ``arr`` this is a stream-stream join
    whose state is evicted once the watermark passes ``arr + ttl``."""
    o = _o(orders)
    ttl = F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS")
    cond = ((details.order_id == o.o_id) &
            (details.arr > o.o_arr - ttl) & (details.arr < o.o_arr + ttl))
    return details.join(o, cond, "inner")


def ttl_join(orders: DataFrame, details: DataFrame, ttl_seconds: int = 600) -> DataFrame:
    """Lines with the columns of their order (prefixed ``o_``) under the exact
    cache semantics of the streaming join (J6), one row per line and arrival
    of its order that it meets.

    With ``to`` an arrival of the order:

    * a line arriving at or after ``to`` joins when ``arr - to < ttl``;
    * lines arriving before ``to`` sit in a set whose expiry is refreshed by
      each new line, so a line survives when no silence of ``ttl`` or more
      separates it from the next line of the same order, up to ``to``.

    Silences are found without ordering a whole order in one task.  Lines are
    bucketed by ``floor(t / ttl)`` and aggregated once, both as members of
    their bucket (``hi`` = last arrival) and as the earliest arrival of the
    bucket before (``next_lo``); the aggregate is combined map-side.  A
    silence follows bucket ``b`` exactly when ``b+1`` is empty or starts
    ``ttl`` or more after ``hi``; it breaks the set before ``to`` when ``hi``
    is ``ttl`` or more before ``to``.  Lines after the last such silence stay.

    More rows only ever add matches: a match found from a part of the rows
    holds for all of them, which is what the streaming form relies on."""
    W = int(ttl_seconds) * 1_000_000
    o = _o(orders).withColumn("o_us", F.unix_micros("o_arr"))
    d = details.withColumn("d_us", F.unix_micros("arr"))
    t = F.col("d_us")
    b = F.floor(t / W)
    roles = F.array(
        F.struct(b.alias("b"), t.alias("cur"), F.lit(None).cast("bigint").alias("nxt")),
        F.struct((b - 1).alias("b"), F.lit(None).cast("bigint").alias("cur"), t.alias("nxt")))
    buckets = (d.select("order_id", F.explode(roles).alias("r"))
               .groupBy("order_id", F.col("r.b").alias("b"))
               .agg(F.max("r.cur").alias("hi"), F.min("r.nxt").alias("next_lo")))
    silences = buckets.where(F.col("hi").isNotNull() &
                             (F.col("next_lo").isNull() | (F.col("next_lo") - F.col("hi") >= W))).select("order_id", "hi")
    brk = (silences.join(o.select("o_id", "o_us"), F.col("order_id") == F.col("o_id"), "inner")
           .where(F.col("hi") <= F.col("o_us") - W)
           .groupBy(F.col("o_id").alias("s_oid"), F.col("o_us").alias("s_us")).agg(F.max("hi").alias("brk")))
    # Bitwise-not twice hides that the orders are dealt by id already, so they
    # get a shuffle stage of their own: AQE splits a hot order only where both
    # sides of the join are such stages.
    ob = (o.join(brk, (o.o_id == brk.s_oid) & (o.o_us == brk.s_us), "left").drop("s_oid", "s_us")
          .withColumn("o_key", F.bitwise_not(F.bitwise_not("o_id"))))
    j = d.join(ob, d.order_id == ob.o_key, "inner").drop("o_key")
    after = (F.col("d_us") >= F.col("o_us")) & (F.col("d_us") - F.col("o_us") < W)
    before = (F.col("d_us") < F.col("o_us")) & \
        (F.col("brk").isNull() | (F.col("d_us") > F.col("brk")))
    return j.where(after | before).drop("d_us", "o_us", "brk")


# -------------------------------------------------- the cache rule by run intervals
RUN = "order_id long, start long, last long"


def line_runs(known: DataFrame, lines: DataFrame, ttl_seconds: int = 600) -> DataFrame:
    """Unbroken runs of an order's waiting lines (order_id, start, last; times
    in microseconds): ``known`` runs and new ``lines`` (order_id, arr) merged
    where less than ``ttl`` lies between them (T3).

    New lines are reduced to their ``ttl``-wide buckets first, combined
    map-side: lines of one bucket are one run.  The window is over an order's
    runs and buckets, not its lines."""
    W = int(ttl_seconds) * 1_000_000
    t = F.unix_micros("arr")
    new = lines.groupBy("order_id", F.floor(t / W).alias("b")).agg(F.min(t).alias("start"), F.max(t).alias("last"))
    parts = known.select("order_id", "start", "last").unionByName(new.select("order_id", "start", "last"))
    before = Window.partitionBy("order_id").orderBy("start", "last").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("order_id").orderBy("start", "last").rowsBetween(Window.unboundedPreceding, 0)
    apart = F.coalesce(F.col("start") - F.max("last").over(before) >= W, F.lit(True))
    named = parts.withColumn("apart", apart.cast("long")).withColumn("run", F.sum("apart").over(so_far))
    return named.groupBy("order_id", "run").agg(F.min("start").alias("start"), F.max("last").alias("last")).drop("run")


def waiting_from(arrivals: DataFrame, runs: DataFrame, ttl_seconds: int = 600, name: str = "lo") -> DataFrame:
    """``arrivals`` of orders (id, o_us, ...) with ``name``: from when on lines
    belong to the set that the order finds, or its own arrival.  At most one
    run is alive when an order arrives: one that began before and whose last
    line came less than ``ttl`` before, or comes later."""
    W = int(ttl_seconds) * 1_000_000
    r = runs.select(F.col("order_id").alias("_rid"), F.col("start").alias("_start"), F.col("last").alias("_last"))
    alive = (F.col("id") == F.col("_rid")) & (F.col("_start") < F.col("o_us")) & (F.col("_last") > F.col("o_us") - W)
    return (arrivals.join(r, alive, "left").withColumn(name, F.coalesce("_start", "o_us")).drop("_rid", "_start", "_last"))


def lines_of(arrivals: DataFrame, lines: DataFrame, ttl_seconds: int = 600) -> DataFrame:
    """Lines with the columns of their order (prefixed ``o_``): all that arrive
    from the order's ``lo`` until ``ttl`` after it (J6)."""
    W = int(ttl_seconds) * 1_000_000
    o = arrivals.select(*[F.col(c).alias(f"o_{c}") for c in arrivals.columns if c not in ("o_us", "lo")],
                        F.col("o_us").alias("_to"), F.col("lo").alias("_lo"))
    t = F.unix_micros("arr")
    return (lines.join(o, (F.col("order_id") == F.col("o_id")) & (t >= F.col("_lo")) & (t < F.col("_to") + W))
            .drop("_to", "_lo"))


def interval_audit(orders: DataFrame, details: DataFrame, ttl_seconds: int = 600) -> DataFrame:
    """Orders and lines without a partner less than ``ttl`` before or after
    them (J7), one row each: kind, id."""
    o = orders.select(F.col("id").alias("o_id"), F.col("arr").alias("o_arr"))
    d = details.select("order_id", F.col("arr").alias("d_arr"))
    ttl = F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS")
    lines = details.join(o, (F.col("order_id") == F.col("o_id")) & (F.col("arr") > F.col("o_arr") - ttl)
                         & (F.col("arr") < F.col("o_arr") + ttl), "left_anti")
    alone = orders.join(d, (F.col("id") == F.col("order_id")) & (F.col("d_arr") > F.col("arr") - ttl)
                        & (F.col("d_arr") < F.col("arr") + ttl), "left_anti")
    return alone.select(F.lit("order").alias("kind"), "id").unionByName(lines.select(F.lit("line").alias("kind"), "id"))


def ttl_refresh_join(orders: DataFrame, details: DataFrame, ttl_seconds: int = 600) -> DataFrame:
    """``(detail_id, order_id)`` of :func:`ttl_join`.  A line delivered twice
    is one member of the cached set (D3) and one document after the id upsert
    (D4); dropping repeats is keyed by the line, so a hot order stays split."""
    j = ttl_join(orders.select("id", "arr"), details.select("id", "order_id", "arr"), ttl_seconds)
    return j.select(F.col("id").alias("detail_id"), "order_id").dropDuplicates(["detail_id"])


def orphan_details(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Lines whose order never arrives."""
    o = orders.select(F.col("id").alias("o_id"))
    return details.join(o, details.order_id == o.o_id, "left_anti").select("id")


def orphan_orders(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Orders with no line; line order ids are de-duplicated map-side first."""
    l = details.select(F.col("order_id").alias("l_oid")).distinct()
    return orders.join(l, orders.id == l.l_oid, "left_anti").select("id")
