"""Input views derived from the driver tables (FIXTURES.md §2, §3).

Every view is a lazy DataFrame computed by Spark from the parquet tables, so
its work grows with them.  The same rules are written as DuckDB SQL in
:mod:`shopstream.plans.oracle`.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopstream.functions.timefn import ntz_to_epoch_ms, ntz_to_instant, split_datetime_text
from shopstream.schemas import ORDER_DETAIL_FIELDS, ORDER_INFO_FIELDS


def _str_struct(df_cols: list[str]) -> Column:
    """Struct of the given columns, every value rendered as text (CDC style)."""
    return F.struct(*[F.col(c).cast("string").alias(c) for c in df_cols])


def _as_topic(df: DataFrame, payload: Column, ts: Column) -> DataFrame:
    return df.select(payload.alias("value"), ts.alias("timestamp"))


class Views:
    def __init__(self, t):
        self.t = t

    # ------------------------------------------------------------------ logs
    @cached_property
    def app_log(self) -> DataFrame:
        ev = self.t.events.select("event_id", "ts", "user_id", "event_type")
        u = F.col("user_id")
        et = F.col("event_type")
        return ev.select(
            "event_id", "ts",
            ntz_to_epoch_ms("ts").alias("ts_ms"),
            F.concat(F.lit("mid_"), u.cast("string")).alias("mid"),
            u.cast("string").alias("uid"),
            F.concat(F.lit("ar_"), (u % 34).cast("string")).alias("ar"),
            F.when(u % 3 == 0, "store").when(u % 3 == 1, "web").otherwise("oem").alias("ch"),
            F.concat(F.lit("v"), (u % 4).cast("string")).alias("vc"),
            "event_type",
            (et != "error").alias("has_page"),
            F.when(et == "view", F.lit(None).cast("string"))
             .when(et == "signup", F.lit("")).otherwise(F.lit("home")).alias("last_page_id"),
            F.date_format("ts", "yyyy-MM-dd").alias("dt"),
            F.date_format("ts", "HH").alias("hr"),
        )

    @cached_property
    def app_log_topic(self) -> DataFrame:
        """The log as topic records: nested JSON message + broker timestamp.
        ``page`` is left out of the message when the event has no page."""
        a = self.app_log
        msg = F.to_json(F.struct(
            F.col("event_id"),
            F.struct("mid", "uid", "ar", "ch", "vc").alias("common"),
            F.when(F.col("has_page"), F.struct(F.col("event_type").alias("page_id"),
                                               F.col("last_page_id"))).alias("page"),
            F.col("ts_ms").alias("ts"),
        ))
        return a.select(msg.alias("value"), ntz_to_instant("ts").alias("timestamp"),
                        "event_id")

    # ------------------------------------------------------------ dimensions
    @cached_property
    def user_info(self) -> DataFrame:
        k = F.col("c_custkey")
        return (self.t.customer.select("c_custkey", "c_name").select(
            k.alias("id"), F.col("c_name").alias("name"),
            F.date_format(F.date_add(F.lit("1940-01-01").cast("date"),
                                     ((k * 7919) % 18000).cast("int")), "yyyy-MM-dd").alias("birthday"),
            F.when(k % 11 == 0, F.lit(None).cast("string"))
             .when(k % 2 == 0, "F").otherwise("M").alias("gender")))

    @cached_property
    def base_province(self) -> DataFrame:
        k = F.col("n_nationkey")
        return (self.t.nation.select(
            k.alias("id"), F.col("n_name").alias("name"),
            F.concat(F.lit("1"), k.cast("string")).alias("area_code"),
            F.concat(F.lit("ISO-"), k.cast("string")).alias("iso_code"),
            F.concat(F.lit("CN-"), k.cast("string")).alias("iso_3166_2")))

    # Lookups with gaps, for the queries that are about unmatched rows.
    @cached_property
    def known_users(self) -> DataFrame:
        return self.user_info.where(F.col("id") % 13 != 0)

    @cached_property
    def known_provinces(self) -> DataFrame:
        return self.base_province.where(F.col("id") != 24)

    # ---------------------------------------------------------------- orders
    @cached_property
    def all_orders(self) -> DataFrame:
        o = self.t.orders.select("o_orderkey", "o_custkey", "o_orderstatus",
                                 "o_totalprice", "o_orderdate")
        c = self.t.customer.select("c_custkey", "c_nationkey")
        k = F.col("o_orderkey")
        created_s = (k * 7919) % 86400
        return (o.join(c, o.o_custkey == c.c_custkey, "inner").select(
            k.alias("id"), F.col("c_nationkey").alias("province_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_totalprice").alias("total_amount"),
            F.timestamp_add("SECOND", created_s, F.col("o_orderdate")).alias("created"),
            F.timestamp_add("SECOND", created_s + (k * 104729) % 1500,
                            F.col("o_orderdate")).alias("arr")))

    @cached_property
    def order_info(self) -> DataFrame:
        return self.all_orders.select("*",
                                      F.date_format("created", "yyyy-MM-dd HH:mm:ss").alias("create_time"),
                                      F.date_format("created", "yyyy-MM-dd").alias("create_date"),
                                      F.date_format("created", "HH").alias("create_hour"))

    @cached_property
    def order_detail(self) -> DataFrame:
        li = self.t.lineitem
        # Ids are per-order row numbers; TPC-H bounds an order to 7 lines, so
        # each window partition is tiny and the id keeps 3 digits per order.
        w = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
        d = li.select(
            (F.col("l_orderkey") * 1000 + F.row_number().over(w)).alias("id"),
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
            F.col("l_quantity").cast("bigint").alias("sku_num"),
            F.col("l_extendedprice").alias("split_total_amount"))
        a = self.all_orders.select(F.col("id").alias("a_id"), "created")
        p = self.t.part.select("p_partkey", "p_name", "p_retailprice")
        j = d.join(a, d.order_id == a.a_id, "inner").join(p, d.sku_id == p.p_partkey, "inner")
        return j.select(
            "id", "order_id", "sku_id", F.col("p_name").alias("sku_name"),
            F.col("p_retailprice").alias("order_price"), "sku_num", "split_total_amount",
            F.timestamp_add("SECOND", (F.col("id") * 7919) % 1500, F.col("created")).alias("arr"),
            F.date_format(F.timestamp_add("SECOND", F.lit(60), F.col("created")),
                          "yyyy-MM-dd HH:mm:ss").alias("create_time"))

    # ------------------------------------------------------- topic payloads
    ORDER_INFO_MSG = ["id", "province_id", "order_status", "user_id", "total_amount",
                      "create_time"]
    ORDER_DETAIL_MSG = ["id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
                        "create_time", "split_total_amount"]

    @cached_property
    def order_info_topic(self) -> DataFrame:
        """``DWD_ORDER_INFO_I``: flat JSON, every value as text, arrival time."""
        oi = self.order_info
        return _as_topic(oi, F.to_json(_str_struct(self.ORDER_INFO_MSG)),
                         ntz_to_instant("arr"))

    @cached_property
    def order_detail_topic(self) -> DataFrame:
        od = self.order_detail
        return _as_topic(od, F.to_json(_str_struct(self.ORDER_DETAIL_MSG)),
                         ntz_to_instant("arr"))

    # ------------------------------------------------- typed topic contents
    @staticmethod
    def _typed(df: DataFrame, fields) -> list[Column]:
        cols = []
        for name, sql_type, default in fields:
            if name in df.columns:
                cols.append(F.col(name).cast(sql_type).alias(name))
            else:
                cols.append(F.lit(default).cast(sql_type).alias(name))
        return cols

    @cached_property
    def orders_dwd(self) -> DataFrame:
        """What ``parse_order_info`` yields for ``order_info_topic``, built
        directly from the typed view (a landed, parsed copy of the topic)."""
        oi = self.order_info
        d, h = split_datetime_text("create_time")
        return oi.select(*self._typed(oi, ORDER_INFO_FIELDS), d.alias("create_date"),
                         h.alias("create_hour"), ntz_to_instant("arr").alias("arr"))

    @cached_property
    def arrived_orders(self) -> DataFrame:
        """Orders with gaps: every 50th never arrives."""
        return self.orders_dwd.where(F.col("id") % 50 != 0)

    @cached_property
    def details_dwd(self) -> DataFrame:
        od = self.order_detail
        return od.select(*self._typed(od, ORDER_DETAIL_FIELDS), ntz_to_instant("arr").alias("arr"))

    # ----------------------------------------------------------------- CDC
    @staticmethod
    def _envelopes(df, table, typ, seq, data: Column, at: Column | None = None) -> DataFrame:
        return df.select(seq.cast("bigint").alias("seq"),
                         (F.timestamp_micros(seq.cast("bigint")) if at is None else at).alias("timestamp"),
                         F.to_json(F.struct(
            F.lit(table).alias("table"), (typ if isinstance(typ, Column) else F.lit(typ)).alias("type"),
            data.alias("data"), F.array(F.lit("id")).alias("pkNames"))).alias("value"))

    @cached_property
    def cdc_log(self) -> DataFrame:
        """Change envelopes ``(seq, value, timestamp)`` for the source tables.
        Orders and lines come with their arrival, lookups before them."""
        return self.cdc_lines.unionByName(self.cdc_others)

    @staticmethod
    def line_chunk() -> Column:
        return (F.col("id") / 100).cast("bigint")

    @cached_property
    def cdc_lines(self) -> DataFrame:
        """The envelopes of order lines."""
        # One INSERT per order holding its lines.  Line ids are
        # ``order_id * 1000 + n``, so grouping by ``id div 100`` is one
        # envelope per order for up to 99 lines (TPC-H has at most 7) and
        # never more than 100 rows in one envelope, however large an order.
        od = (self.order_detail.groupBy(self.line_chunk().alias("chunk"))
              .agg(F.min("arr").alias("arr"),
                   F.collect_list(F.struct(*self.ORDER_DETAIL_MSG)).alias("rows")))
        # numbers move as numbers and become text in their envelope
        text = F.transform("rows", lambda r: F.struct(*[r[c].cast("string").alias(c) for c in self.ORDER_DETAIL_MSG]))
        return self._envelopes(od, "order_detail", "INSERT", F.col("chunk") * 10 + 5, text, ntz_to_instant("arr"))

    @cached_property
    def cdc_others(self) -> DataFrame:
        """All other envelopes."""
        env = self._envelopes
        oi = self.order_info
        k = F.col("id")
        oi_row = F.array(_str_struct(self.ORDER_INFO_MSG))

        def changes(*kinds) -> Column:
            """The changes of a row: (type, place in the row's history)."""
            every = [F.when(cond, F.struct(F.lit(typ).alias("type"), F.lit(n).alias("n"))) for typ, n, cond in kinds]
            return F.explode(F.filter(F.array(*every), lambda c: c.isNotNull()))

        # one pass over the orders for all four kinds of change
        oi = oi.select("*", changes(("INSERT", 1, F.lit(True)), ("UPDATE", 2, k % 10 == 0),
                                    ("DELETE", 3, k % 100 == 0), ("CREATE", 4, k % 70 == 0)).alias("c"))
        parts = [env(oi, "order_info", F.col("c.type"), k * 10 + F.col("c.n"), oi_row, ntz_to_instant("arr"))]
        ui = self.user_info
        ui_cols = ["id", "name", "birthday", "gender"]
        ui = (ui.select("*", changes(("INSERT", 1, F.lit(True)), ("UPDATE", 2, k % 5 == 0),
                                     ("DELETE", 3, k % 25 == 0)).alias("c"))
              .withColumn("name", F.when(F.col("c.n") > 1, F.concat("name", F.lit("*"))).otherwise(F.col("name"))))
        parts.append(env(ui, "user_info", F.col("c.type"), k * 10 + F.col("c.n"), F.array(_str_struct(ui_cols))))
        # All provinces in one INSERT (nation is a fixed 25-row table).
        bp_cols = ["id", "name", "area_code", "iso_code", "iso_3166_2"]
        bp = self.base_province.agg(F.collect_list(_str_struct(bp_cols)).alias("rows"))
        parts.append(env(bp, "base_province", "INSERT", F.lit(6), F.col("rows")))
        # Products in envelopes of at most 100 rows (chunk = id div 100).
        sku = (self.t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                                  F.col("p_retailprice").alias("price"))
               .groupBy((F.col("id") / 100).cast("bigint").alias("chunk"))
               .agg(F.collect_list(_str_struct(["id", "name", "price"])).alias("rows")))
        parts.append(env(sku, "sku_info", "INSERT", F.col("chunk") * 10 + 7, F.col("rows")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # ------------------------------------------------------------- catalog
    @cached_property
    def catalog(self) -> DataFrame:
        """Document-shaped rows for nested filters, sorting and highlighting."""
        p = self.t.part
        return p.select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
            F.col("p_retailprice").alias("score"),
            F.struct(F.col("p_size").cast("string").alias("id"),
                     F.col("p_brand").alias("name")).alias("directors"),
            F.array(F.struct(F.col("p_brand").alias("name")),
                    F.struct(F.col("p_type").alias("name"))).alias("credits"),
            F.date_add(F.lit("1992-01-01").cast("date"),
                       (F.col("p_partkey") % 2500).cast("int")).alias("released"))
