"""The query catalogue: one ``(spark, sf_dir) -> DataFrame`` per operator.

Each entry reads the driver tables (through the derived views) and applies
the operators of :mod:`shopstream.operators` over the whole tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.fixtures import Views
from shopstream.operators import beans as B
from shopstream.operators import cdc as C
from shopstream.operators import dau as D
from shopstream.operators import orders as O
from shopstream.operators import sales as SL
from shopstream.operators import search as S
from shopstream.plans import api as API
from shopstream.schemas import CDC_ENVELOPE
from shopstream.session import TIDY, scratch_path, session_conf
from shopstream.sources import sinks as K
from shopstream.sources.search_index import SearchIndex
from shopstream.sources.snapshot import read_snapshot
from shopstream.sources.tables import tables
from shopstream.sources.topics import LARGE_ROWS_PER_CORE, ROWS_PER_CORE, read_topic, write_replay
from shopstream.streaming import jobs as J

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _views(spark: SparkSession, sf_dir: str):
    return tables(spark, sf_dir).views


def _parsed_log(spark, sf_dir) -> DataFrame:
    return D.parse_app_log(_views(spark, sf_dir).app_log_topic)


def _dau(spark, sf_dir) -> DataFrame:
    return D.dedup_first_visits(D.first_visits(_parsed_log(spark, sf_dir)))


# ------------------------------------------------------- logs / daily actives
@query("log_parse")
def q_log_parse(spark, sf_dir):
    return _parsed_log(spark, sf_dir).select(
        "event_id", "mid", "uid", "ar", "ch", "vc", "last_page_id", "dt", "hr")


@query("log_quarantine")
def q_log_quarantine(spark, sf_dir):
    topic = _views(spark, sf_dir).app_log_topic
    cut = F.when(F.col("event_id") % 97 == 0,
                 F.substring("value", 1, F.length("value") / 2)).otherwise(F.col("value"))
    return D.quarantine_counts(topic.select(cut.alias("value")))


@query("first_visits")
def q_first_visits(spark, sf_dir):
    return D.first_visits(_parsed_log(spark, sf_dir)).select("event_id", "mid", "dt", "hr")


@query("dau_dedup")
def q_dau_dedup(spark, sf_dir):
    return _dau(spark, sf_dir).select("dt", "mid", "hr", "event_id")


@query("dau_info")
def q_dau_info(spark, sf_dir):
    return D.dau_info(_dau(spark, sf_dir))


@query("dau_total")
def q_dau_total(spark, sf_dir):
    return D.dau_total(_dau(spark, sf_dir))


@query("dau_hour")
def q_dau_hour(spark, sf_dir):
    return D.dau_hour(_dau(spark, sf_dir))


@query("dau_hour_compare")
def q_dau_hour_compare(spark, sf_dir):
    return D.dau_hour_compare(_dau(spark, sf_dir))


@query("new_devices")
def q_new_devices(spark, sf_dir):
    return D.new_devices(_dau(spark, sf_dir))


# ------------------------------------------------------ change data, snapshots


def _envelopes(spark, sf_dir) -> DataFrame:
    return C.parse_envelopes(_views(spark, sf_dir).cdc_log)


@query("dim_snapshot")
def q_dim_snapshot(spark, sf_dir):
    """A dimension table as the snapshot source reads it."""
    path = scratch_path(spark, "snapshot-user_info")
    _views(spark, sf_dir).user_info.write.parquet(path)
    return read_snapshot(spark, "user_info", path=path).select("id", "birthday", "gender")


@query("snapshot_to_envelope")
def q_snapshot_to_envelope(spark, sf_dir):
    v = _views(spark, sf_dir)
    sku = v.t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                          F.col("p_retailprice").alias("price"))
    out = None
    for name, df in (("user_info", v.user_info), ("base_province", v.base_province),
                     ("sku_info", sku)):
        e = C.snapshot_to_envelopes(df, name, "id", 500)
        out = e if out is None else out.unionByName(e)
    # what the payload holds, read back from the message
    rows = F.from_json("value", CDC_ENVELOPE).getField("data")
    return out.select(
        "table", "type", "chunk", F.col("n_rows").cast("bigint").alias("n_rows"),
        F.aggregate(rows, F.lit(0).cast("bigint"), lambda a, r: a + r.getItem("id").cast("bigint")).alias("id_sum"),
        F.array_min(F.transform(rows, lambda r: r.getItem("name"))).alias("first_name"))


@query("cdc_explode")
def q_cdc_explode(spark, sf_dir):
    return C.envelope_counts(_envelopes(spark, sf_dir))


@query("cdc_route_facts")
def q_cdc_route_facts(spark, sf_dir):
    m = F.from_json("value", "map<string,string>")
    facts = C.route_facts(_envelopes(spark, sf_dir)).select("topic", m.alias("m"))
    return facts.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("m").getItem("id").cast("bigint")).alias("id_sum"),
        F.min(F.col("m").getItem("create_time")).alias("first_time"), F.max(F.col("m").getItem("create_time")).alias("last_time"))


@query("cdc_quarantine")
def q_cdc_quarantine(spark, sf_dir):
    cdc = _views(spark, sf_dir).cdc_log
    cut = F.when(F.col("seq") % 97 == 0, F.substring("value", 1, F.length("value") / 2)).otherwise(F.col("value"))
    bad = C.is_bad_envelope("value")
    return cdc.select(cut.alias("value")).agg(F.count_if(~bad).alias("n_ok"), F.count_if(bad).alias("n_bad"))


@query("dim_latest")
def q_dim_latest(spark, sf_dir):
    d = C.dim_latest(_envelopes(spark, sf_dir))
    return d.select("key", F.col("pk").cast("bigint").alias("id"),
                    F.col("row").getItem("name").alias("name"))


# ------------------------------------------------------------------- orders
def _orders(spark, sf_dir) -> DataFrame:
    """Typed orders as landed from ``DWD_ORDER_INFO_I`` (parsing has its own
    query, ``order_info_parse``)."""
    return _views(spark, sf_dir).orders_dwd


def _details(spark, sf_dir) -> DataFrame:
    return _views(spark, sf_dir).details_dwd


def _enriched(spark, sf_dir) -> DataFrame:
    v = _views(spark, sf_dir)
    return O.enrich_orders(_orders(spark, sf_dir), v.user_info, v.base_province)


def order_wide(spark, sf_dir) -> DataFrame:
    """Wide table: every line with its enriched order (batch form)."""
    return O.merge_wide(O.inner_join(_enriched(spark, sf_dir), _details(spark, sf_dir)))


@query("order_info_parse")
def q_order_info_parse(spark, sf_dir):
    topic = _views(spark, sf_dir).order_info_topic
    return O.parse_order_info(topic).select(*O.ORDER_INFO_COLUMNS)


@query("order_detail_parse")
def q_order_detail_parse(spark, sf_dir):
    topic = _views(spark, sf_dir).order_detail_topic
    return O.parse_order_detail(topic).select(*O.ORDER_DETAIL_COLUMNS)


@query("order_quarantine")
def q_order_quarantine(spark, sf_dir):
    """Cut, empty and id-less messages of both order topics."""
    v = _views(spark, sf_dir)
    out = None
    for name, rows, fields, bad in (("order", v.order_info, v.ORDER_INFO_MSG, O.is_bad_order("value")),
                                    ("line", v.order_detail, v.ORDER_DETAIL_MSG, O.is_bad_detail("value"))):
        text = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in fields]))
        n = F.pmod("id", F.lit(97))
        broken = (F.when(n == 0, F.substring(text, 1, F.length(text) / 2)).when(n == 1, F.lit(""))
                  .when(n == 2, F.regexp_replace(text, '"id":"[0-9]+"', '"id":"x"')).otherwise(text))
        part = rows.select(broken.alias("value")).agg(
            F.lit(name).alias("topic"), F.count_if(~bad).alias("n_ok"), F.count_if(bad).alias("n_bad"))
        out = part if out is None else out.unionByName(part)
    return out


@query("order_dim_join")
def q_order_dim_join(spark, sf_dir):
    v = _views(spark, sf_dir)
    return O.enrich_orders(v.orders_dwd, v.known_users, v.known_provinces).select(
        "id", "user_age", "user_gender", "province_name", "province_area_code",
        "province_iso_code", "province_3166_2_code")


@query("order_inner")
def q_order_inner(spark, sf_dir):
    j = O.inner_join(_orders(spark, sf_dir), _details(spark, sf_dir))
    return j.select(F.col("o_id").alias("order_id"), F.col("id").alias("detail_id"),
                    F.lit("both").alias("side"))


@query("order_full_outer")
def q_order_full_outer(spark, sf_dir):
    return O.full_outer_join(_views(spark, sf_dir).arrived_orders, _details(spark, sf_dir))


@query("order_wide")
def q_order_wide(spark, sf_dir):
    return order_wide(spark, sf_dir)


@query("order_wide_interval")
def q_order_wide_interval(spark, sf_dir):
    j = O.interval_join(_orders(spark, sf_dir), _details(spark, sf_dir), 600)
    return j.select(F.col("id").alias("detail_id"), "order_id")


@query("order_wide_ttl")
def q_order_wide_ttl(spark, sf_dir):
    return O.ttl_refresh_join(_orders(spark, sf_dir), _details(spark, sf_dir), 600)


@query("orphan_details")
def q_orphan_details(spark, sf_dir):
    return O.orphan_details(_views(spark, sf_dir).arrived_orders, _details(spark, sf_dir))


@query("orphan_orders")
def q_orphan_orders(spark, sf_dir):
    return O.orphan_orders(_orders(spark, sf_dir), _details(spark, sf_dir))


# ------------------------------------------------------------ search, sales

# Query parameters of the registered searches.
SEARCH_KEYWORD = "red widget"
CATALOG_KEYWORD = "red"
CATALOG_TERM = ("credits", "name", "Brand#17")
HIGHLIGHT_KEYWORD = "red widget"
RANK_QUERY = "the of and"
DOCUMENT_KEYWORD = "NICHT_Été red_идти"
INDEX_KEYWORD, INDEX_PHRASE = "the of", "of the"
SALE_KEYWORD = "red"
SALE_PAGE_NO, SALE_PAGE_SIZE = 2, 20
PROVINCE_BIN_WIDTH = 20_000


@query("search_match_all")
def q_search_match_all(spark, sf_dir):
    return S.match_all(order_wide(spark, sf_dir), "sku_name", SEARCH_KEYWORD) \
        .select("detail_id", "sku_name")


@query("search_match_any")
def q_search_match_any(spark, sf_dir):
    return S.match_any(order_wide(spark, sf_dir), "sku_name", SEARCH_KEYWORD) \
        .select("detail_id", "sku_name")


@query("search_bool_filter")
def q_search_bool_filter(spark, sf_dir):
    arr, field, value = CATALOG_TERM
    c = _views(spark, sf_dir).catalog
    return S.bool_filter(c, "name", CATALOG_KEYWORD, arr, field, value).select("id", "name")


@query("search_sorted_top")
def q_search_sorted_top(spark, sf_dir):
    c = S.match_any(_views(spark, sf_dir).catalog, "name", CATALOG_KEYWORD)
    return S.sorted_top(c, "score", 20, "id").select("id", "name", "score")


@query("search_highlight")
def q_search_highlight(spark, sf_dir):
    c = S.match_any(_views(spark, sf_dir).catalog, "name", HIGHLIGHT_KEYWORD)
    return S.highlight(c, "name", HIGHLIGHT_KEYWORD).select("id", "highlight")


@query("search_combined")
def q_search_combined(spark, sf_dir):
    arr, field, value = CATALOG_TERM
    c = _views(spark, sf_dir).catalog
    return S.bool_search(c, "name", CATALOG_KEYWORD, arr, field, value, "score", 20, "id") \
        .select("id", "name", "score", "highlight")


@query("search_documents")
def q_search_documents(spark, sf_dir):
    """Match and highlight over whole texts in four languages; the keyword has
    an underscore and letters beyond ASCII."""
    docs = tables(spark, sf_dir).documents.select("doc_id", "text")
    hits = S.match_any(docs, "text", DOCUMENT_KEYWORD)
    marked = S.highlight(hits, "text", DOCUMENT_KEYWORD)
    return marked.select("doc_id", ((F.length("highlight") - F.length("text")) / 9).cast("bigint").alias("n_hits"))


@query("search_ranked")
def q_search_ranked(spark, sf_dir):
    docs = tables(spark, sf_dir).documents.select("doc_id", "text")
    r = S.ranked(docs, "doc_id", "text", RANK_QUERY, 20,
                 stage=lambda df: _materialize(spark, df, "bm25-terms"))
    return r.select("doc_id", F.round("score", 4).alias("bm25"))


_INDEXES: dict[tuple[str, str], SearchIndex] = {}


def _document_index(spark, sf_dir) -> SearchIndex:
    """The index of all documents, written once a session in two batches with
    a merge between them.  The second batch replaces a third of the documents,
    which the first one holds with more words."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _INDEXES:
        docs = tables(spark, sf_dir).documents.select("doc_id", "text")
        part = F.pmod(F.xxhash64("doc_id"), F.lit(3))
        older = F.when(part == 1, F.concat("text", F.lit(" the red of the widget and"))).otherwise(F.col("text"))
        index = SearchIndex(spark, scratch_path(spark, "document-index"))
        index.write_batch(docs.where(part < 2).withColumn("text", older), 0, "doc_id")
        index.merge()
        index.write_batch(docs.where(part > 0), 1, "doc_id")
        _INDEXES[key] = index
    return _INDEXES[key]


@query("search_indexed_all")
def q_search_indexed_all(spark, sf_dir):
    hits = _document_index(spark, sf_dir).match_all(INDEX_KEYWORD)
    return hits.select(F.col("id").alias("doc_id"), "n_hits")


@query("search_indexed_any")
def q_search_indexed_any(spark, sf_dir):
    hits = _document_index(spark, sf_dir).match_any(DOCUMENT_KEYWORD)
    return hits.select(F.col("id").alias("doc_id"), "n_terms", "n_hits")


@query("search_indexed_phrase")
def q_search_indexed_phrase(spark, sf_dir):
    hits = _document_index(spark, sf_dir).match_phrase(INDEX_PHRASE)
    return hits.select(F.col("id").alias("doc_id"), "n_hits")


@query("search_indexed_ranked")
def q_search_indexed_ranked(spark, sf_dir):
    top = _document_index(spark, sf_dir).ranked(RANK_QUERY, 20)
    return top.select(F.col("id").alias("doc_id"), F.round("score", 4).alias("bm25"))


@query("select_scalar_columns")
def q_select_scalar_columns(spark, sf_dir):
    return B.select_scalar_columns(_views(spark, sf_dir).catalog)


def _sale_match(spark, sf_dir) -> DataFrame:
    return SL.match_set(order_wide(spark, sf_dir), SALE_KEYWORD)


@query("sale_total")
def q_sale_total(spark, sf_dir):
    return SL.total(_sale_match(spark, sf_dir))


@query("sale_page")
def q_sale_page(spark, sf_dir):
    return SL.sale_page(_sale_match(spark, sf_dir), SALE_PAGE_NO, SALE_PAGE_SIZE)


@query("sale_age_terms")
def q_sale_age_terms(spark, sf_dir):
    return SL.age_terms(_sale_match(spark, sf_dir))


@query("sale_gender_terms")
def q_sale_gender_terms(spark, sf_dir):
    return SL.gender_terms(_sale_match(spark, sf_dir))


@query("sale_age_share")
def q_sale_age_share(spark, sf_dir):
    return SL.age_share(_sale_match(spark, sf_dir))


@query("sale_gender_share")
def q_sale_gender_share(spark, sf_dir):
    return SL.gender_share(_sale_match(spark, sf_dir))


@query("sale_stat_json")
def q_sale_stat_json(spark, sf_dir):
    """The JSON answer, read back into rows ``(part, name, value)``."""
    schema = ("total bigint, stat array<struct<options: array<struct<name: string, value: double>>, title: string>>, "
              "detail array<struct<detail_id: bigint, sku_num: bigint>>")
    j = SL.stat_json(_sale_match(spark, sf_dir), SALE_PAGE_NO, SALE_PAGE_SIZE).select(F.from_json("json", schema).alias("j"))
    total = F.array(F.struct(F.lit("total").alias("part"), F.lit("").alias("name"), F.col("j.total").cast("double").alias("value")))
    stat = F.flatten(F.transform("j.stat", lambda s: F.transform(s.options, lambda o: F.struct(
        s.title.alias("part"), o["name"].alias("name"), o.value.alias("value")))))
    detail = F.transform("j.detail", lambda d: F.struct(
        F.lit("detail").alias("part"), d.detail_id.cast("string").alias("name"), d.sku_num.cast("double").alias("value")))
    return j.select(F.inline(F.concat(total, stat, detail)))


# The requests for one day (A1, A3, A4, A12): the last day of the log, and the
# day after it, on which nothing happened.
def _log_days(spark, sf_dir) -> tuple[str, str]:
    last = _views(spark, sf_dir).app_log.agg(F.max("dt").alias("d"), F.date_format(
        F.date_add(F.max("dt").cast("date"), 1), "yyyy-MM-dd").alias("e")).first()
    return last.d, last.e


@query("realtime_total")
def q_realtime_total(spark, sf_dir):
    day, after = _log_days(spark, sf_dir)
    dau = _dau(spark, sf_dir)
    return API.realtime_total(dau, day).withColumn("day", F.lit("last")).unionByName(
        API.realtime_total(dau, after).withColumn("day", F.lit("after"))).select("day", "id", "value")


@query("realtime_hour")
def q_realtime_hour(spark, sf_dir):
    day, after = _log_days(spark, sf_dir)
    dau = _dau(spark, sf_dir)
    return API.realtime_hour("dau", dau, day).unionByName(API.realtime_hour("dau", dau, after))


@query("province_sales")
def q_province_sales(spark, sf_dir):
    return SL.province_sales(order_wide(spark, sf_dir), PROVINCE_BIN_WIDTH)


# --------------------------------------------------------- sinks, streaming

REPLAY_SLOT = 30 * 86_400       # replayed batches span months: no partition per day


def _state_partitions(spark) -> int:
    """State partitions of a new stream: two per core of the cluster, slack
    for stragglers (the batch default is sized for shuffles, and a stream
    keeps its count)."""
    return max(2 * spark.sparkContext.defaultParallelism, 2)


def _materialize(spark, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: later
    steps reuse it without recomputing, and lineage is cut (a lost executor
    re-reads files instead of recomputing the whole plan)."""
    path = scratch_path(spark, f"stage-{name}")
    with session_conf(spark, TIDY):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


PASSES = 4                  # of the order lines, so that the shuffles of one pass lie on the disk at a time
LINES_A_PASS = 1_000_000    # small tables take fewer, as each reads the tables again


def _pass_count(v) -> int:
    return min(PASSES, max(1, math.ceil(v.t.lineitem.count() / LINES_A_PASS)))


def _passes(spark, parts, rows, path: str, *by: str) -> None:
    """Write ``rows`` of each of the views, one after another."""
    for part in parts:
        with session_conf(spark, TIDY):
            rows(part).write.mode("append").partitionBy(*by).option("compression", "zstd").parquet(path)


def _orders_apart(v, passes: int):
    """The views over one share of the orders and their lines at a time."""
    for k in range(passes):
        t = tables(v.t.spark, v.t.sf_dir)
        t.orders, t.lineitem = (x.where(F.pmod(key, F.lit(passes)) == k)
                                for x, key in ((v.t.orders, "o_orderkey"), (v.t.lineitem, "l_orderkey")))
        yield Views(t)


def _lines_apart(lines: DataFrame, passes: int):
    """The views over the lines of one pass at a time."""
    for k in range(passes):
        part = Views(None)
        part.order_detail = lines.where(F.col("pass") == k)
        yield part


def _stage_cdc(spark, v, rows) -> str:
    """``rows(log)`` of the change-data topic, written: the lines first, then
    their envelopes, each in passes, then all others."""
    lines, path = scratch_path(spark, "stage-order_lines"), scratch_path(spark, "stage-cdc")
    n = _pass_count(v)
    chunk = F.pmod(v.line_chunk(), F.lit(n)).cast("int")
    _passes(spark, _orders_apart(v, n), lambda p: p.order_detail.withColumn("pass", chunk), lines, "pass")
    back = spark.read.schema(v.order_detail.withColumn("pass", chunk).schema).parquet(lines)
    _passes(spark, _lines_apart(back, n), lambda p: rows(p.cdc_lines), path)
    K.drop_path(spark, lines)
    with session_conf(spark, TIDY):
        rows(v.cdc_others).write.mode("append").option("compression", "zstd").parquet(path)
    return path


def _replay(spark, records: DataFrame, name: str, stage: str | None = None) -> DataFrame:
    """Replay ``records`` as a topic: a streaming frame reading one time
    slice of a bounded number of rows per micro-batch.  ``stage`` names the
    files where they are written already."""
    path = scratch_path(spark, f"replay-{name}")
    keep = [c for c in ("value", "timestamp", "offset") if c in records.columns]
    records = records.select(*keep)
    if stage is None:
        stage = scratch_path(spark, f"stage-{name}")
        with session_conf(spark, TIDY):
            records.write.option("compression", "zstd").parquet(stage)
    layout = write_replay(spark.read.schema(records.schema).parquet(stage), path, drop=stage)
    return read_topic(spark, replay_path=path, max_files_per_trigger=layout.files_per_slice)


def _replay_orders(spark, v, rows_per_core: int = ROWS_PER_CORE) -> tuple[DataFrame, DataFrame]:
    """Both order topics sliced at the same arrival times, as a broker
    would deliver them to one query."""
    o_src, d_src = scratch_path(spark, "replay-order_info"), scratch_path(spark, "replay-detail")
    o_stage, d_stage = scratch_path(spark, "stage-order_info"), scratch_path(spark, "stage-order_detail")
    record = ["value", "timestamp"]
    _passes(spark, _orders_apart(v, _pass_count(v)), lambda p: p.order_detail_topic.select(*record), d_stage)
    ld = write_replay(spark.read.schema(v.order_detail_topic.select(*record).schema).parquet(d_stage), d_src, drop=d_stage, rows_per_core=rows_per_core)
    o = v.order_info_topic.select(*record)
    with session_conf(spark, TIDY):
        o.write.option("compression", "zstd").parquet(o_stage)
    lo = write_replay(spark.read.schema(o.schema).parquet(o_stage), o_src, bounds=ld.bounds, drop=o_stage)
    return (read_topic(spark, replay_path=o_src, max_files_per_trigger=lo.files_per_slice),
            read_topic(spark, replay_path=d_src, max_files_per_trigger=ld.files_per_slice))


@query("src_topic_replay")
def q_src_topic_replay(spark, sf_dir):
    src = _replay(spark, _views(spark, sf_dir).app_log_topic, "app_log")
    out = scratch_path(spark, "topic-counts")
    J.run_topic_counts(spark, src, "page_id", out, scratch_path(spark, "ckpt-topic-counts"),
                       state_partitions=_state_partitions(spark))
    return K.read_latest(spark, out, "page_id").select("page_id", "n")


@query("dau_dedup_stream")
def q_dau_dedup_stream(spark, sf_dir):
    src = _replay(spark, _views(spark, sf_dir).app_log_topic, "app_log")
    out = scratch_path(spark, "dau-stream")
    J.run_dau(spark, src, out, scratch_path(spark, "ckpt-dau"),
              state_partitions=_state_partitions(spark))
    return K.read_latest(spark, out, ["dt", "mid"]).select(F.col("dt").cast("string").alias("dt"), "mid", "hr", "event_id")


def _late_log(spark, sf_dir) -> DataFrame:
    """The log with arrivals of its own: one record in seven comes up to four
    days late, so days are touched again before and after their set expired."""
    log = _views(spark, sf_dir).app_log_topic
    late = F.when(F.col("event_id") % 7 == 0, F.col("event_id") % 5 * 86_400_000_000).otherwise(0)
    return log.withColumn("timestamp", F.timestamp_micros(F.unix_micros("timestamp") + late))


@query("dau_expiring")
def q_dau_expiring(spark, sf_dir):
    """Daily actives under the set's refreshed expiry."""
    first = D.first_visits(D.parse_app_log(_late_log(spark, sf_dir), arr_col="timestamp"))
    return D.expiring_first_visits(D.touch_buckets(first)).select("dt", "life", "mid", "hr", "event_id")


@query("dau_expiring_stream")
def q_dau_expiring_stream(spark, sf_dir):
    """The same from the replayed topic."""
    out = scratch_path(spark, "dau-expiring")
    J.run_dau_expiring(spark, _replay(spark, _late_log(spark, sf_dir), "app_log_late"), out, scratch_path(spark, "ckpt-dau-expiring"),
                       state_partitions=_state_partitions(spark))
    return J.read_dau_expiring(spark, out).select("dt", "life", "mid", "hr", "event_id")


def _withheld_orders(v) -> DataFrame:
    """The order topic without every 50th order."""
    keep = v.order_info_topic.withColumn("_id", F.get_json_object("value", "$.id").cast("bigint"))
    return keep.where(F.col("_id") % 50 != 0).drop("_id")


@query("orphans_interval")
def q_orphans_interval(spark, sf_dir):
    """Orders and lines without a partner in reach (J7), where every 50th
    order never arrives."""
    v = _views(spark, sf_dir)
    # both halves of the audit use both topics: what it needs of them is parsed once
    orders = _materialize(spark, O.parse_order_info(_withheld_orders(v)).select("id", "arr"), "orders-left")
    lines = _materialize(spark, O.parse_order_detail(v.order_detail_topic).select("id", "order_id", "arr"), "lines")
    return O.interval_audit(orders, lines)


@query("orphans_stream")
def q_orphans_stream(spark, sf_dir):
    """The same from the running stream.  A mark at the end of both topics
    moves the watermark past all other rows."""
    v = _views(spark, sf_dir)
    o = _materialize(spark, _withheld_orders(v).select("value", "timestamp"), "orders-left")
    d = _materialize(spark, v.order_detail_topic.select("value", "timestamp"), "order_detail")
    o_src, d_src = scratch_path(spark, "replay-orders-left"), scratch_path(spark, "replay-detail")
    ld = write_replay(d, d_src)
    lo = write_replay(o, o_src, bounds=ld.bounds)
    out, ck = scratch_path(spark, "orphans"), scratch_path(spark, "ckpt-orphans")
    run = lambda: J.run_orphans(
        spark, read_topic(spark, replay_path=o_src, max_files_per_trigger=lo.files_per_slice),
        read_topic(spark, replay_path=d_src, max_files_per_trigger=ld.files_per_slice), out, ck,
        state_partitions=_state_partitions(spark))
    run()
    end = (o.select("timestamp").unionByName(d.select("timestamp"))
           .agg(F.timestamp_micros(F.unix_micros(F.max("timestamp")) + 86_400_000_000).alias("timestamp")))
    mark = lambda key: end.select(F.to_json(F.struct(F.lit("-1").alias("id"), *key)).alias("value"), "timestamp")
    mark([]).write.mode("append").json(o_src)
    mark([F.lit("-2").alias("order_id")]).write.mode("append").json(d_src)
    run()
    return spark.read.parquet(out).select("kind", "id")


@query("order_wide_stream")
def q_order_wide_stream(spark, sf_dir):
    """The wide rows of the interval form."""
    v = _views(spark, sf_dir)
    o_src, d_src = _replay_orders(spark, v)
    out = scratch_path(spark, "order-wide-stream")
    J.run_order_wide(spark, o_src, d_src, lambda: (v.user_info, v.base_province),
                     out, scratch_path(spark, "ckpt-order-wide"),
                     state_partitions=_state_partitions(spark), by=())
    return J.read_wide(spark, out)


@query("batch_progress")
def q_batch_progress(spark, sf_dir):
    """Offset ranges of four batches of the log, cut at fixed offsets."""
    log = _materialize(spark, _views(spark, sf_dir).app_log_topic.withColumn("offset", F.col("event_id")), "app_log")
    width = F.lit(log.agg(F.max("offset")).first()[0] // 4 + 1)
    path = scratch_path(spark, "replay-progress")
    layout = write_replay(log, path, slices=F.floor(F.col("offset") / width))
    src = read_topic(spark, replay_path=path, max_files_per_trigger=layout.files_per_slice)
    table = scratch_path(spark, "batch-progress")
    J.run_batch_progress(spark, src, table, scratch_path(spark, "ckpt-batch-progress"),
                         state_partitions=_state_partitions(spark))
    return spark.read.parquet(table).select(F.col("batch_id").cast("bigint").alias("batch_id"), "n_rows", "from_offset",
                                            "until_offset")


@query("dau_daily_partition")
def q_dau_daily_partition(spark, sf_dir):
    """Two loads that share days, the first repeated: no load erases another."""
    path = scratch_path(spark, "dau-daily")
    rows = _materialize(spark, D.dau_info(_dau(spark, sf_dir)), "dau")
    for load in (0, 1, 0):
        K.write_daily(rows.where(F.pmod(F.xxhash64("mid"), F.lit(2)) == load), path, load)
    return spark.read.parquet(path).groupBy("dt").agg(F.count(F.lit(1)).alias("n"))


@query("upsert_latest")
def q_upsert_latest(spark, sf_dir):
    """Three overlapping batches of order lines, then batch 1 replayed: the
    replay replaces only its own output and the latest batch still wins.  In a
    batch every id comes twice; the later one wins though its value is less.
    The table is compacted on the way."""
    d = _materialize(spark, _details(spark, sf_dir).select("id"), "upsert-src")
    table = scratch_path(spark, "upsert")
    for step, b in enumerate((0, 1, 2, 1)):
        batch = d.where((F.col("id") % 3 == b) | (F.col("id") % 7 == 0)) \
            .select("id", F.explode(F.array(F.struct(F.lit(1).alias("at"), F.lit(f"z{b}").alias("value")),
                                            F.struct(F.lit(2).alias("at"), F.lit(f"b{b}").alias("value")))).alias("v")) \
            .select("id", "v.*")
        K.upsert_batch(batch, table, b, "id", "at")
        if step == 1:
            K.compact(spark, table, "id")
    return K.read_latest(spark, table, "id").select("id", "value")


@query("append_docs")
def q_append_docs(spark, sf_dir):
    d = _materialize(spark, _details(spark, sf_dir).select("id", "order_id", "sku_name"),
                     "append-src")
    path = scratch_path(spark, "append")
    K.append_docs(d, path)
    K.append_docs(d, path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


@query("cdc_split_stream")
def q_cdc_split_stream(spark, sf_dir):
    """The change-data topic replayed through the streaming split; the
    dimension table it maintains equals the batch ``dim_latest``."""
    v = _views(spark, sf_dir)
    rows = lambda log: log.select("value", F.timestamp_micros("seq").alias("timestamp"), F.col("seq").alias("offset"))
    src = _replay(spark, rows(v.cdc_log), "cdc", _stage_cdc(spark, v, rows))
    dims, facts = scratch_path(spark, "dims"), scratch_path(spark, "facts")
    J.run_cdc_split(spark, src, dims, facts, scratch_path(spark, "ckpt-cdc"),
                    state_partitions=_state_partitions(spark), compact_every=2)
    latest = K.read_latest(spark, dims, "key")
    return latest.select("key", F.col("pk").cast("bigint").alias("id"),
                         F.get_json_object("value", "$.name").alias("name"))


@query("order_wide_ttl_stream")
def q_order_wide_ttl_stream(spark, sf_dir):
    """The wide rows of both order topics under the exact cache semantics."""
    v = _views(spark, sf_dir)
    o_src, d_src = _replay_orders(spark, v, LARGE_ROWS_PER_CORE)
    out = scratch_path(spark, "order-wide-ttl-stream")
    J.run_order_wide_ttl(spark, o_src, d_src, lambda: (v.user_info, v.base_province), out,
                         scratch_path(spark, "ckpt-ttl-stream"), 600, state_partitions=_state_partitions(spark),
                         slot_seconds=REPLAY_SLOT, by=())
    return J.read_wide(spark, out)


@query("cdc_to_wide")
def q_cdc_to_wide(spark, sf_dir):
    """The whole chain: snapshot envelopes of the lookups come first on the
    change-data topic, then all changes; the split keeps the lookups and the
    fact topics; the wide stream reads both (S6, S7, S8, T8, J1, J2, J6)."""
    v = _views(spark, sf_dir)
    snapshot = C.snapshot_to_envelopes(v.user_info, "user_info").unionByName(
        C.snapshot_to_envelopes(v.base_province, "base_province"))
    first = snapshot.select("value", F.timestamp_micros(F.lit(0)).alias("timestamp"), F.lit(0).cast("bigint").alias("offset"))
    rows = lambda log: log.select("value", "timestamp", F.col("seq").alias("offset"))
    stage = _stage_cdc(spark, v, rows)
    with session_conf(spark, TIDY):
        first.write.mode("append").option("compression", "zstd").parquet(stage)
    src = _replay(spark, first.unionByName(rows(v.cdc_log)), "chain", stage)
    dims, facts = scratch_path(spark, "chain-dims"), scratch_path(spark, "chain-facts")
    J.run_cdc_split(spark, src, dims, facts, scratch_path(spark, "ckpt-chain-split"),
                    state_partitions=_state_partitions(spark))
    out = scratch_path(spark, "chain-wide")
    topics = ["DWD_ORDER_INFO_I", "DWD_ORDER_DETAIL_I"]
    cut = J.facts_cut(spark, facts, topics)
    J.run_order_wide_ttl(spark, *[J.stream_facts(spark, facts, t, cut.files) for t in topics],
                         lambda: J.read_dims(spark, dims), out, scratch_path(spark, "ckpt-chain-wide"), 600,
                         delay_seconds=max(86_400, cut.span_seconds),
                         state_partitions=_state_partitions(spark), slot_seconds=REPLAY_SLOT, by=())
    return J.read_wide(spark, out)
