"""Oracle SQL (DuckDB dialect) for every query of the catalogue.

Each statement is the derived views of FIXTURES.md §2 as CTEs, followed by
the query itself written the plain, brute-force way (windows, joins) so that
it checks the Spark plan rather than repeating it.
"""

from __future__ import annotations

# ---------------------------------------------------------------- base views
VIEWS = {
    "app_log": """
select event_id, ts, epoch_us(ts) // 1000 as ts_ms,
       concat('mid_', user_id) as mid, cast(user_id as varchar) as uid,
       concat('ar_', user_id % 34) as ar,
       case user_id % 3 when 0 then 'store' when 1 then 'web' else 'oem' end as ch,
       concat('v', user_id % 4) as vc,
       event_type, (event_type <> 'error') as has_page,
       case event_type when 'view' then null when 'signup' then '' else 'home' end as last_page_id,
       strftime(ts, '%Y-%m-%d') as dt, strftime(ts, '%H') as hr
from events""",
    "user_info": """
select c_custkey as id, c_name as name,
       strftime(date '1940-01-01' + cast(c_custkey * 7919 % 18000 as int), '%Y-%m-%d') as birthday,
       case when c_custkey % 11 = 0 then null when c_custkey % 2 = 0 then 'F' else 'M' end as gender
from customer""",
    "base_province": """
select n_nationkey as id, n_name as name, concat('1', n_nationkey) as area_code,
       concat('ISO-', n_nationkey) as iso_code, concat('CN-', n_nationkey) as iso_3166_2
from nation""",
    # views with gaps, for the queries about unmatched rows
    "known_users": "select * from user_info where id % 13 <> 0",
    "known_provinces": "select * from base_province where id <> 24",
    "arrived_orders": "select * from order_info where id % 50 <> 0",
    "all_orders": """
select o_orderkey as id, c_nationkey as province_id, o_orderstatus as order_status,
       o_custkey as user_id, o_totalprice as total_amount,
       o_orderdate + to_seconds(o_orderkey * 7919 % 86400) as created,
       o_orderdate + to_seconds(o_orderkey * 7919 % 86400 + o_orderkey * 104729 % 1500) as arr
from orders join customer on c_custkey = o_custkey""",
    "order_info": """
select *, strftime(created, '%Y-%m-%d %H:%M:%S') as create_time,
       strftime(created, '%Y-%m-%d') as create_date, strftime(created, '%H') as create_hour
from all_orders""",
    "order_detail": """
select d.id, d.order_id, d.sku_id, p_name as sku_name, p_retailprice as order_price,
       d.sku_num, d.split_total_amount,
       a.created + to_seconds(d.id * 7919 % 1500) as arr,
       strftime(a.created + to_seconds(60), '%Y-%m-%d %H:%M:%S') as create_time
from (select l_orderkey * 1000 + row_number() over (partition by l_orderkey
               order by l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice,
                        l_discount, l_tax, l_returnflag, l_linestatus) as id,
             l_orderkey as order_id, l_partkey as sku_id,
             cast(l_quantity as bigint) as sku_num, l_extendedprice as split_total_amount
      from lineitem) d
join part on p_partkey = d.sku_id
join all_orders a on a.id = d.order_id""",
    # derived steps shared by several queries
    "first_visit": """
select * from app_log where has_page and coalesce(last_page_id, '') = ''""",
    "dau": """
select * from (select *, row_number() over (partition by dt, mid order by ts_ms, event_id) as rn
               from first_visit) where rn = 1""",
    "order_dim": """
select o.*,
       coalesce(cast(trunc(datediff('day', cast(u.birthday as date),
                                    cast(substr(o.create_time, 1, 10) as date)) / 365) as int), 0) as user_age,
       u.gender as user_gender,
       p.name as province_name, p.area_code as province_area_code,
       p.iso_3166_2 as province_3166_2_code, p.iso_code as province_iso_code
from order_info o
left join user_info u on u.id = o.user_id
left join base_province p on p.id = o.province_id""",
    "order_wide": """
select d.id as detail_id, d.order_id, d.sku_id, d.order_price, d.sku_num, d.sku_name,
       d.split_total_amount, cast(0 as double) as split_activity_amount,
       cast(0 as double) as split_coupon_amount,
       cast(o.province_id as bigint) as province_id, o.order_status, o.user_id, o.total_amount,
       cast(0 as double) as activity_reduce_amount, cast(0 as double) as coupon_reduce_amount,
       cast(0 as double) as original_total_amount, cast(0 as double) as feight_fee,
       cast(0 as double) as feight_fee_reduce,
       cast(null as varchar) as expire_time, cast(null as varchar) as refundable_time,
       d.create_time, cast(null as varchar) as operate_time, o.create_date, o.create_hour,
       o.province_name, o.province_area_code, o.province_3166_2_code, o.province_iso_code,
       o.user_age, o.user_gender
from order_detail d join order_dim o on o.id = d.order_id""",
}

_ORDER = ["app_log", "user_info", "base_province", "all_orders", "order_info",
          "known_users", "known_provinces", "arrived_orders", "order_detail", "first_visit", "dau", "order_dim", "order_wide"]


def with_views(body: str, extra: dict | None = None) -> str:
    """Prefix a query with every base view (DuckDB skips unused CTEs)."""
    ctes = [f"{name} as ({VIEWS[name].strip()})" for name in _ORDER]
    for name, sql in (extra or {}).items():
        ctes.append(f"{name} as ({sql.strip()})")
    return "with " + ",\n".join(ctes) + "\n" + body.strip()


# ------------------------------------------------------------------ queries
_Q: dict[str, str] = {}


def q(name: str, body: str, extra: dict | None = None) -> None:
    _Q[name] = with_views(body, extra)


# --- logs and daily actives
q("log_parse", """
select event_id, mid, uid, ar, ch, vc,
       case when has_page then last_page_id end as last_page_id, dt, hr
from app_log""")

q("log_quarantine", """
select count(*) filter (where event_id % 97 <> 0) as n_ok,
       count(*) filter (where event_id % 97 = 0) as n_bad
from app_log""")

q("first_visits", "select event_id, mid, dt, hr from first_visit")

q("dau_dedup", "select dt, mid, hr, event_id from dau")

# one record in seven arrives up to four days late; a silence of a day ends the set
_LIVES = {
    "touched": "select *, ts + to_days(cast(case when event_id % 7 = 0 then event_id % 5 else 0 end as int)) as arr from first_visit",
    "gaps": "select *, arr - lag(arr) over (partition by dt order by arr, event_id) as gap from touched",
    "lives": "select *, sum(case when gap < interval 1 day then 0 else 1 end) over "
             "(partition by dt order by arr, event_id rows unbounded preceding) as life from gaps",
}
_EXPIRING = """
select dt, cast(life as bigint) as life, mid, hr, event_id from lives
qualify row_number() over (partition by dt, life, mid order by arr, event_id) = 1"""
q("dau_expiring", _EXPIRING, _LIVES)
q("dau_expiring_stream", _EXPIRING, _LIVES)

q("dau_info", "select mid, uid, ar, ch, vc, dt, hr, ts_ms as ts from dau")

q("dau_total", "select dt, count(*) as dau from dau group by dt")

q("dau_hour", "select dt, hr, count(*) as ct from dau group by dt, hr")

q("dau_hour_compare", """
select g.dt, g.hr, coalesce(t.ct, 0) as today, coalesce(y.ct, 0) as yesterday
from grid g
left join c t on t.dt = g.dt and t.hr = g.hr
left join c y on y.dt = strftime(cast(g.dt as date) - interval 1 day, '%Y-%m-%d') and y.hr = g.hr""",
  {"c": "select dt, hr, count(*) as ct from dau group by dt, hr",
   "grid": "select dt, lpad(cast(h as varchar), 2, '0') as hr "
           "from (select distinct dt from c) d, range(0, 24) t(h)"})

q("new_devices", """
select dt, count(*) as new_mid from (select mid, min(dt) as dt from dau group by mid) f
group by dt""")


# --- change data and snapshots
q("dim_snapshot", "select id, birthday, gender from user_info")

q("snapshot_to_envelope", """
select 'user_info' as "table", 'INSERT' as type, cast(floor(id / 500) as bigint) as chunk,
       count(*) as n_rows, cast(sum(id) as bigint) as id_sum, min(name) as first_name from user_info group by 3
union all
select 'base_province', 'INSERT', cast(floor(id / 500) as bigint), count(*), cast(sum(id) as bigint), min(name)
from base_province group by 3
union all
select 'sku_info', 'INSERT', cast(floor(p_partkey / 500) as bigint), count(*), cast(sum(p_partkey) as bigint), min(p_name)
from part group by 3""")

def _agg(table: str, typ: str, source: str, where: str = "true", name: str = "cast(null as varchar)", id_: str = "id") -> str:
    return (f"select '{table}' as tbl, '{typ}' as typ, count(*) as n, cast(sum({id_}) as bigint) as id_sum, "
            f"min({name}) as first_name from {source} where {where}")


q("cdc_explode", "select * from (" + " union all ".join([
    _agg("order_info", "INSERT", "order_info"), _agg("order_info", "UPDATE", "order_info", "id % 10 = 0"),
    _agg("order_info", "DELETE", "order_info", "id % 100 = 0"), _agg("order_info", "CREATE", "order_info", "id % 70 = 0"),
    _agg("order_detail", "INSERT", "order_detail"), _agg("user_info", "INSERT", "user_info", name="name"),
    _agg("user_info", "UPDATE", "user_info", "id % 5 = 0", "name || '*'"),
    _agg("user_info", "DELETE", "user_info", "id % 25 = 0", "name || '*'"),
    _agg("base_province", "INSERT", "base_province", name="name"),
    _agg("sku_info", "INSERT", "part", name="p_name", id_="p_partkey")]) + ") c where n > 0")


def _routed(topic: str, source: str, where: str = "true") -> str:
    return (f"select '{topic}' as topic, count(*) as n, cast(sum(id) as bigint) as id_sum, min(create_time) as first_time, "
            f"max(create_time) as last_time from {source} where {where}")


q("cdc_route_facts", "select * from (" + " union all ".join([
    _routed("DWD_ORDER_INFO_I", "order_info"), _routed("DWD_ORDER_INFO_U", "order_info", "id % 10 = 0"),
    _routed("DWD_ORDER_INFO_D", "order_info", "id % 100 = 0"), _routed("DWD_ORDER_DETAIL_I", "order_detail")])
  + ") c where n > 0")

q("cdc_quarantine", """
select count(*) filter (where seq % 97 <> 0) as n_ok, count(*) filter (where seq % 97 = 0) as n_bad
from (select id * 10 + 1 as seq from order_info
      union all select id * 10 + 2 from order_info where id % 10 = 0
      union all select id * 10 + 3 from order_info where id % 100 = 0
      union all select id * 10 + 4 from order_info where id % 70 = 0
      union all select distinct id // 100 * 10 + 5 from order_detail
      union all select id * 10 + 1 from user_info
      union all select id * 10 + 2 from user_info where id % 5 = 0
      union all select id * 10 + 3 from user_info where id % 25 = 0
      union all select 6
      union all select distinct p_partkey // 100 * 10 + 7 from part) s""")

q("order_quarantine", """
select 'order' as topic, count(*) filter (where id % 97 > 2) as n_ok, count(*) filter (where id % 97 <= 2) as n_bad
from order_info
union all
select 'line', count(*) filter (where id % 97 > 2), count(*) filter (where id % 97 <= 2) from order_detail""")

q("dim_latest", """
select 'DIM:USER_INFO:' || id as key, id,
       case when id % 5 = 0 then name || '*' else name end as name from user_info
union all select 'DIM:BASE_PROVINCE:' || id, id, name from base_province
union all select 'DIM:SKU_INFO:' || p_partkey, p_partkey, p_name from part""")

# --- orders
q("order_info_parse", """
select id, cast(province_id as bigint) as province_id, order_status, user_id, total_amount,
       cast(0 as double) as activity_reduce_amount, cast(0 as double) as coupon_reduce_amount,
       cast(0 as double) as original_total_amount, cast(0 as double) as feight_fee,
       cast(0 as double) as feight_fee_reduce, cast(null as varchar) as expire_time,
       cast(null as varchar) as refundable_time, create_time, cast(null as varchar) as operate_time,
       create_date, create_hour
from order_info""")

q("order_detail_parse", """
select id, order_id, sku_id, order_price, sku_num, sku_name, create_time, split_total_amount,
       cast(0 as double) as split_activity_amount, cast(0 as double) as split_coupon_amount
from order_detail""")

q("order_dim_join", """
select id, user_age, user_gender, province_name, province_area_code, province_iso_code,
       province_3166_2_code
from order_gap""", {"order_gap": VIEWS["order_dim"].replace("join user_info", "join known_users")
                    .replace("join base_province", "join known_provinces")})

q("order_inner", """
select o.id as order_id, d.id as detail_id, 'both' as side
from order_info o join order_detail d on o.id = d.order_id""")

q("order_full_outer", """
select coalesce(o.id, d.order_id) as order_id, d.id as detail_id,
       case when o.id is null then 'detail_only' when d.id is null then 'order_only'
            else 'both' end as side
from arrived_orders o full outer join order_detail d on o.id = d.order_id""")

q("order_wide", "select * from order_wide")

q("order_wide_interval", """
select d.id as detail_id, d.order_id
from order_detail d join order_info o on o.id = d.order_id
where d.arr > o.arr - interval 600 second and d.arr < o.arr + interval 600 second""")

_TTL_EXTRA = {
    "j": "select d.id, d.order_id, d.arr, o.arr as to_ "
         "from order_detail d join order_info o on o.id = d.order_id",
    "bef": "select *, coalesce(lead(arr) over (partition by order_id order by arr, id), to_) - arr "
           "as gap from j where arr < to_",
    "bef2": "select *, max(gap) over (partition by order_id order by arr desc, id desc "
            "rows between unbounded preceding and current row) as mg from bef",
}
q("order_wide_ttl", """
select id as detail_id, order_id from j where arr >= to_ and arr - to_ < interval 600 second
union all
select id as detail_id, order_id from bef2 where mg < interval 600 second""", _TTL_EXTRA)

_TTL_IDS = """select id as detail_id from j where arr >= to_ and arr - to_ < interval 600 second
union all
select id from bef2 where mg < interval 600 second"""

q("order_wide_ttl_stream", f"select * from order_wide where detail_id in ({_TTL_IDS})", _TTL_EXTRA)

# lines reach the topic with the first line of their envelope
q("cdc_to_wide", f"select * from order_wide where detail_id in ({_TTL_IDS})",
  _TTL_EXTRA | {"j": "select d.id, d.order_id, min(d.arr) over (partition by d.id // 100) as arr, o.arr as to_ "
                     "from order_detail d join order_info o on o.id = d.order_id"})

_INTERVAL_AUDIT = """
select 'order' as kind, o.id from arrived_orders o where not exists (
  select 1 from order_detail d where d.order_id = o.id
  and d.arr > o.arr - interval 600 second and d.arr < o.arr + interval 600 second)
union all
select 'line', d.id from order_detail d where not exists (
  select 1 from arrived_orders o where d.order_id = o.id
  and d.arr > o.arr - interval 600 second and d.arr < o.arr + interval 600 second)"""

q("orphans_interval", _INTERVAL_AUDIT)
q("orphans_stream", _INTERVAL_AUDIT)

q("orphan_details", """
select d.id from order_detail d where not exists (select 1 from arrived_orders o where o.id = d.order_id)""")

q("orphan_orders", """
select o.id from order_info o where not exists (select 1 from order_detail d where d.order_id = o.id)""")

# --- search and sales
_TOK = ("list_filter(regexp_split_to_array(regexp_replace(lower(coalesce({x}, '')), '(\\p{{Han}})', ' \\1 ', 'g'), "
        "'[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')")


def tok(x: str) -> str:
    return _TOK.format(x=x)


_CATALOG = {"catalog": f"""
select p_partkey as id, p_name as name, p_retailprice as score, p_brand, p_type,
       date '1992-01-01' + cast(p_partkey % 2500 as int) as released, {tok('p_name')} as tok
from part"""}

q("search_match_all", f"""
select detail_id, sku_name from (select *, {tok('sku_name')} as tok from order_wide) w
where list_contains(tok, 'red') and list_contains(tok, 'widget')""")

q("search_match_any", f"""
select detail_id, sku_name from (select *, {tok('sku_name')} as tok from order_wide) w
where list_contains(tok, 'red') or list_contains(tok, 'widget')""")

q("search_bool_filter", """
select id, name from catalog
where list_contains(tok, 'red') and list_contains([p_brand, p_type], 'Brand#17')""", _CATALOG)

q("search_sorted_top", """
select id, name, score from catalog where list_contains(tok, 'red')
order by score desc, id limit 20""", _CATALOG)

q("search_highlight", r"""
select id, regexp_replace(name, '(?i)\b(red|widget)\b', '<em>\1</em>', 'g') as highlight
from catalog where list_contains(tok, 'red') or list_contains(tok, 'widget')""", _CATALOG)

q("search_combined", r"""
select id, name, score, regexp_replace(name, '(?i)\b(red)\b', '<em>\1</em>', 'g') as highlight
from catalog
where list_contains(tok, 'red') and list_contains([p_brand, p_type], 'Brand#17')
order by score desc, id limit 20""", _CATALOG)

q("search_documents", f"""
select doc_id, cast(len(hits) as bigint) as n_hits
from (select doc_id, list_filter({tok('text')}, lambda t: t in ('nicht', 'été', 'red', 'идти')) as hits from documents) d
where len(hits) > 0""")

_RANKED = """
select doc_id, round(score, 4) as bm25 from (
  select doc_id,
         ln(1 + (n - df0 + 0.5) / (df0 + 0.5)) * tf0 / (tf0 + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))
       + ln(1 + (n - df1 + 0.5) / (df1 + 0.5)) * tf1 / (tf1 + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))
       + ln(1 + (n - df2 + 0.5) / (df2 + 0.5)) * tf2 / (tf2 + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))
         as score
  from p, s where tf0 + tf1 + tf2 > 0) x
order by score desc, doc_id limit 20"""
_RANKED_VIEWS = {
    "d": f"select doc_id, {tok('text')} as tok from documents",
    "p": "select doc_id, len(tok) as dl, len(list_filter(tok, lambda t: t = 'the')) as tf0, "
         "len(list_filter(tok, lambda t: t = 'of')) as tf1, len(list_filter(tok, lambda t: t = 'and')) as tf2 "
         "from d",
    "s": "select count(*) as n, avg(dl) as avgdl, count(*) filter (where tf0 > 0) as df0, "
         "count(*) filter (where tf1 > 0) as df1, count(*) filter (where tf2 > 0) as df2 from p"}

q("search_ranked", _RANKED, _RANKED_VIEWS)
q("search_indexed_ranked", _RANKED, _RANKED_VIEWS)

_DOCS = {"d": f"select doc_id, {tok('text')} as tok from documents"}

q("search_indexed_all", """
select doc_id, cast(len(list_filter(tok, lambda t: t in ('the', 'of'))) as bigint) as n_hits
from d where list_contains(tok, 'the') and list_contains(tok, 'of')""", _DOCS)

q("search_indexed_any", """
select doc_id, cast(len(list_distinct(hits)) as bigint) as n_terms, cast(len(hits) as bigint) as n_hits
from (select doc_id, list_filter(tok, lambda t: t in ('nicht', 'été', 'red', 'идти')) as hits from d) h
where len(hits) > 0""", _DOCS)

q("search_indexed_phrase", """
select doc_id, cast(n as bigint) as n_hits
from (select doc_id, len(list_filter(range(1, len(tok)), lambda i: tok[i] = 'of' and tok[i + 1] = 'the')) as n from d) h
where n > 0""", _DOCS)

q("select_scalar_columns", """
select id, name, score, date_diff('day', date '1970-01-01', released) * 86400000 as released
from catalog""", _CATALOG)

_SALE = {"m": f"select * from order_wide where list_contains({tok('sku_name')}, 'red')",
         "ages": "select user_age, count(*) as ct from m group by user_age "
                 "order by ct desc, user_age limit 100",
         "genders": "select user_gender, count(*) as ct from m where user_gender is not null "
                    "group by user_gender order by ct desc, user_gender limit 2",
         "tot": "select count(*) as n from m"}


def _pct(expr: str) -> str:
    return (f"floor(cast(coalesce({expr}, 0) as double) * 1000 / (select n from tot) + 0.5) / 10")


q("sale_total", "select count(*) as total from m", _SALE)

q("sale_page", """
select detail_id, order_id, sku_name, sku_num, order_price, user_age, user_gender, province_name,
       create_date, create_time
from m order by detail_id limit 20 offset 20""", _SALE)

q("sale_age_terms", "select * from ages", _SALE)

q("sale_gender_terms", "select * from genders", _SALE)

q("sale_age_share", f"""
select 'under 20' as name, {_pct('(select count(*) from m where user_age < 20)')} as value
union all
select '20 to 29', {_pct('(select count(*) from m where user_age >= 20 and user_age < 30)')}
union all
select '30 and over', {_pct('(select count(*) from m where user_age >= 30)')}""", _SALE)

q("sale_gender_share", f"""
select 'male' as name, {_pct("(select count(*) from m where user_gender = 'M')")} as value
union all
select 'female', {_pct("(select count(*) from m where user_gender = 'F')")}""", _SALE)

q("sale_stat_json", f"""
select 'total' as part, '' as name, cast(count(*) as double) as value from m
union all select 'gender share', 'male', {_pct("(select count(*) from m where user_gender = 'M')")}
union all select 'gender share', 'female', {_pct("(select count(*) from m where user_gender = 'F')")}
union all select 'age share', 'under 20', {_pct('(select count(*) from m where user_age < 20)')}
union all select 'age share', '20 to 29', {_pct('(select count(*) from m where user_age >= 20 and user_age < 30)')}
union all select 'age share', '30 and over', {_pct('(select count(*) from m where user_age >= 30)')}
union all
select 'detail', cast(detail_id as varchar), cast(sku_num as double)
from (select detail_id, sku_num from m order by detail_id limit 20 offset 20) p""", _SALE)

q("province_sales", """
select province_name, cast(sum(sku_num) as bigint) as sku_num,
       cast(least(floor(sum(sku_num) / 20000), 5) as int) as bin
from order_wide where province_name is not null group by province_name""")


# --- sinks and streaming
q("src_topic_replay", """
select case when has_page then event_type end as page_id, count(*) as n
from app_log group by 1""")

q("dau_dedup_stream", "select dt, mid, hr, event_id from dau")

q("order_wide_stream", """
select * from order_wide where detail_id in (
  select d.id from order_detail d join order_info o on o.id = d.order_id
  where d.arr > o.arr - interval 600 second and d.arr < o.arr + interval 600 second)""")

q("batch_progress", """
select event_id // w as batch_id, count(*) as n_rows, min(event_id) as from_offset, max(event_id) + 1 as until_offset
from events, (select max(event_id) // 4 + 1 as w from events) x group by 1""")

# the last day of the log, and the day after it
_DAYS = {"days": "select max(dt) as d, strftime(cast(max(dt) as date) + interval 1 day, '%Y-%m-%d') as e from app_log",
         "firsts": "select mid, min(dt) as dt from dau group by mid"}
q("realtime_total", """
select 'last' as day, 'dau' as id, (select count(*) from dau, days where dt = d) as value
union all select 'last', 'new_mid', (select count(*) from firsts, days where dt = d)
union all select 'after', 'dau', 0
union all select 'after', 'new_mid', 0""", _DAYS)

q("realtime_hour", """
select g.dt, g.hr, (select count(*) from dau where dau.dt = g.dt and dau.hr = g.hr) as today,
       (select count(*) from dau where dau.dt = strftime(cast(g.dt as date) - interval 1 day, '%Y-%m-%d') and dau.hr = g.hr)
         as yesterday
from (select t.dt, lpad(cast(h as varchar), 2, '0') as hr
      from (select d as dt from days union all select e from days) t, range(0, 24) r(h)) g""", _DAYS)

q("cdc_split_stream", """
select 'DIM:USER_INFO:' || id as key, id,
       case when id % 5 = 0 then name || '*' else name end as name from user_info
union all select 'DIM:BASE_PROVINCE:' || id, id, name from base_province
union all select 'DIM:SKU_INFO:' || p_partkey, p_partkey, p_name from part""")

q("dau_daily_partition", "select dt, count(*) as n from dau group by dt")

q("upsert_latest", """
select id, case when id % 7 = 0 then 'b2' else 'b' || (id % 3) end as value from order_detail""")

q("append_docs", "select 2 * count(*) as n from order_detail")


def oracle_sql() -> dict[str, str]:
    return dict(_Q)
