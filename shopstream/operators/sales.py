"""Sales analytics over the order-wide table.

The reference answers one request with a keyword search on the wide table
plus two terms aggregations; here each part is its own DataFrame over the
same match set.  ``date=None`` means the whole table (all days).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.functions.numeric import percent_one_decimal
from shopstream.operators import search as S

# Group caps of the two terms aggregations (ages, genders).
AGE_TERMS = 100
GENDER_TERMS = 2
# Age bands (<20, 20-29, >=30) and gender codes.
AGE_BANDS = [("under 20", None, 20), ("20 to 29", 20, 30), ("30 and over", 30, None)]
GENDERS = [("male", "M"), ("female", "F")]
TITLE_GENDER = "gender share"
TITLE_AGE = "age share"

PAGE_COLUMNS = ["detail_id", "order_id", "sku_name", "sku_num", "order_price",
                "user_age", "user_gender", "province_name", "create_date", "create_time"]


def match_set(wide: DataFrame, keyword: str, date: str | None = None) -> DataFrame:
    """Rows of one day (or all days) whose ``sku_name`` holds every token."""
    w = wide if date is None else wide.where(F.col("create_date") == date)
    return S.match_all(w, "sku_name", keyword)


def _cells(m: DataFrame) -> DataFrame:
    """Hits per ``(user_age, user_gender)``: the one aggregate every count of
    the request derives from (combined map-side, at most ages x 3 rows).
    Derived frames share its exchange, so the match set is read once."""
    return m.groupBy("user_age", "user_gender").agg(F.count(F.lit(1)).alias("ct"))


def total(m: DataFrame) -> DataFrame:
    """Hit count, independent of paging (A10)."""
    return _cells(m).agg(F.coalesce(F.sum("ct"), F.lit(0)).cast("bigint").alias("total"))


def sale_page(m: DataFrame, page_no: int, size: int) -> DataFrame:
    """One page of hits in ``detail_id`` order (L1; the reference leaves the
    order to relevance, which ties on equal names — a unique order is used)."""
    return S.page(m.select(*PAGE_COLUMNS), page_no, size, [F.col("detail_id").asc()])


def age_terms(m: DataFrame, size: int = AGE_TERMS) -> DataFrame:
    """Count per age, top ``size`` by count then age (A5)."""
    return (_cells(m).groupBy("user_age").agg(F.sum("ct").cast("bigint").alias("ct"))
            .orderBy(F.col("ct").desc(), F.col("user_age").asc()).limit(size))


def gender_terms(m: DataFrame, size: int = GENDER_TERMS) -> DataFrame:
    """Count per gender, top ``size``; rows without gender are in no group."""
    return (_cells(m).where(F.col("user_gender").isNotNull())
            .groupBy("user_gender").agg(F.sum("ct").cast("bigint").alias("ct"))
            .orderBy(F.col("ct").desc(), F.col("user_gender").asc()).limit(size))


def _total_scalar(m: DataFrame):
    return total(m).scalar()


def age_share(m: DataFrame) -> DataFrame:
    """Age bands as percent of all hits (A7, A8, P17), from the full counts.

    Unknown users carry age 0 and land in the first band (parity)."""
    tot = _total_scalar(m)
    terms = _cells(m)
    sums = []
    for name, lo, hi in AGE_BANDS:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("user_age") >= lo)
        if hi is not None:
            cond = cond & (F.col("user_age") < hi)
        sums.append(F.coalesce(F.sum(F.when(cond, F.col("ct"))), F.lit(0)).alias(name))
    row = terms.agg(*sums)
    pairs = [F.struct(F.lit(name).alias("name"), percent_one_decimal(F.col(f"`{name}`"), tot)
                      .alias("value")) for name, _, _ in AGE_BANDS]
    return row.select(F.explode(F.array(*pairs)).alias("o")).select("o.name", "o.value")


def gender_share(m: DataFrame) -> DataFrame:
    """Male and female shares of all hits; an absent gender gives 0.0.
    Shares need not sum to 100: hits without gender count in the total."""
    tot = _total_scalar(m)
    terms = _cells(m)
    sums = [F.coalesce(F.sum(F.when(F.col("user_gender") == code, F.col("ct"))), F.lit(0))
            .alias(name) for name, code in GENDERS]
    row = terms.agg(*sums)
    pairs = [F.struct(F.lit(name).alias("name"), percent_one_decimal(F.col(name), tot)
                      .alias("value")) for name, _ in GENDERS]
    return row.select(F.explode(F.array(*pairs)).alias("o")).select("o.name", "o.value")


def stat_json(m: DataFrame, page_no: int = 1, size: int = 20) -> DataFrame:
    """``{total, stat:[{options:[{name,value}], title}], detail:[rows]}`` as
    one JSON text (A11).  Lists are built only from already-reduced frames:
    five share rows and one page of hits."""
    tot = _total_scalar(m)
    g = gender_share(m).agg(F.collect_list(F.struct("name", "value")).alias("options"))
    a = age_share(m).agg(F.collect_list(F.struct("name", "value")).alias("options"))
    stat = F.array(F.struct(g.select("options").scalar().alias("options"),
                            F.lit(TITLE_GENDER).alias("title")),
                   F.struct(a.select("options").scalar().alias("options"),
                            F.lit(TITLE_AGE).alias("title")))
    detail = sale_page(m, page_no, size).agg(
        F.collect_list(F.struct(*PAGE_COLUMNS)).alias("detail"))
    return detail.select(F.to_json(F.struct(tot.alias("total"), stat.alias("stat"),
                                            F.col("detail"))).alias("json"))


def province_sales(wide: DataFrame, bin_width: int, n_bins: int = 6,
                   date: str | None = None) -> DataFrame:
    """Units sold per province and a legend bin ``floor(units / width)``
    capped at ``n_bins - 1`` (A13; the reference leaves this a stub)."""
    w = wide if date is None else wide.where(F.col("create_date") == date)
    g = (w.where(F.col("province_name").isNotNull())
         .groupBy("province_name").agg(F.sum("sku_num").alias("sku_num")))
    return g.select("province_name", "sku_num",
                    F.least(F.floor(F.col("sku_num") / bin_width),
                            F.lit(n_bins - 1)).cast("int").alias("bin"))
