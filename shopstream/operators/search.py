"""Search over text columns: tokenised match, nested term filter, sorted
top-k, highlighting, paging and BM25 ranking (F5-F7, L1-L4).

Matching runs as built-in array expressions on a token column computed once
per row from the whole text.  Ranking needs corpus statistics (document
count, mean length, document frequencies); they come from one global
aggregate used as a scalar subquery, or are observed as metrics of the one
pass that stages the candidate documents.  No side is broadcast or
cross-joined.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shopstream.functions import text as X

# BM25 parameters of the common search-engine default.
BM25_K1 = 1.2
BM25_B = 0.75


def match_all(df: DataFrame, text_col: str, keyword: str) -> DataFrame:
    """Rows whose text holds every keyword token (F5); empty keyword -> none."""
    t = X.tokens(F.coalesce(F.col(text_col), F.lit("")))
    return df.where(X.match_all(t, keyword))


def match_any(df: DataFrame, text_col: str, keyword: str) -> DataFrame:
    """Rows whose text holds at least one keyword token."""
    t = X.tokens(F.coalesce(F.col(text_col), F.lit("")))
    return df.where(X.match_any(t, keyword))


def bool_filter(df: DataFrame, text_col: str, keyword: str, array_col: str,
                field: str, value: str) -> DataFrame:
    """``must`` match on a text column AND a non-scoring exact ``filter`` on a
    field inside an array of structs (F7)."""
    has = F.exists(F.col(array_col), lambda e: e.getField(field) == F.lit(value))
    return match_any(df, text_col, keyword).where(has)


def sorted_top(df: DataFrame, sort_col: str, k: int = 20, tie_col: str = "id",
               offset: int = 0) -> DataFrame:
    """Sort by a numeric column descending, unique tie-break, page of ``k``
    rows after ``offset`` (L2, L1); planned as TakeOrderedAndProject."""
    o = df.orderBy(F.col(sort_col).desc(), F.col(tie_col).asc())
    if offset:
        o = o.offset(offset)
    return o.limit(k)


def page(df: DataFrame, page_no: int, size: int, order_cols) -> DataFrame:
    """Page ``page_no`` (1-based) of ``size`` rows: ``from = (page-1)*size``
    (L1).  The order must be unique for pages to be stable."""
    o = df.orderBy(*order_cols)
    start = max(page_no - 1, 0) * size
    if start:
        o = o.offset(start)
    return o.limit(size)


def highlight(df: DataFrame, text_col: str, keyword: str, out: str = "highlight",
              pre: str = "<em>", post: str = "</em>") -> DataFrame:
    """Add ``out``: the text with matched tokens wrapped in tags (L4)."""
    return df.withColumn(out, X.highlight(F.col(text_col), keyword, pre, post))


def bm25_scores(docs: DataFrame, id_col: str, text_col: str, keyword: str,
                k1: float = BM25_K1, b: float = BM25_B,
                stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """BM25 score of every document holding at least one query token (L3).

    ``idf = ln(1 + (N - df + 0.5) / (df + 0.5))`` and per token
    ``idf * tf / (tf + k1 * (1 - b + b * dl / avgdl))``; ``dl`` counts all
    tokens of the whole text.

    Without ``stage`` the corpus statistics are one scalar subquery, so the
    texts are tokenised twice (statistics, then scores).  With ``stage`` (a
    function that writes a frame to shared storage and reads it back) the
    texts are tokenised once: the statistics are observed as metrics of the
    pass that stages ``(id, dl, tf...)`` of the matching documents, and only
    those few numbers reach the driver.  The metrics are gathered in the
    writing action's own stage, so a retried task is counted once."""
    kw = docs.sparkSession.range(1).select(X.keyword_tokens(keyword).alias("kw")).first().kw
    t = X.tokens(F.coalesce(F.col(text_col), F.lit("")))
    per = docs.select(F.col(id_col), t.alias("tok")).select(
        id_col, F.size("tok").alias("dl"),
        *[X.count_token(F.col("tok"), w).alias(f"tf{i}") for i, w in enumerate(kw)])
    metrics = [F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"),
               *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(kw))]]
    any_tf = F.lit(False)
    for i in range(len(kw)):
        any_tf = any_tf | (F.col(f"tf{i}") > 0)
    if stage is None:
        stats = per.agg(F.struct(*metrics)).scalar()
        field = stats.getField
        cand = per.where(any_tf)
    else:
        obs = Observation("bm25_corpus")
        cand = stage(per.observe(obs, *metrics).where(any_tf))
        values = obs.get

        def field(name):
            return F.lit(values[name])
    n, avgdl = field("n"), field("avgdl")
    norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("dl") / avgdl)
    score = F.lit(0.0)
    for i in range(len(kw)):
        df_i = field(f"df{i}")
        idf = F.log(F.lit(1.0) + (n - df_i + F.lit(0.5)) / (df_i + F.lit(0.5)))
        tf = F.col(f"tf{i}")
        score = score + idf * tf / (tf + norm)
    return cand.select(id_col, score.alias("score"))


def ranked(docs: DataFrame, id_col: str, text_col: str, keyword: str, k: int = 20,
           stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Top ``k`` documents by BM25, ties by id."""
    s = bm25_scores(docs, id_col, text_col, keyword, stage=stage)
    return s.orderBy(F.col("score").desc(), F.col(id_col).asc()).limit(k)


def bool_search(df: DataFrame, text_col: str, keyword: str, array_col: str, field: str,
                value: str, sort_col: str, k: int = 20, tie_col: str = "id",
                offset: int = 0) -> DataFrame:
    """One search request: ``must`` match on the text, non-scoring term
    ``filter`` inside an array of structs, highlight of the text, sorted by
    a numeric column descending, page ``offset``/``k`` (F7 + L4 + L2)."""
    hits = highlight(bool_filter(df, text_col, keyword, array_col, field, value),
                     text_col, keyword)
    return sorted_top(hits, sort_col, k, tie_col, offset)
