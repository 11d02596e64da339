"""Registered queries of this package, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm import (alignment, collocations, decontaminate, exact_topk, language, licenses, line_dedup, near_dup, packing, quality,
                            repeats, token_counts, wavelet)
from shopstream.llm.common import new_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@query("op1_fuzzy_lines")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc.doc_id", F.col("kept").alias("text"), "n_lines", "n_removed")


@query("op2_repeated_spans")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_digests(repeats.remove_repeats(table(spark, sf_dir, "documents"), length=400, keep_first=False))


@query("op3_exact_topk", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s
)
SELECT query_id, CAST(n AS INTEGER) AS "rank", vec_id, score FROM r WHERE n <= 20
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), k=20, every=20)


@query("op4_wavelet_tokens")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "wavelet")
    wavelet.write_shards(table(spark, sf_dir, "documents"), path, end_id=2)
    return wavelet.read_documents(wavelet.read_shards(spark, path), with_ids=False)


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), limit=512)


@query("op7_harmonic_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(packing.pack(table(spark, sf_dir, "documents"), capacity=1024, end_id=0))


@query("op6_prefix_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.contamination_digests(found)


@query("op9_quality_attention")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_digests(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query("op10_license_index")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_digests(licenses.scan(table(spark, sf_dir, "documents")))


@query("op8_prob_minhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op11_pointer_alignment")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents")).withColumnRenamed("groups", "groups_sha256")


@query("op12_language_bayes")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_digests(table(spark, sf_dir, "documents"))


@query("op13_rollup_collocations", r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces
), places AS (
  SELECT lang, unnest(w) AS w1, unnest(w[2:] || ['']) AS w2, unnest(w[3:] || ['', '']) AS w3, unnest(w[4:] || ['', '', '']) AS w4
  FROM split WHERE len(w) > 0
), windows AS (
  SELECT lang, w1, w2, w3, w4, count(*) AS f FROM places GROUP BY ALL
), grams AS MATERIALIZED (
  SELECT lang, 1 AS k, w1 AS phrase, sum(f) AS f FROM windows WHERE w1 <> '' GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, sum(f) FROM windows WHERE w2 <> '' GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, sum(f) FROM windows WHERE w3 <> '' GROUP BY ALL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, sum(f) FROM windows WHERE w4 <> '' GROUP BY ALL
), total AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM grams WHERE k = 1 GROUP BY lang
), c AS MATERIALIZED (
  SELECT lang, phrase, k AS words, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 30
), parts AS MATERIALIZED (
  SELECT lang, phrase, a, w, unnest(range(1, words)) AS k FROM c
), named AS MATERIALIZED (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y FROM parts
), cuts AS MATERIALIZED (
  SELECT n.lang, n.phrase, CAST(n.a AS BIGINT) AS a, n.k, CAST(g.f AS BIGINT) AS l, CAST(h.f AS BIGINT) AS r,
         CAST((2000000::HUGEINT * n.a) // (g.f::HUGEINT + h.f) AS BIGINT) AS score
  FROM named n JOIN grams g ON g.lang = n.lang AND g.phrase = n.x JOIN grams h ON h.lang = n.lang AND h.phrase = n.y
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT c.lang, array_to_string(c.w[s.i:s.i + s.k - 1], ' ') AS phrase, max(c.a) AS most
  FROM c JOIN (VALUES (1, 2), (2, 2), (3, 2), (1, 3), (2, 3)) AS s(i, k) ON s.k < c.words AND s.i + s.k - 1 <= c.words GROUP BY ALL
), kept AS (
  SELECT s.* FROM scored s LEFT JOIN inside i USING (lang, phrase) WHERE i.most IS NULL OR 100::HUGEINT * i.most < 80::HUGEINT * s.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS n_th FROM kept
)
SELECT r.lang, n_th AS "rank", phrase, a, l, r.r, t.n, score, CAST(k AS BIGINT) AS k FROM ranked r JOIN total t USING (lang) WHERE n_th <= 2000
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), top=2000, least=30)
