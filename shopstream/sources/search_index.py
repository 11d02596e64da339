"""An inverted index over a text column, kept in Parquet tables.

Tables below the index's folder, each written per batch with dynamic
overwrite, so a replayed batch replaces just its own rows:

* ``postings`` - a row per document and term: frequency, positions and the
  document's length.  They are dealt to buckets by term, so a request lists
  only its terms' folders, and are sorted by term and block inside a file.
* ``blocks`` - a row per term, segment and block of documents (a hash range
  of ids): how many documents, the greatest frequency, the smallest length.
  They bound a block's scores for whatever the mean length is later.
* ``docs`` - id and length of each document.
* ``dead`` - versions that a later batch replaced or deleted.

``merge`` rewrites what is live into a new generation; readers take the newest
complete generation and the batches after it.  No list of documents is ever
gathered into one row, task or the driver: a posting is a row of its own, and
only the request's terms, their frequencies and the k-th score are collected.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.functions import text as X
from shopstream.operators.joins import broadcast_if_bounded
from shopstream.operators.search import BM25_B, BM25_K1
from shopstream.sources.sinks import path_exists

_GENERATIONS = "upto long, path string"
SEEDS = 16      # blocks scored first, for a threshold
DOCS_AT_ONCE = 500      # documents whose words are sorted together in a task


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents (id, dl, tok) -> a row for each of a document's terms with
    its frequency and positions."""
    for b in (whole.slice(i, DOCS_AT_ONCE) for whole in batches for i in range(0, whole.num_rows, DOCS_AT_ONCE)):
        tok = b.column("tok")
        sizes = np.asarray(pc.list_value_length(tok))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        pos = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        words = pc.list_flatten(tok).dictionary_encode()
        code = np.asarray(words.indices)
        order = np.lexsort((code, doc))     # stable: positions stay in order
        d, c = doc[order], code[order]
        first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (c[1:] != c[:-1])][:len(d)])
        ends = np.r_[first, len(d)]
        yield pa.RecordBatch.from_arrays(
            [b.column("id").take(pa.array(d[first])), b.column("dl").take(pa.array(d[first])),
             words.dictionary.take(pa.array(c[first])), pa.array(np.diff(ends), pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pos[order], pa.int32()))],
            ["id", "dl", "term", "tf", "positions"])


class SearchIndex:
    """The index in folder ``path`` of documents with ids of type ``id_type``.

    ``buckets`` and ``blocks`` are fixed when the index is first written: the
    number of term buckets, and of blocks of documents in a segment."""

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int = 64, blocks: int = 1024):
        self.spark, self.path, self.buckets, self.n_blocks = spark, path, buckets, blocks
        self.columns = {
            "postings": f"id {id_type}, term string, block int, tf long, dl long, positions array<int>, "
                        "seg long, batch_id long, bucket int",
            "blocks": "term string, block int, n long, max_tf long, min_dl long, seg long, batch_id long, bucket int",
            "docs": f"id {id_type}, dl long, batch_id long",
            "dead": f"id {id_type}, version long, dl long, batch_id long",
        }

    # ------------------------------------------------------------- tables
    def _generation(self):
        path = f"{self.path}/generations"
        if not path_exists(self.spark, path):
            return None
        return self.spark.read.schema(_GENERATIONS).parquet(path).orderBy(F.col("upto").desc(), "path").first()

    def _folder(self, folder: str, name: str) -> DataFrame:
        schema = self.columns[name]
        if not path_exists(self.spark, f"{folder}/{name}"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{folder}/{name}")

    def _read(self, name: str) -> DataFrame:
        """The newest generation's rows and those of the batches after it."""
        gen, t = self._generation(), self._folder(self.path, name)
        if gen is None:
            return t
        return self._folder(gen.path, name).unionByName(t.where(F.col("batch_id") > gen.upto))

    def _live(self, rows: DataFrame, dead: DataFrame | None = None) -> DataFrame:
        dead = (self._read("dead") if dead is None else dead).select("id", F.col("version").alias("batch_id"))
        return rows.join(dead, ["id", "batch_id"], "left_anti")

    def _bucket(self, term) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def _store(self, df: DataFrame, folder: str, name: str, *by: str) -> None:
        if "bucket" in by:      # few files a bucket; that of a frequent term is split
            df = df.hint("rebalance", F.col("bucket")).sortWithinPartitions(*by, "term", "block")
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
         .parquet(f"{folder}/{name}"))

    @staticmethod
    def _block_rows(postings: DataFrame) -> DataFrame:
        return (postings.groupBy("bucket", "batch_id", "seg", "term", "block")
                .agg(F.count("*").alias("n"), F.max("tf").alias("max_tf"), F.min("dl").alias("min_dl")))

    # ------------------------------------------------------------ writing
    def write_batch(self, docs: DataFrame, batch_id: int, id_col: str = "id", text_col: str = "text",
                    deleted: DataFrame | None = None) -> None:
        """Index one batch of documents; a later batch's version of an id
        replaces earlier ones, and ids in ``deleted`` (column ``id_col``) go.

        Batches must come in ascending order; a batch that is repeated
        replaces itself.  Within a batch an id must stand once and not be
        deleted as well.  A null text has no tokens; rows without id are
        passed over."""
        b = F.lit(int(batch_id)).cast("long")
        d = docs.where(F.col(id_col).isNotNull()).select(
            F.col(id_col).alias("id"), X.tokens(F.coalesce(F.col(text_col), F.lit(""))).alias("tok"))
        d = d.withColumn("dl", F.size("tok").cast("long"))
        self._store(d.select("id", "dl", b.alias("batch_id")), self.path, "docs", "batch_id")
        # a document's terms are counted where it is read; only of ids that stand
        # twice all the same are words dealt out and gathered by id and term
        twice = broadcast_if_bounded(d.groupBy("id").count().where("count > 1").select("id"))
        words = d.join(twice, "id", "left_semi").select("id", "dl", F.posexplode("tok").alias("pos", "term"))
        again = (words.groupBy("id", "dl", "term")
                 .agg(F.count("*").alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions")))
        once = d.join(twice, "id", "left_anti").select("id", "dl", "tok").mapInArrow(_postings, again.schema)
        postings = (once.unionByName(again)
                    .withColumns({"block": F.pmod(F.xxhash64("id"), F.lit(self.n_blocks)).cast("int"),
                                  "bucket": self._bucket("term"), "seg": b, "batch_id": b}))
        self._store(postings, self.path, "postings", "bucket", "batch_id")
        own = self._folder(self.path, "postings").where(F.col("batch_id") == int(batch_id))
        self._store(self._block_rows(own), self.path, "blocks", "bucket", "batch_id")
        gone = d.select("id")
        if deleted is not None:
            gone = gone.unionByName(deleted.select(F.col(id_col).alias("id")))
        # a repeated batch looks only at what stood before its first run
        before = self._read("docs").where(F.col("batch_id") < int(batch_id))
        dead = self._read("dead").where(F.col("batch_id") < int(batch_id))
        old = self._live(before, dead).join(gone, "id", "left_semi")
        self._store(old.select("id", F.col("batch_id").alias("version"), "dl", b.alias("batch_id")),
                    self.path, "dead", "batch_id")

    def merge(self) -> None:
        """Write all live rows as a new generation of one segment; readers
        take it once it is complete and listed."""
        upto = self._read("docs").agg(F.max("batch_id")).first()[0]
        latest_dead = self._read("dead").agg(F.max("batch_id")).first()[0]
        upto = max((x for x in (upto, latest_dead) if x is not None), default=None)
        if upto is None:
            return
        folder = f"{self.path}/generation-{upto}-{uuid.uuid4().hex[:8]}"
        seg = F.lit(upto).cast("long")
        self._store(self._live(self._read("postings")).withColumn("seg", seg), folder, "postings", "bucket")
        rows = self._folder(folder, "postings").withColumn("batch_id", seg)
        self._store(self._block_rows(rows), folder, "blocks", "bucket")
        self._live(self._read("docs")).write.parquet(f"{folder}/docs")
        (self.spark.createDataFrame([(upto, folder)], _GENERATIONS).write.mode("append")
         .parquet(f"{self.path}/generations"))

    # ------------------------------------------------------------ reading
    def _terms(self, keyword: str) -> list[tuple[str, int]]:
        """The keyword's tokens in order, repeats too, and their buckets."""
        t = X.tokens(F.lit(keyword or ""))
        row = self.spark.range(1).select(F.transform(t, lambda x: F.struct(x, self._bucket(x))).alias("t")).first()
        return [tuple(x) for x in row.t]

    def _of(self, name: str, terms: list[tuple[str, int]]) -> DataFrame:
        """Rows of just these terms: their buckets' folders and row groups."""
        return self._read(name).where(F.col("bucket").isin(sorted({b for _, b in terms}))
                                      & F.col("term").isin(sorted({t for t, _ in terms})))

    def match_any(self, keyword: str) -> DataFrame:
        """id, n_terms (distinct keyword tokens held) and n_hits (their
        occurrences) of documents with at least one (F6); an empty keyword
        matches nothing."""
        hits = self._live(self._of("postings", self._terms(keyword)).select("id", "batch_id", "tf"))
        return hits.groupBy("id").agg(F.count("*").alias("n_terms"), F.sum("tf").alias("n_hits"))

    def match_all(self, keyword: str) -> DataFrame:
        """As ``match_any``, of documents with every keyword token."""
        return self.match_any(keyword).where(F.col("n_terms") == len({t for t, _ in self._terms(keyword)}))

    def match_phrase(self, phrase: str) -> DataFrame:
        """id and n_hits of documents where the tokens stand side by side in
        this order; overlapping places count."""
        terms = self._terms(phrase)
        places: dict[str, list[int]] = {}
        for i, (t, _) in enumerate(terms):
            places.setdefault(t, []).append(i)
        shift = F.array().cast("array<int>")
        for t, at in places.items():
            shift = F.when(F.col("term") == t, F.array(*[F.lit(i) for i in at])).otherwise(shift)
        hits = self._live(self._of("postings", terms).select("id", "batch_id", "term", "positions"))
        starts = (hits.select("id", F.explode("positions").alias("pos"), shift.alias("shift"))
                  .select("id", "pos", F.explode("shift").alias("i")).groupBy("id", (F.col("pos") - F.col("i")).alias("start"))
                  .agg(F.count("*").alias("n")).where(F.col("n") == len(terms)))
        return starts.groupBy("id").agg(F.count("*").alias("n_hits"))

    def statistics(self) -> tuple[int, int]:
        """Live documents and the sum of their lengths."""
        n = self._read("docs").agg(F.count("*").alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("dl")).first()
        gone = self._read("dead").agg(F.count("*").alias("n"), F.coalesce(F.sum("dl"), F.lit(0)).alias("dl")).first()
        return n.n - gone.n, n.dl - gone.dl

    def ranked(self, keyword: str, k: int = 20, k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
        """id and BM25 score of the ``k`` best documents, ties by id (L3).

        Blocks are bounded by their greatest frequency and smallest length.
        The ``SEEDS`` blocks of the highest bounds give a k-th score, and only
        blocks that can reach it are scored; the result is the same as from
        scoring all."""
        terms = self._terms(keyword)
        n, total = self.statistics()
        blocks = self._of("blocks", terms)
        of_term = {r.term: r.n for r in blocks.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        postings, dead = self._of("postings", terms), self._read("dead")
        lost = (postings.select("term", "id", "batch_id")
                .join(dead.select("id", F.col("version").alias("batch_id")), ["id", "batch_id"], "left_semi"))
        for r in lost.groupBy("term").count().collect():
            of_term[r["term"]] -= r["count"]
        of_term = {t: m for t, m in of_term.items() if m > 0}
        if not of_term:
            return self.spark.createDataFrame([], postings.select("id").schema.add("score", "double"))
        weight = F.lit(0.0)
        for t, m in of_term.items():
            weight = F.when(F.col("term") == t, F.lit(math.log(1 + (n - m + 0.5) / (m + 0.5)))).otherwise(weight)

        def part(tf, dl):
            return weight * F.col(tf) / (F.col(tf) + k1 * (1 - b + b * F.col(dl) / (total / n)))

        bounds = blocks.groupBy("seg", "block").agg(F.sum(part("max_tf", "min_dl")).alias("bound"))
        live = self._live(postings.select("seg", "block", "id", "batch_id", "term", "tf", "dl"), dead)

        def best(units: DataFrame) -> DataFrame:
            scores = (live.join(units.select("seg", "block"), ["seg", "block"], "left_semi")
                      .groupBy("id").agg(F.sum(part("tf", "dl")).alias("score")))
            return scores.orderBy(F.col("score").desc(), F.col("id").asc()).limit(k)

        first = best(bounds.orderBy(F.col("bound").desc(), "seg", "block").limit(SEEDS))
        found = first.agg(F.count("*").alias("n"), F.min("score").alias("s")).first()
        floor = found.s - 1e-9 if found.n == k and k else 0.0
        return best(bounds.where(F.col("bound") >= floor))
