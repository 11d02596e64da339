"""Token counts with a digest cache (operator 5).

Counts are stored under the SHA-256 digest of the content and of the
tokenizer.  A run joins its documents' digests to the stored counts, encodes
one text of each digest that is missing, appends those to the cache, and
joins again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import id_and_text, new_path, sliced
from shopstream.llm.pieces import count_tokens, default_vocabulary

CACHE_SCHEMA = "digest binary, n_tokens long, version string"


def tokenizer_version(path: str) -> str:
    """Digest of the vocabulary file and of the library that reads it."""
    import importlib.metadata

    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as f:
        content = hashlib.sha256(f.read())
    content.update(f"{library} {importlib.metadata.version(library)}".encode())
    return content.hexdigest()[:32]


def _encoded(misses: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            n = count_tokens(path, b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(n, pa.int64())], names=["digest", "n_tokens"])

    return misses.select("digest", "text").mapInArrow(run, "digest binary, n_tokens long")


def _stored(spark, cache_path: str, version: str) -> DataFrame:
    """Counts of one tokenizer; entries appended twice count once."""
    return (spark.read.schema(CACHE_SCHEMA).parquet(cache_path).where(F.col("version") == version)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def token_counts(docs: DataFrame, limit: int = 512, vocabulary: str | None = None,
                 cache_path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (``n_tokens > limit``) per row.

    ``vocabulary`` is a ``.json`` file (tokenizers) or a ``.model`` file
    (sentencepiece).  ``cache_path`` names the cache to use and extend, else a
    new one below the shared folder.  Content is taken as it is: the only
    normal form that keeps every count exact is null as the empty text.
    Repeated rows are answered each; other columns are ignored; an empty
    table gives no rows.
    """
    spark = docs.sparkSession
    path = vocabulary or default_vocabulary()
    version, cache_path = tokenizer_version(path), cache_path or new_path(spark, "token-counts")
    keyed = id_and_text(docs).withColumn("digest", F.unhex(F.sha2("text", 256)))
    # an append of no rows, so that the cache is there to be read
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    # texts move once: only ids and digests are grouped, and one document of
    # each missing digest is looked up again
    wanted = (keyed.groupBy("digest").agg(F.min("doc_id").alias("first"))
              .join(_stored(spark, cache_path, version), "digest", "left_anti"))
    misses = (keyed.alias("d").join(wanted.alias("w").hint("shuffle_hash"),
                                    F.col("d.doc_id").eqNullSafe(F.col("w.first"))
                                    & (F.col("d.digest") == F.col("w.digest")), "left_semi"))
    (_encoded(misses, path).dropDuplicates(["digest"]).withColumn("version", F.lit(version))
     .write.mode("append").parquet(cache_path))
    return (keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))
            .join(_stored(spark, cache_path, version), "digest")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
