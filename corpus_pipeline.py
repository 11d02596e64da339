"""A corpus pipeline of the operators in ``shopstream.llm``.

``STAGES`` are applied one after another to ``documents``.  Each stage takes
all rows its predecessor kept; its result is written as Parquet to the shared
folder and read again as the next one's input, so a lost executor costs at
most one stage.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm import decontaminate, line_dedup, near_dup, packing, quality
from shopstream.llm.common import materialized, table


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (operator 9) accepts."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, model).where("predicted = 1").select("doc.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines that occur earlier (operator 1); n_chars
    follows the text.  A document may become empty, and stays."""
    out = line_dedup.dedup_lines(docs)
    changed = {"text": F.col("kept"),
               "n_chars": F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("doc.n_chars"))}
    types = dict(docs.dtypes)
    return out.select(*[(changed[c].cast(types[c]) if c in changed else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each class of near
    duplicates (operator 8); rows without a doc_id have no class and stay."""
    first = near_dup.near_duplicates(docs).where("doc_id = class_id").select("doc_id")
    kept = docs.where("doc_id is not null").join(first.hint("shuffle_hash"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more of the benchmark than the rule of operator
    6 allows."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where("not contaminated").select("doc.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, packed (operator 7)."""
    return packing.packed_digests(packing.pack(docs, capacity=1024, end_id=0))


STAGES = [("quality classifier", reject_low_quality), ("line dedup", drop_repeated_lines),
          ("MinHash near-dedup", keep_one_of_each_class), ("benchmark decontamination", drop_contaminated),
          ("packing", pack)]

#: SQL can't express the trained classifier, SimHash and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
