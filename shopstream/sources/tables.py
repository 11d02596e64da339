"""Reading the driver tables.

Tables are read lazily with ``spark.read.parquet``; Catalyst prunes columns
and pushes filters into the scan, so callers select only what they use.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


class Tables:
    """Lazy handle on ``<sf_dir>/<name>.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.load(name)
        raise AttributeError(name)

    @cached_property
    def views(self):
        from shopstream.fixtures import Views
        return Views(self)


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)
