"""Full-table snapshots of a relational source.

A JDBC read is split into ``num_partitions`` range scans on a numeric column
so the snapshot is read in parallel by the executors; without a JDBC URL the
snapshot is a parquet table.  No database is started by this package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_snapshot(spark: SparkSession, table: str, *, jdbc_url: str | None = None,
                  path: str | None = None, partition_column: str | None = None,
                  lower_bound: int | None = None, upper_bound: int | None = None,
                  num_partitions: int = 64, properties: dict | None = None) -> DataFrame:
    """``select * from table`` as a DataFrame, columns from the source schema."""
    if jdbc_url:
        r = spark.read.format("jdbc").option("url", jdbc_url).option("dbtable", table)
        for k, v in (properties or {}).items():
            r = r.option(k, v)
        if partition_column:
            if lower_bound is None or upper_bound is None:
                raise ValueError("a partitioned JDBC read needs lower_bound and upper_bound")
            r = (r.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
        return r.load()
    if path is None:
        raise ValueError("give jdbc_url or path")
    return spark.read.parquet(path)
