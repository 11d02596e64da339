"""Sinks: per-topic fact output, replay-safe upsert, append, daily tables.

Upserts (S9, D4) write each micro-batch into its own ``batch_id=N``
partition with dynamic partition overwrite, so a replayed batch replaces its
own earlier output and nothing else; readers take the row of the latest run
and batch per id, from a compacted base and the batches after it.  No
MERGE-capable table format is needed.
"""

from __future__ import annotations

import functools
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_fact_topics(facts: DataFrame, path: str | None = None,
                      kafka_servers: str | None = None, key_col: str | None = None) -> None:
    """Send routed fact rows ``(topic, value)`` to their topics.

    With ``kafka_servers`` this is one Kafka write with a per-row ``topic``
    column (connector jar required); otherwise rows are appended to
    ``path/topic=<name>/`` as JSON lines.  ``key_col`` gives the keyed form
    of the send (the message key decides the topic partition)."""
    cols = ["topic", "value"]
    if key_col:
        facts = facts.withColumn("key", F.col(key_col).cast("string"))
        cols = ["topic", "key", "value"]
    if kafka_servers:
        (facts.select(*cols).write.format("kafka")
         .option("kafka.bootstrap.servers", kafka_servers).save())
        return
    facts.select(*cols).write.mode("append").partitionBy("topic").json(path)


FEW = 10_000


def _keys(id_col: str | list[str]) -> list[str]:
    return [id_col] if isinstance(id_col, str) else list(id_col)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a copy that its maker needs no more, in whatever store it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def run_id(spark: SparkSession, checkpoint: str) -> int:
    """The run a checkpoint belongs to: kept beside it, so a restart goes on
    with it, while a new checkpoint gets a greater one.  Batch ids start at 0
    under a new checkpoint; the run tells its batches from older ones."""
    path = f"{checkpoint}.run"
    old = spark.read.schema("run long").parquet(path).agg(F.max("run")).first()[0] if path_exists(spark, path) else None
    if old is None:
        old = time.time_ns() // 1000
        spark.createDataFrame([(old,)], "run long").write.mode("append").parquet(path)
    return old


def upsert_batch(df: DataFrame, table_path: str, batch_id: int, id_col: str | list[str],
                 order_col: str, run: int = 0, by: list[str] | None = None) -> None:
    """Write one batch of documents keyed by ``id_col``.

    Within the batch the row of the greatest ``order_col`` per id wins, of
    equal ones the greatest; the maximum is combined map-side.  Re-running the same batch of a run
    overwrites only that batch's partitions.  ``by`` are further partition
    columns, such as the day (S14); the key must decide them.  Readers take a
    partition column's type from its values, so a key that must keep its type
    is copied to a partition column of another name."""
    keys = _keys(id_col)
    cols = [c for c in df.columns if c not in keys]
    # one struct that holds the order and the row: a max_by would move the row twice
    d = (df.groupBy(*keys).agg(F.max(F.struct(F.col(order_col).alias("~~order"), *cols)).alias("r"))
         .select(*keys, *[F.col(f"r.`{c}`") for c in cols]).withColumns({"run": F.lit(int(run)).cast("long"), "batch_id": F.lit(int(batch_id)).cast("long")}))
    if by:      # few files for each partition; a large one is split
        d = d.hint("rebalance", *[F.col(c) for c in by])
    (d.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy(*(by or []), "run", "batch_id").parquet(table_path))


_BASES = "run long, batch_id long, path string"


def _newest_base(spark: SparkSession, table_path: str):
    path = f"{table_path}.bases"
    if not path_exists(spark, path):
        return None
    return spark.read.schema(_BASES).parquet(path).orderBy(F.col("run").desc(), F.col("batch_id").desc()).first()


def _rows_since_base(spark: SparkSession, table_path: str) -> DataFrame:
    """The newest base of a table and the batches written after it."""
    t = spark.read.parquet(table_path)
    base = _newest_base(spark, table_path)
    if base is None:
        return t
    after = (F.col("run") > base.run) | (F.col("run") == base.run) & (F.col("batch_id") > base.batch_id)
    return spark.read.schema(t.schema).parquet(base.path).unionByName(t.where(after))


def read_latest(spark: SparkSession, table_path: str, id_col: str | list[str], few_repeats: bool = False) -> DataFrame:
    """Latest document per id: the newest base and all batches after it.
    Where ``few_repeats`` are expected, the ids that come more than once are
    looked for first; if they are few, only their rows are shuffled."""
    t, keys = _rows_since_base(spark, table_path), _keys(id_col)
    cols = [c for c in t.columns if c not in (*keys, "run", "batch_id")]
    latest = lambda d: (d.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct("run", "batch_id")).alias("r"))
                        .select(*keys, "r.*"))
    if not few_repeats:
        return latest(t)
    again = t.groupBy(*keys).agg(F.count(F.lit(1)).alias("~~n")).where(F.col("~~n") > 1).select(*[F.col(k).alias(f"~~{k}") for k in keys])
    some = again.limit(FEW + 1).collect()
    if len(some) > FEW:
        return latest(t)
    if not some:
        return t.select(*keys, *cols)
    again = F.broadcast(spark.createDataFrame(some, again.schema))
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"~~{k}")) for k in keys])
    return t.join(again, same, "left_anti").select(*keys, *cols).unionByName(latest(t.join(again, same, "left_semi")))


def compact(spark: SparkSession, table_path: str, id_col: str | list[str]) -> None:
    """Write the latest image of every id as a new base; readers take it once
    it is complete and listed, and skip the batches it holds.  Old batches stay
    for readers that began before."""
    t, keys = _rows_since_base(spark, table_path), _keys(id_col)
    upto = spark.read.parquet(table_path).agg(F.max(F.struct("run", "batch_id")).alias("m")).first().m
    if upto is None:
        return
    path = f"{table_path}.base-{upto.run}-{upto.batch_id}-{uuid.uuid4().hex[:8]}"
    cols = [c for c in t.columns if c not in keys]
    latest = t.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct("run", "batch_id")).alias("r")).select(*keys, "r.*")
    latest.select(*t.columns).write.option("compression", "zstd").parquet(path)
    (spark.createDataFrame([(upto.run, upto.batch_id, path)], _BASES).write.mode("append").parquet(f"{table_path}.bases"))


def compact_if_grown(spark: SparkSession, table_path: str, id_col: str | list[str]) -> None:
    """``compact`` once the batches since the newest base hold as many rows as
    it does: bases then come at doubling sizes, and all of them together stay
    in proportion to the batches, however often this is called."""
    base = _newest_base(spark, table_path)
    if base is not None:
        n = spark.read.parquet(base.path).count()
        if _rows_since_base(spark, table_path).count() < 2 * n:     # the base is among them
            return
    compact(spark, table_path, id_col)


def append_docs(df: DataFrame, path: str, id_col: str = "doc_uuid") -> None:
    """Append documents with a generated id."""
    df.withColumn(id_col, F.expr("uuid()")).write.mode("append").parquet(path)


def write_daily(df: DataFrame, path: str, load_id: str | int, day_col: str = "dt") -> None:
    """Write rows into one partition per day and load.

    The reference names the table after the processing date; the event day
    ``day_col`` is the partition key here, and ``load_id`` names the load (a
    processing date, a batch).  A load that is repeated replaces its own rows;
    no load touches another one's, so late rows of a day are added to it.  The
    rebalance hint gives each day few files; a large day is split."""
    loaded = df.withColumn("load_id", F.lit(str(load_id))).hint("rebalance", F.col(day_col))
    (loaded.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day_col, "load_id").parquet(path))


def read_day(spark: SparkSession, path: str, day: str, day_col: str = "dt") -> DataFrame:
    """One day's table; the filter prunes to that partition."""
    return spark.read.parquet(path).where(F.col(day_col) == day)
