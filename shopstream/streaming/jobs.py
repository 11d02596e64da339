"""Structured Streaming runners: topic -> operators -> sink.

Each runner builds the streaming plan from the same operator functions as
the batch queries and writes through a checkpointed sink, so a restarted
query resumes from its offset and commit logs (at-least-once input,
idempotent output).  ``trigger`` is ``{"processingTime": "5 seconds"}`` in
service (the reference's micro-batch interval) and ``{"availableNow": True}``
for replays and tests.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import StructType

from shopstream.operators import cdc as C
from shopstream.operators import dau as D
from shopstream.operators import orders as O
from shopstream.operators.joins import broadcast_if_bounded
from shopstream.schemas import DIM_TABLES, ORDER_WIDE_COLUMNS
from shopstream.session import TIDY, session_conf
from shopstream.sources.sinks import compact_if_grown, path_exists, read_latest, run_id, upsert_batch

REPLAY = {"availableNow": True}
SERVICE = {"processingTime": "5 seconds"}


def finish(q: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an availableNow query, as long as it takes unless the caller
    sets a limit; stop it and fail if it overruns that."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"streaming query {q.name} did not finish in {timeout_s}s")
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return q


class LateRows(StreamingQueryListener):
    """Rows that stateful operators dropped as later than the watermark (T7),
    over every batch of every query, by query id; a query's own progress keeps
    its last batches only."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event):
        p = event.progress
        late = sum(int(op.numRowsDroppedByWatermark) for op in p.stateOperators)
        self.dropped[str(p.id)] = self.dropped.get(str(p.id), 0) + late

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def _start_conf(state_partitions: int | None, extra: dict | None = None) -> dict:
    """Settings that a query copies from the session when it starts; its
    checkpoint keeps the state partition count for every restart.  The session
    has its own again right after ``start()``."""
    conf = TIDY | (extra or {})
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = int(state_partitions)
    return conf


def unique_name(name: str) -> str:
    """Query names must be unique among active queries; runs of the same job
    may overlap, so every run gets its own suffix."""
    return f"{name}_{uuid.uuid4().hex[:8]}"


def start(df: DataFrame, sink_path: str, checkpoint: str, *, name: str,
          output_mode: str = "append", trigger: dict | None = None,
          fmt: str = "parquet", state_partitions: int | None = None,
          conf: dict | None = None) -> StreamingQuery:
    """Start a checkpointed sink.  ``state_partitions`` sizes the stateful
    operators of a new query (fixed by its checkpoint afterwards)."""
    w = (df.writeStream.format(fmt).outputMode(output_mode).queryName(unique_name(name))
         .option("path", sink_path).option("checkpointLocation", checkpoint))
    with session_conf(df.sparkSession, _start_conf(state_partitions, conf)):
        return w.trigger(**(trigger or REPLAY)).start()


# -------------------------------------------------------------- daily actives
def dau_stream(topic: DataFrame, tz: str = "UTC", delay: str = "24 hours") -> DataFrame:
    """Parse -> first visit -> de-duplicate per (dt, mid) under a watermark.

    The reference's per-day set expires 24 h after its last touch and never
    drops late data; here a record later than ``delay`` behind the newest
    event time is dropped by the watermark (counted in the query progress)."""
    first = D.first_visits(D.parse_app_log(topic, tz))
    return D.dedup_first_visits_stream(first, delay).select(
        "dt", "mid", "uid", "ar", "ch", "vc", "hr", "ts", "event_id")


def run_dau(spark: SparkSession, topic: DataFrame, sink_path: str, checkpoint: str,
            trigger: dict | None = None, timeout_s: float | None = None,
            state_partitions: int | None = None, tz: str = "UTC", delay: str = "24 hours") -> StreamingQuery:
    """Daily actives into one partition per day, upserted by device.
    Read with ``read_latest(spark, sink_path, ["dt", "mid"])``."""
    run = run_id(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch.withColumn("day", F.col("dt")), sink_path, batch_id, ["dt", "mid"], "ts", run, by=["day"])

    return _run(spark, dau_stream(topic, tz, delay), write, checkpoint, "dau_dedup", trigger, timeout_s, state_partitions)


def _run(spark, df: DataFrame, write, checkpoint: str, name: str, trigger, timeout_s, state_partitions,
         output_mode: str = "append", conf: dict | None = None) -> StreamingQuery:
    """Start a checkpointed ``foreachBatch`` query; wait for it if it ends."""
    w = (df.writeStream.outputMode(output_mode).queryName(unique_name(name))
         .option("checkpointLocation", checkpoint).foreachBatch(write).trigger(**(trigger or REPLAY)))
    with session_conf(spark, _start_conf(state_partitions, conf)):
        q = w.start()
    return finish(q, timeout_s) if (trigger or REPLAY) == REPLAY else q


# ------------------------------------------------------------- order-wide join
Dims = Callable[[], tuple[DataFrame, DataFrame]]
WIDE_KEY = ["create_date", "detail_id"]


def _enriched(joined: DataFrame, ids: DataFrame, dims: Dims) -> DataFrame:
    """Wide rows with the dimensions as they are now.  ``dims`` is called for
    every micro-batch, inside which AQE is at work; of the users only those of
    the batch, ``ids``, go on to the join."""
    users, provinces = dims()
    users = users.join(broadcast_if_bounded(ids), users.id == ids["_uid"], "left_semi")
    line, order = ([c for c in joined.columns if c.startswith("o_") == of_order] for of_order in (False, True))
    rows = joined.select(*[F.col(c).alias(f"l_{c}") for c in line], *[F.col(c).alias(c[2:]) for c in order])
    wide = O.enrich_orders(rows, users, provinces)
    return wide.select(*[F.col(f"l_{c}").alias(c) for c in line],
                       *[F.col(c).alias(f"o_{c}") for c in [x[2:] for x in order] + O.DIM_COLUMNS])


BY_DAY = ("create_date",)


def _write_wide(joined: DataFrame, dims: Dims, table_path: str, batch_id: int, run: int, by: tuple = BY_DAY) -> None:
    """Upsert wide rows by line into one partition per order day (S9, S14,
    D4); of several arrivals of an order the last one counts.

    A plan must name the batch of a stateful stream only once: Spark gives
    further mentions new columns, does not find them in the cache, and runs the
    stream's join with all its state again.  So the batch's users are written
    to ``<table_path>.users`` first, to partitions that stay the batch's own."""
    joined = joined.persist()
    try:
        users_path = f"{table_path}.users"
        _own(joined.select(F.col("o_user_id").alias("_uid")).distinct(), users_path, run, batch_id)
        ids = (joined.sparkSession.read.schema("_uid long, run long, batch_id long").parquet(users_path)
               .where((F.col("run") == run) & (F.col("batch_id") == int(batch_id))).select("_uid"))
        wide = O.merge_wide(_enriched(joined, ids, dims), "o_arr")
        upsert_batch(wide, table_path, batch_id, WIDE_KEY, "o_arr", run, by=list(by))
    finally:
        joined.unpersist()


def read_wide(spark: SparkSession, table_path: str) -> DataFrame:
    """The wide rows that a stream has written, one per line."""
    rows = read_latest(spark, table_path, WIDE_KEY, few_repeats=True).select(*ORDER_WIDE_COLUMNS)
    return rows.withColumn("create_date", F.col("create_date").cast("string"))      # a partition column is read as a date


def order_wide_stream(order_topic: DataFrame, detail_topic: DataFrame,
                      ttl_seconds: int = 600, delay: str = "10 minutes") -> DataFrame:
    """Two topics in one query (T5): lines joined with their orders when the
    arrivals are less than ``ttl`` apart (J5).  State of either side is dropped
    once the watermark passes ``arr + ttl`` (T3); unmatched rows expire without
    output (J7)."""
    orders = O.parse_order_info(order_topic).withWatermark("arr", delay)
    details = O.parse_order_detail(detail_topic).withWatermark("arr", delay)
    return O.interval_join(orders, details, ttl_seconds)


#: What a join's checkpoint keeps.  Every batch adds its rows to the state and
#: the next one drops them, so a version is about as large as a batch: two
#: batches to go back to instead of 100, and few changes between snapshots.
JOIN_STATE = {"spark.sql.streaming.minBatchesToRetain": "2", "spark.sql.streaming.stateStore.minDeltasForSnapshot": "2",
              "spark.sql.streaming.stateStore.compression.codec": "zstd",
              "spark.sql.streaming.stateStore.maintenanceInterval": "10s"}


def run_order_wide(spark: SparkSession, order_topic: DataFrame, detail_topic: DataFrame,
                   dims: Dims, table_path: str, checkpoint: str, trigger: dict | None = None,
                   timeout_s: float | None = None, state_partitions: int | None = None, by: tuple = BY_DAY) -> StreamingQuery:
    """The interval form (J5): a stream-stream join, which approximates the
    cache semantics; ``run_order_wide_ttl`` has them exactly."""
    run = run_id(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        _write_wide(batch, dims, table_path, batch_id, run, by)

    return _run(spark, order_wide_stream(order_topic, detail_topic), write, checkpoint, "order_wide", trigger, timeout_s,
                state_partitions, conf=JOIN_STATE)


ARRIVED = "slot long, run long, batch_id long"
SLOT_SECONDS = 3_600


def _slot(us, slot_seconds: int):
    return F.floor(us / (slot_seconds * 1_000_000)).cast("long")


def _own(df: DataFrame, path: str, run: int, batch_id: int, *by: str) -> None:
    """Write a batch's rows to partitions of its own, few files each; a
    repeated batch replaces them.  The hint splits a large partition."""
    df = df.withColumns({"run": F.lit(run).cast("long"), "batch_id": F.lit(int(batch_id)).cast("long")})
    if by:
        df = df.hint("rebalance", *[F.col(c) for c in by])
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by, "run", "batch_id").parquet(path)


def _slots(spark: SparkSession, path: str, like: DataFrame, slots: list[int]) -> DataFrame | None:
    """Rows that arrived in the given slots; only their folders are listed."""
    there = [f"{path}/slot={s}" for s in slots if path_exists(spark, f"{path}/slot={s}")]
    if not there:
        return None
    schema = StructType(like.schema.fields + StructType.fromDDL(ARRIVED).fields)
    return spark.read.schema(schema).option("basePath", path).parquet(*there)


def _slots_between(spark: SparkSession, path: str, low: int, high: int) -> list[int]:
    """Slots of a range; of a wide one those that are there, by their folders'
    names."""
    if high - low < 64 or not path_exists(spark, path):
        return list(range(low, high + 1)) if high - low < 64 else []
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    slots = [int(n.removeprefix("slot=")) for n in names if n.startswith("slot=")]
    return sorted(s for s in slots if low <= s <= high)


_KEPT = f"{O.RUN}, seen long, run long, batch_id long"


def _kept_runs(spark: SparkSession, path: str, run: int, batch_id: int) -> DataFrame:
    """The runs as the batch before left them.  Two versions are kept, in turn;
    the first batch of a new checkpoint goes on from the newest one."""
    there = [p for p in ([f"{path}/turn={(batch_id - 1) % 2}"] if batch_id else [f"{path}/turn={k}" for k in (0, 1)])
             if path_exists(spark, p)]
    if not there:
        return spark.createDataFrame([], _KEPT)
    rows = spark.read.schema(_KEPT).parquet(*there)
    if batch_id:
        return rows.where((F.col("run") == run) & (F.col("batch_id") == batch_id - 1))
    newest = rows.where(F.col("run") < run).agg(F.max(F.struct("run", "batch_id")).alias("m")).first().m
    return rows.where(F.lit(False)) if newest is None else rows.where(
        (F.col("run") == newest.run) & (F.col("batch_id") == newest.batch_id))


def run_order_wide_ttl(spark: SparkSession, order_topic: DataFrame, detail_topic: DataFrame, dims: Dims,
                       table_path: str, checkpoint: str, ttl_seconds: int = 600, delay_seconds: int = 86_400,
                       trigger: dict | None = None, timeout_s: float | None = None,
                       state_partitions: int | None = None, slot_seconds: int = SLOT_SECONDS,
                       by: tuple = BY_DAY) -> StreamingQuery:
    """The wide stream under the exact cache semantics.

    The topics need not be in step.  What a later row needs of an order's
    waiting lines is where their unbroken run began and when its last line
    came; ``<table_path>.runs`` holds that, a row per run, and is merged with
    every micro-batch (``O.line_runs``).  A run lives as long as lines keep
    coming, be it for days.  The rows themselves are kept by slot of arrival.
    A batch joins its new lines to the orders of the last ``ttl``, and reads
    earlier lines only for orders that are new or whose run has grown
    backwards, from just the slots of those runs.  More rows only add matches,
    and repeats are upserted by line.

    ``delay_seconds`` is how far behind the newest row one may come and still
    meet all it should: a run is forgotten once nothing so late can prolong
    it.  Rows later than that are joined to what is still known and listed in
    ``<table_path>.late``.  Joins run with AQE, which splits a hot order.  Bad
    messages go to ``<table_path>.bad``."""
    run = run_id(spark, checkpoint)
    orders_path, lines_path, bad_path, late_path, runs_path = (f"{table_path}.{x}" for x in ("orders", "lines", "bad", "late", "runs"))
    both = order_topic.select(F.lit("order").alias("kind"), "value", "timestamp").unionByName(
        detail_topic.select(F.lit("line").alias("kind"), "value", "timestamp"))
    W, delay = ttl_seconds * 1_000_000, delay_seconds * 1_000_000

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        held = [batch]
        try:
            kind, us = F.col("kind"), F.unix_micros("timestamp")
            known = _kept_runs(spark, runs_path, run, batch_id).persist()
            held.append(known)
            seen = known.agg(F.max("seen")).first()[0]
            first, newest, oldest_line, n, n_late = batch.agg(
                F.min(us), F.max(us), F.min(F.when(kind == "line", us)), F.count(F.lit(1)),
                F.count_if(us < (seen or 0) - delay)).first()
            if first is None:
                if known.isEmpty():
                    return
                newest = seen       # the state goes on to the next turn
            if n_late:
                _own(batch.where(us < seen - delay), late_path, run, batch_id)
            orders = O.parse_order_info(batch.where("kind = 'order'")).withColumn("slot", _slot(F.unix_micros("arr"), slot_seconds))
            lines = O.parse_order_detail(batch.where("kind = 'line'")).withColumn("slot", _slot(F.unix_micros("arr"), slot_seconds))
            orders, lines = orders.persist(), lines.persist()
            held += [orders, lines]
            _own(orders, orders_path, run, batch_id, "slot")
            _own(lines, lines_path, run, batch_id, "slot")
            # a readable message is one row: only where some are missing are all parsed again
            if orders.select(F.lit(1)).unionAll(lines.select(F.lit(1))).count() < n:
                bad = F.when(kind == "order", O.is_bad_order()).otherwise(O.is_bad_detail())
                _own(batch.where(bad), bad_path, run, batch_id)
            batch.unpersist()       # orders and lines are held by now
            orders, lines = orders.drop("slot"), lines.drop("slot")
            before = known.where("order_id is not null")
            seen = max(seen or newest, newest)
            runs = O.line_runs(before, lines, ttl_seconds).persist()
            held.append(runs)
            clock = spark.createDataFrame([(None, None, None)], O.RUN)
            alive = runs.where(F.col("last") + W > seen - delay).unionByName(clock)
            # the version of two batches ago goes; a repeated batch finds the one before it
            (alive.withColumns({"seen": F.lit(seen).cast("long"), "run": F.lit(run).cast("long"), "batch_id": F.lit(int(batch_id)).cast("long"),
                                "turn": F.lit(batch_id % 2)})
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("turn").parquet(runs_path))
            # orders whose lines may be among the new ones, and new orders
            arrivals = orders.dropDuplicates(["id", "arr"]).withColumn("new", F.lit(True))
            if oldest_line is not None:
                width = slot_seconds * 1_000_000
                stored = _slots(spark, orders_path, orders,
                                _slots_between(spark, orders_path, (oldest_line - W) // width, seen // width))
                if stored is not None:
                    ids = lines.select(F.col("order_id").alias("id")).distinct()
                    old = (stored.where((F.col("run") != run) | (F.col("batch_id") != int(batch_id))).drop("slot", "run", "batch_id")
                           .where(F.unix_micros("arr") > oldest_line - W).join(ids, "id", "left_semi")
                           .dropDuplicates(["id", "arr"]).withColumn("new", F.lit(False)))
                    arrivals = arrivals.unionByName(old)
            arrivals = arrivals.withColumn("o_us", F.unix_micros("arr"))
            arrivals = O.waiting_from(O.waiting_from(arrivals, before, ttl_seconds, "lo_before"), runs, ttl_seconds)
            users, provinces = dims()       # as they are now
            users = users.join(arrivals.select(F.col("user_id").alias("_uid")).distinct(), users.id == F.col("_uid"), "left_semi")
            arrivals = O.enrich_orders(arrivals, users, provinces).persist()
            held.append(arrivals)
            joined = O.lines_of(arrivals.drop("new", "lo_before"), lines, ttl_seconds)
            # earlier lines: of orders that are new, or see more of them now
            again = arrivals.where(F.col("new") | (F.col("lo") < F.col("lo_before")))
            met = again.join(before.select(F.col("order_id").alias("_id"), F.col("start").alias("_s"), F.col("last").alias("_l")),
                             (F.col("id") == F.col("_id")) & (F.col("_l") >= F.col("lo")) & (F.col("_s") < F.col("o_us") + W))
            slots = met.select(F.explode(F.sequence(_slot(F.greatest("lo", "_s"), slot_seconds),
                                                    _slot(F.least("_l", F.col("o_us") + W), slot_seconds))).alias("s")).distinct()
            stored = _slots(spark, lines_path, lines, sorted(r.s for r in slots.collect()))     # slots, not rows
            if stored is not None:
                earlier = stored.where((F.col("run") != run) | (F.col("batch_id") != int(batch_id))).drop("slot", "run", "batch_id")
                joined = joined.unionByName(O.lines_of(again.drop("new", "lo_before"), earlier, ttl_seconds))
            upsert_batch(O.merge_wide(joined, "o_arr"), table_path, batch_id, WIDE_KEY, "o_arr", run, by=list(by))
        finally:
            for df in held:
                df.unpersist()

    return _run(spark, both, write, checkpoint, "order_wide_ttl", trigger, timeout_s, state_partitions)


# ------------------------------------------------------------------- orphans
def orphan_stream(order_topic: DataFrame, detail_topic: DataFrame, ttl_seconds: int = 600,
                  delay: str = "10 minutes") -> DataFrame:
    """Orders and lines that no partner can reach any more (J7): kind, id, arr.

    A full outer stream-stream join of the interval form: a row's state is
    dropped once the watermark passes ``arr + ttl``, and a row that met no
    partner until then comes out, once."""
    orders = O.parse_order_info(order_topic).select("id", "arr").withWatermark("arr", delay)
    details = O.parse_order_detail(detail_topic).select("id", "order_id", "arr").withWatermark("arr", delay)
    o = orders.select(F.col("id").alias("o_id"), F.col("arr").alias("o_arr"))
    ttl = F.expr(f"INTERVAL {int(ttl_seconds)} SECONDS")
    met = (F.col("order_id") == F.col("o_id")) & (F.col("arr") > F.col("o_arr") - ttl) & (F.col("arr") < F.col("o_arr") + ttl)
    alone = F.col("o_id").isNull() | F.col("id").isNull()
    return (details.join(o, met, "full_outer").where(alone)
            .select(F.when(F.col("id").isNull(), "order").otherwise("line").alias("kind"), F.coalesce("id", "o_id").alias("id"),
                    F.coalesce("arr", "o_arr").alias("arr")))


def run_orphans(spark: SparkSession, order_topic: DataFrame, detail_topic: DataFrame, table_path: str, checkpoint: str,
                ttl_seconds: int = 600, delay: str = "10 minutes", trigger: dict | None = None, timeout_s: float | None = None,
                state_partitions: int | None = None) -> StreamingQuery:
    """Orphans into one partition per batch, which a repeated batch replaces."""
    run = run_id(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        _own(batch, table_path, run, batch_id)

    return _run(spark, orphan_stream(order_topic, detail_topic, ttl_seconds, delay), write, checkpoint, "orphans", trigger, timeout_s,
                state_partitions)


# ------------------------------------------------- daily actives that expire
def run_dau_expiring(spark: SparkSession, topic: DataFrame, table_path: str, checkpoint: str, trigger: dict | None = None,
                     timeout_s: float | None = None, state_partitions: int | None = None, tz: str = "UTC") -> StreamingQuery:
    """Daily actives with the set's refreshed expiry (D1, T2, T7).  Every batch
    keeps its own buckets; ``read_dau_expiring`` merges them, so any split or
    repetition of the records gives the batch answer.  No record is dropped as
    late, and no state is held between batches."""
    run = run_id(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        first = D.first_visits(D.parse_app_log(batch, tz, arr_col="timestamp"))
        _own(D.touch_buckets(first), table_path, run, batch_id)

    return _run(spark, topic, write, checkpoint, "dau_expiring", trigger, timeout_s, state_partitions)


def read_dau_expiring(spark: SparkSession, table_path: str) -> DataFrame:
    """First visits as the expiring sets have counted them so far."""
    parts = spark.read.parquet(table_path).select("dt", "bucket", "mid", "lo", "hi", "first")
    return D.expiring_first_visits(D.merge_buckets(parts))


# ------------------------------------------------------- topic bookkeeping
def run_topic_counts(spark: SparkSession, topic: DataFrame, key: str, table_path: str,
                     checkpoint: str, trigger: dict | None = None,
                     timeout_s: float | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Running count of parsed log records per ``key`` (S1), upserted by key:
    a batch writes the counts it changed, so readers always see a whole table."""
    counts = D.parse_app_log(topic).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    run = run_id(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(batch, table_path, batch_id, key, "n", run)

    return _run(spark, counts, write, checkpoint, "topic_counts", trigger, timeout_s, state_partitions, "update")


def run_batch_progress(spark: SparkSession, topic: DataFrame, table_path: str,
                       checkpoint: str, trigger: dict | None = None,
                       timeout_s: float | None = None, state_partitions: int | None = None) -> StreamingQuery:
    """Record ``(batch_id, n_rows)`` and the offset range of each topic
    partition of every micro-batch (S4, T4).

    ``foreachBatch`` hands the batch id to the sink; the rows are written as
    that batch's partition, so a batch replayed after a failure rewrites its
    own rows instead of adding some."""
    run = run_id(spark, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        ranges = batch.groupBy(F.coalesce("partition", F.lit(0)).alias("partition")).agg(
            F.count(F.lit(1)).alias("n_rows"), F.min("offset").alias("from_offset"), F.max("offset").alias("until_offset"))
        upsert_batch(ranges.withColumn("until_offset", F.col("until_offset") + 1), table_path, batch_id, "partition", "n_rows", run)

    return _run(spark, topic, write, checkpoint, "batch_progress", trigger, timeout_s, state_partitions)


# ----------------------------------------------------------- change-data split
DIM_KEY = "key"


def run_cdc_split(spark: SparkSession, cdc_topic: DataFrame, dim_table: str, fact_path: str,
                  checkpoint: str, dims=DIM_TABLES, trigger: dict | None = None,
                  timeout_s: float | None = None, state_partitions: int | None = None,
                  compact_every: int = 100) -> StreamingQuery:
    """Split a change-data topic per micro-batch.

    Dimension rows are reduced to the latest image per key within the batch
    and upserted into ``dim_table``; fact rows are written to
    ``fact_path/run=.../batch_id=...``, all topics of a batch together.
    Outputs of a replayed batch replace themselves, so the query is
    restart-safe.  A snapshot bootstrap is the snapshot envelopes placed first
    on the topic (S6).  Changes of a row are in one topic partition, in order
    of offset; a replay without offsets goes by its timestamps.  Every
    ``compact_every`` batches the dimension table gets a new base if it has
    grown by as much as the last one holds.  Bad envelopes go to ``<fact_path>.bad``."""
    run = run_id(spark, checkpoint)
    stamp = {"run": F.lit(run).cast("long")}

    def write(batch: DataFrame, batch_id: int) -> None:
        here = stamp | {"batch_id": F.lit(int(batch_id)).cast("long")}
        seq = F.coalesce("offset", F.unix_micros("timestamp"))
        checked = C.checked_envelopes(batch).persist()      # parsed once, three outputs (T6)
        try:
            out = lambda df, path: (df.withColumns(here).write.mode("overwrite")
                                    .option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
                                    .partitionBy("run", "batch_id").parquet(path))
            out(checked.where("bad").drop("e", "bad"), f"{fact_path}.bad")
            env = C.good_envelopes(checked.withColumn("seq", seq), "timestamp", "seq")
            # a topic's rows side by side: readers of one skip the others
            out(C.route_facts(env, dims).select("topic", "value", "seq", "timestamp").sortWithinPartitions("topic"), fact_path)
            latest = C.dim_latest(env, dims).select("key", "table", "pk", "type", "value").withColumn("seq", F.lit(0))
            upsert_batch(latest, dim_table, batch_id, DIM_KEY, "seq", run)
        finally:
            checked.unpersist()
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact_if_grown(spark, dim_table, DIM_KEY)

    return _run(spark, cdc_topic, write, checkpoint, "cdc_split", trigger, timeout_s, state_partitions)


def read_dims(spark: SparkSession, dim_table: str) -> tuple[DataFrame, DataFrame]:
    """The user and province lookups as the split has them now."""
    return C.dim_tables(read_latest(spark, dim_table, DIM_KEY))


FACTS = "topic string, value string, seq long, timestamp timestamp, run long, batch_id long"


class FactsCut(NamedTuple):
    """Files of a few of the split's batches, one with the other, and the
    longest time that one of them spans."""
    files: int
    span_seconds: int


def facts_cut(spark: SparkSession, fact_path: str, topics: list[str], batches: int = 4) -> FactsCut:
    """How to read the facts that are there in batches of about so many of the
    split's own.  A batch may end within one of those: rows of the next are
    then behind it by as much as that one spans."""
    facts = spark.read.schema(FACTS).parquet(fact_path)
    us = F.unix_micros("timestamp")
    n, span = (facts.where(F.col("topic").isin(topics)).groupBy("run", "batch_id").agg((F.max(us) - F.min(us)).alias("us"))
               .agg(F.count("*"), F.max("us")).first())
    return FactsCut(math.ceil(len(facts.inputFiles()) * batches / max(n, 1)) or 1, math.ceil((span or 0) / 1_000_000) + 1)


def stream_facts(spark: SparkSession, fact_path: str, topic: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """One fact topic of the split as a stream of topic records."""
    return (spark.readStream.schema(FACTS)
            .option("maxFilesPerTrigger", str(max_files_per_trigger)).parquet(fact_path).where(F.col("topic") == topic)
            .select("value", "timestamp", F.col("seq").alias("offset")))
