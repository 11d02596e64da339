"""Session construction and the shared scratch folder.

On a cluster the scratch root is the shared folder named by
``spark.checkpoint.dir``; it is read from the session and only set here when
it is unset (local tests), never to a machine-local folder on a cluster.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this package relies on.  AQE re-plans joins at
# runtime (broadcast when the measured side is small, skew splitting when a
# key holds a large share of the rows) and coalesces small shuffle outputs.
# Automatic broadcasts stay under Spark's size thresholds: the planner's
# (10 MB, on size estimates that are upper bounds for scans, joins and
# filters) and AQE's, which re-checks the measured shuffle output at runtime
# and otherwise keeps the sort-merge join.  Explicit broadcast hints are only
# placed after a row-count check (operators.joins).
# ``shuffle_partitions`` should give ~128 MB per partition at the target
# scale (100 TB of shuffle input -> ~800k); AQE coalesces them for small runs.
DEFAULT_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "shopstream",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``shuffle_partitions`` should be sized so one shuffle partition holds
    roughly 128 MB at the target scale; AQE coalesces it down for small runs.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Shuffle files go when the write or the micro-batch that made them has
#: ended; without it they stay until the driver happens to collect garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextlib.contextmanager
def session_conf(spark: SparkSession, conf: dict):
    """Session settings inside the block only."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, str(v))
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written tables, stream checkpoints and replays.

    Uses ``spark.checkpoint.dir`` when the cluster names one; otherwise, on a
    local master only (tests), creates a fresh folder and registers it as the
    checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not (spark.sparkContext.master + "[").startswith("local["):
            raise ValueError("name a folder all executors share in spark.checkpoint.dir")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the scratch root for one run of ``name``;
    Spark creates it with what is written first."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
