"""Join helpers: size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_bounded(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows.  A larger side is returned
    unchanged and the planner shuffles it (AQE may still broadcast it when the
    measured shuffle output is under ``autoBroadcastJoinThreshold``).
    Streaming frames are never broadcast here."""
    if df.isStreaming:
        return df
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
