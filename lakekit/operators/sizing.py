"""Size-checked broadcast: a side is broadcast only after a bounded count proves it is small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def row_count_at_most(df: DataFrame, limit: int) -> int | None:
    """Count rows but stop at ``limit + 1``; returns None when ``df`` has more than ``limit`` rows."""
    n = df.limit(limit + 1).count()
    return n if n <= limit else None


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                       known_rows: int | None = None) -> DataFrame:
    """Hint a broadcast when the frame is proven to hold at most ``max_rows`` rows.

    ``known_rows`` skips the count for frames whose size is fixed by construction (24 hours, 112 classes).
    Otherwise the plan is left to the optimizer, and AQE may still pick a broadcast from runtime statistics.
    """
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    if row_count_at_most(df, max_rows) is not None:
        return F.broadcast(df)
    return df


def range_count(df: DataFrame, bytes_each: int = 64 << 20) -> int:
    """How many ranges to cut ``df`` into, from the optimizer's size of its plan (exact for a written table); a plan of
    unknown size gets the session's shuffle count."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(df.sparkSession.sparkContext.defaultParallelism, size // bytes_each + 1)
