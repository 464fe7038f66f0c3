"""Join helpers: broadcast only behind a size check, scalar subqueries for 1-row stats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast side is copied to every executor; keep it well under executor memory.
BROADCAST_LIMIT_BYTES = 32 * 1024 * 1024


def plan_size_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of the optimized plan (no job is run)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    except Exception:  # Spark Connect or an unsized plan
        return None
    return int(size if isinstance(size, int) else str(size))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint a broadcast only when the estimate is known and under ``limit``.

    Otherwise the join stays a shuffle join; with AQE on, Spark may still
    switch to a broadcast after it has measured the real shuffle size.
    """
    size = plan_size_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


def with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach a one-row statistics frame (global aggregate) to every row, as scalar subqueries: no join."""
    return df.withColumns({c: stats.select(c).scalar() for c in stats.columns})
