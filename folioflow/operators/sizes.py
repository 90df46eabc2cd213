"""Measured broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a narrow lookup only after counting that it is small; otherwise Spark shuffles."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
