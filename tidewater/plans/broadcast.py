"""Broadcast only behind a checked bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows + 1)."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``broadcast(df)`` if its row count is within ``max_rows``; otherwise ``df``
    unchanged, leaving the join strategy to AQE's runtime statistics."""
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df
