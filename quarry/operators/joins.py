"""Join helpers with explicit size checks.

``bounded_broadcast`` broadcasts a side only after a bounded count proves it
has at most ``max_rows`` rows; otherwise the plain DataFrame is returned and
Spark plans a shuffle join (with AQE free to switch strategy at runtime).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Reads at most
    ``max_rows + 1`` rows, never the whole side."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(df: DataFrame, max_rows: int = config.BROADCAST_MAX_ROWS) -> DataFrame:
    if row_count_at_most(df, max_rows):
        return F.broadcast(df)
    return df
