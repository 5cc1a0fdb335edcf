"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def broadcast_within(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Ask for a broadcast only when a count proves the bound. Beyond it the join shuffles both
    sides and AQE splits hot keys. The bound is on rows, so rows must be narrow."""
    rows = small.limit(max_rows + 1).count()
    return F.broadcast(small) if rows <= max_rows else small
