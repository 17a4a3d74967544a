"""Size-checked broadcast: broadcast a join side only when it is proven small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast ``df`` when it has at most ``max_rows`` rows, else leave the
    join to the planner (sort-merge, or AQE's runtime broadcast).

    The check reads at most ``max_rows + 1`` rows (``limit`` stops early), so
    it stays cheap for a large side.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
