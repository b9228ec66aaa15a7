"""Joins against lookup tables.

No hint is given: a lookup is read from a written table or a seed, so the
planner knows its bytes and broadcasts it below
``spark.sql.autoBroadcastJoinThreshold``; above that AQE decides from the
bytes it has shuffled, and splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(big: DataFrame, small: DataFrame, on, how: str = "left",
                small_rows: int | None = None) -> DataFrame:
    """Join a large frame to a lookup (``small_rows`` is informative only: bytes decide)."""
    return big.join(small, on, how)
