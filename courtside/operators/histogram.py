"""Moments and percentiles over value counts, for integer measures of a small domain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n): rows per value, counted by a hash aggregate that combines map-side."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def _weight(value: Column) -> Column:
    return F.when(value.isNotNull(), F.col("n"))


def histogram_mean(value: Column) -> Column:
    return F.sum(value * F.col("n")).cast("double") / F.sum(_weight(value))


def histogram_stddev(value: Column) -> Column:
    """Sample standard deviation (NULL for a single value); integer sums, so exact until the end."""
    n, s = F.sum(_weight(value)).cast("double"), F.sum(value * F.col("n")).cast("double")
    squares = F.sum(value.cast("bigint") * value * F.col("n")).cast("double")
    return F.sqrt(F.greatest(F.lit(0.0), squares - s * s / n) / F.nullif(n - 1, F.lit(0.0)))
