"""Running totals over a date order with SQL's default RANGE frame.

``SUM(v) OVER (PARTITION BY team ORDER BY date)`` gives every row of one
(team, date) the same value. Run directly, that window sends each team to
one task: with ~30 teams there are ~30 useful tasks, and a team holding a
third of the rows makes one task sort a third of the table.

One path for every size: peers are summed per (team, date) map-side; each
team's days are cut into calendar months; a month's sum goes to the months
after it (a window over teams x months rows), and within a (team, month)
a window adds up at most 31 days. The totals are joined back null-safe, so
rows without a team or a date keep their place as a window would give it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PEER = "__peer_sum"


def _null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[x].eqNullSafe(right[y]) for x, y in pairs])


def running_sum(df: DataFrame, partition_by: Sequence[str], order_by: str, value: str,
                out: str) -> DataFrame:
    """``df`` plus ``out`` = SUM(value) OVER (PARTITION BY .. ORDER BY date RANGE ..); lazy."""
    keys = [f"__k{i}" for i in range(len(partition_by))]
    daily = (df.groupBy(*[F.col(c).alias(k) for c, k in zip(partition_by, keys)],
                        F.col(order_by).alias("__day"))
             .agg(F.sum(value).alias(_PEER))
             .withColumn("__month", F.trunc("__day", "month")))
    before = (Window.partitionBy(*keys).orderBy("__month")
              .rowsBetween(Window.unboundedPreceding, -1))
    months = (daily.groupBy(*keys, "__month").agg(F.sum(_PEER).alias("__sum"))
              .select(*[F.col(k).alias(f"{k}m") for k in keys], F.col("__month").alias("__m"),
                      F.sum("__sum").over(before).alias("__before")))
    inside = (Window.partitionBy(*keys, "__month").orderBy("__day")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = daily.withColumn("__local", F.sum(_PEER).over(inside))
    j = local.join(months, _null_safe(local, months, [*[(k, f"{k}m") for k in keys],
                                                      ("__month", "__m")]))
    # SUM skips NULLs and is NULL only when every value so far is NULL
    total = F.when(F.col("__local").isNull() & F.col("__before").isNull(), F.lit(None)).otherwise(
        F.coalesce("__local", F.lit(0)) + F.coalesce("__before", F.lit(0)))
    totals = j.select(*keys, "__day", total.cast(daily.schema[_PEER].dataType).alias(out))
    back = df.join(totals, _null_safe(df, totals, [*zip(partition_by, keys), (order_by, "__day")]))
    return back.select(*[df[c] for c in df.columns], totals[out])


def running_sum_window(df: DataFrame, partition_by: Sequence[str], order_by: str,
                       value: str, out: str) -> DataFrame:
    """The plain window, for checking :func:`running_sum` against."""
    w = Window.partitionBy(*partition_by).orderBy(order_by)
    return df.withColumn(out, F.sum(value).over(w))
