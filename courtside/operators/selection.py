"""Exact percentiles of measures with very many distinct values, by repeated range counting.

A percentile is one or two order statistics of its group. Each of them has a window of
values that it lies in, at first the group's whole range. A pass cuts every window
into ``CUTS`` ranges of equal width (of equal ratio while it spans magnitudes), counts the rows
and takes the least and largest value of each range (combined map-side: a row for
a range, group and task at most), and keeps the range that holds the wanted rank. Once a
window holds at most ``FEW`` rows or one value, its rows are sorted. So no task holds
a group, and each pass over the rows leaves about one of ``CUTS`` of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.sources.tables import write_and_read

CUTS, FEW = 1024, 4096


def _kept(df: DataFrame, name: str) -> DataFrame:
    return write_and_read(df, f"selection/{name}").df


def _magnitude(value: str) -> Column:
    """A number that rises with the value as its logarithm does, through 0 and below it."""
    v = F.col(value)
    return F.signum(v) * (F.ln(F.abs(v) + 1e-300) + 691)


def order_statistics(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float],
                     cuts: int = CUTS, few: int = FEW) -> DataFrame:
    """(keys, share, place, rows, at): for each share the values at the ranks around share * (rows - 1).

    ``place`` is 0 for the lower and 1 for the upper one, ``rows`` the group's number of values. Null and
    non-finite values do not count; null keys are a group.
    """
    ids = [f"_k{i}" for i in range(len(keys))]
    v = F.col(value).cast("double")
    data = df.select(*[F.col(k).alias(i) for k, i in zip(keys, ids)], v.alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < float("inf")))
    groups = data.groupBy(*ids).agg(F.count(F.lit(1)).alias("_rows"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    place = F.col("_share") * (F.col("_rows") - 1)
    targets = _kept(groups.select("*", F.explode(F.array(*map(F.lit, map(float, shares)))).alias("_share"))
                    .select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("_place"))
                    .withColumn("_rank", F.when(F.col("_place") == 0, F.floor(place)).otherwise(F.ceil(place)))
                    .withColumn("_in", F.col("_rows")), "targets")
    own = [*ids, "_share", "_place"]

    def within(open_: DataFrame) -> DataFrame:
        w = open_.toDF(*[f"w{c}" for c in open_.columns])
        same = F.lit(True)
        for i in ids:
            same = same & data[i].eqNullSafe(w[f"w{i}"])
        return data.join(w, same & F.col("_v").between(F.col("w_lo"), F.col("w_hi"))).select(
            *[F.col(f"w{c}").alias(c) for c in open_.columns], "_v")

    done = []
    while True:
        decided = (F.col("_lo") == F.col("_hi")) | (F.col("_in") <= few)
        done.append(targets.where(decided))
        targets = targets.where(~decided)
        if targets.isEmpty():
            break
        wide = _magnitude("_hi") - _magnitude("_lo") > 1
        part = F.when(wide, (_magnitude("_v") - _magnitude("_lo")) / (_magnitude("_hi") - _magnitude("_lo"))).otherwise(
            (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")))
        cut = F.least(F.lit(cuts - 1), F.floor(part * cuts)).alias("_cut")  # rises with the value
        ranges = within(targets).groupBy(*own, "_rows", "_rank", cut).agg(
            F.count(F.lit(1)).alias("_in"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        before = F.sum("_in").over(Window.partitionBy(*own).orderBy("_cut").rowsBetween(
            Window.unboundedPreceding, -1))  # at most `cuts` rows a target
        ranges = ranges.withColumn("_before", F.coalesce(before, F.lit(0))).where(
            (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_in")))
        targets = _kept(ranges.withColumn("_rank", F.col("_rank") - F.col("_before")).select(
            *targets.columns), "targets")
    small = done[0]
    for d in done[1:]:
        small = small.unionByName(d)
    one = F.col("_lo") == F.col("_hi")
    found = small.where(one).select(*own, "_rows", F.col("_lo").alias("_at"))
    sorted_ = within(_kept(small.where(~one), "windows")).groupBy(*own, "_rows", "_rank").agg(
        F.sort_array(F.collect_list("_v")).alias("_all"))  # at most `few` values
    found = found.unionByName(sorted_.select(*own, "_rows", F.get("_all", F.col("_rank").cast("int")).alias("_at")))
    return found.select(*[F.col(i).alias(k) for i, k in zip(ids, keys)], F.col("_share").alias("share"),
                        F.col("_place").alias("place"), F.col("_rows").alias("rows"), F.col("_at").alias("at"))


def percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], **limits) -> DataFrame:
    """(keys, a column for each named share): continuous percentiles, interpolated between ranks."""
    found = order_statistics(df, keys, value, sorted(set(shares.values())), **limits)
    of = lambda share, place: F.max(F.when((F.col("share") == share) & (F.col("place") == place), F.col("at")))

    def between(share: float):
        rank = F.lit(float(share)) * (F.max("rows") - 1)
        d = rank - F.floor(rank)
        return of(share, 0) + (of(share, 1) - of(share, 0)) * d

    return found.groupBy(*keys).agg(*[between(s).alias(name) for name, s in shares.items()])
