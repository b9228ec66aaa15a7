"""Exact percentiles of wide domains, order-free sums, ties over many tasks, merged metrics."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.operators import selection
from courtside.operators.exact_sum import exact_sum
from courtside.plans import dashboard as D
from courtside.plans import metrics as M


def test_percentiles_by_narrowing_equal_sorted_ones(spark):
    r = random.Random(2)
    values = {"a": [r.gauss(0, 1) for _ in range(3001)], "b": [10.0 ** r.uniform(-300, 300) for _ in range(500)],
              "c": [1.5] * 700 + [2.5] * 2, "d": [7.0], None: [float(i) for i in range(40)],
              "e": [-1.7e308, 1.7e308, 0.0, 5.0, -3.0]}
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("a", None), ("a", float("nan")), ("f", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    shares = {"p0": 0.0, "q1": 0.25, "med": 0.5, "p9": 0.9}
    got = {x.k: x for x in selection.percentiles(df, ["k"], "v", shares, cuts=64, few=32).collect()}
    assert set(got) == set(values)
    for k, vs in values.items():
        vs = sorted(vs)
        for name, share in shares.items():
            place = share * (len(vs) - 1)
            low, d = int(place), place - int(place)
            want = vs[low] + (vs[low + 1 if d else low] - vs[low]) * d
            assert got[k][name] == want


def test_percentiles_of_a_million_distinct_values(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("t").alias("k"), (F.sqrt(F.col("id") * 7919 % n) + 1e-9).alias("v"))
    got = selection.percentiles(df, ["k"], "v", {"q1": 0.25, "med": 0.5}).first()
    vs = np.sort(np.sqrt(np.arange(n) * 7919 % n) + 1e-9)
    for name, share in (("q1", 0.25), ("med", 0.5)):
        place = share * (n - 1)
        low, d = int(place), place - int(place)
        assert got[name] == vs[low] + (vs[low + 1] - vs[low]) * d


def test_sums_have_equal_bits_whatever_the_partitions(spark):
    r = random.Random(1)
    rows = [(i % 3, r.uniform(-1, 1) * 10 ** r.randint(-6, 12), i) for i in range(5000)] + [(5, None, 0), (6, float("inf"), 0)]
    df = spark.createDataFrame(rows, "k int, v double, i int")
    plain, exact = set(), set()
    for n in (1, 7, 64):
        shuffled = df.orderBy(F.xxhash64("i", F.lit(n))).repartition(n, F.xxhash64("i", F.lit(-n)))
        out = {x.k: (x.e, x.p) for x in shuffled.groupBy("k").agg(exact_sum("v").alias("e"), F.sum("v").alias("p")).collect()}
        exact.add(tuple(out[k][0] for k in (0, 1, 2)))
        plain.add(tuple(out[k][1] for k in (0, 1, 2)))
        assert out[5][0] is None and out[6][0] == float("inf")
    assert len(exact) == 1
    from fractions import Fraction
    for k, s in enumerate(exact.pop()):
        true = sum(Fraction(v) for g, v, _ in rows if g == k)
        assert abs(Fraction(s) - true) <= abs(true) * Fraction(1, 2 ** 51)


def test_a_hot_date_and_team_is_sorted_by_many_tasks(spark):
    day = dt.date(2001, 1, 1)
    fct = spark.range(20_000).select(
        F.concat(F.lit("g"), "id").alias("game_team_id"), F.when(F.col("id") % 10 > 0, "A").otherwise("B").alias("team_id"),
        F.when(F.col("id") % 10 > 0, F.lit(day)).otherwise(F.date_add(F.lit(day), F.col("id").cast("int") % 50)).alias("game_date"),
        F.lit(2000).alias("season"), *[F.lit(1).alias(c) for c in ("win_flag", "score_diff", "playoff")],
        *[F.lit(1.0).alias(c) for c in ("elo_pre", "elo_post", "elo_change")], F.lit("HOME").alias("game_location"))
    dim = spark.createDataFrame([("A", "Team A", "Eastern"), ("B", "Team B", "Western")], "team_id string, team_name string, conference string")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    try:
        rows = D.games_ordered(fct, dim).withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    finally:
        spark.conf.unset(merge)
    sizes = sorted(r["count"] for r in rows)
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    ordered = D.games_ordered(fct, dim).collect()
    assert [r.game_date for r in ordered] == sorted((r.game_date for r in ordered), reverse=True)


def test_rating_series_sorts_bounded_rows_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(D, "SORT_ROWS", 2_000)
    day = dt.date(2001, 1, 1)
    games = spark.range(20_000).select(
        F.concat(F.lit("g"), "id").alias("game_team_id"), F.when(F.col("id") % 10 > 0, "A").alias("team_name"),
        F.when(F.col("id") % 10 > 1, F.lit(day)).when(F.col("id") % 100 > 1, F.date_add(F.lit(day), F.col("id").cast("int") % 50))
        .alias("game_date"), F.when(F.col("id") % 7 > 0, (F.col("id") % 3).cast("double")).alias("elo_post"))
    series = D.rating_series(games, 20_000)
    assert series.columns == ["team_name", "game_date", "elo_post"]
    sizes = [r["count"] for r in series.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()]
    assert len(sizes) == 10 and max(sizes) <= 2 * 2_000
    high = (dt.date.max, math.inf)
    got = [tuple(r) for r in series.collect()]
    want = [tuple(r)[1:] for r in games.collect()]
    by = lambda r: (r[0] is None, r[0] or "", r[1] or high[0], -high[1] if r[2] is None else r[2])
    assert got == sorted(want, key=by)
    assert D.rating_series(games.where("1 = 0"), 0).collect() == []


@pytest.mark.parametrize("name", sorted(M.PARTS))
def test_parts_are_the_declared_measure(name):
    parts, measure = M.PARTS[name]
    spec = M.METRICS[name]
    if spec.calculation_method == "derived":
        assert measure.format(**parts) == spec.expression
    else:
        assert all(spec.expression in p for p in parts.values())


def test_merged_metrics_equal_each_metric(spark):
    from courtside.catalog import QUERIES
    sf = "/root/testdata/sf0.001"
    merged = {}
    for r in QUERIES["metrics_all"](spark, sf).collect():
        dims = tuple(r[d] for d in M.METRICS[r.metric].dimensions)
        merged.setdefault((r.metric, r.grain), {})[(r.period_start, *dims)] = r.value
    assert len(merged) == 11
    for (name, grain), values in merged.items():
        key = f"metric_{name}" if M.METRICS[name].time_grains[0] == grain else f"metric_{name}_{grain}"
        alone = {(r.period_start, *[r[d] for d in M.METRICS[name].dimensions]): r[name] for r in QUERIES[key](spark, sf).collect()}
        assert alone == values
