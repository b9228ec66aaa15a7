"""Plan-shape assertions: the properties the scale design depends on."""

import datetime as dt

from pyspark.sql import functions as F

from courtside.operators.joins import lookup_join
from courtside.operators.running import running_sum, running_sum_window
from courtside.plans import dashboard as D
from courtside.plans import exports
from courtside.plans.warehouse import warehouse_for

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_join_is_broadcast_and_falls_back_past_bound(spark):
    w = warehouse_for(spark, SF)
    fct, dim = w.table("fct_games"), w.table("dim_teams")
    fast = exports.team_win_rates(fct, dim, w.rows("dim_teams"))
    assert "BroadcastHashJoin" in _plan(fast)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        slow = exports.team_win_rates(fct, dim, dim_rows=10**9)  # past the bound: no hint
        assert "BroadcastHashJoin" not in _plan(slow)
        assert sorted(map(tuple, slow.collect())) == sorted(map(tuple, fast.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_lookup_join_keeps_unmatched_rows(spark):
    big = spark.range(100).withColumn("k", F.col("id") % 3)
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    j = lookup_join(big, small, "k", "left")
    assert j.filter("v is null").count() == 33


def test_fact_aggregations_are_partial_hash_aggregates(spark):
    w = warehouse_for(spark, SF)
    games = D.games_filtered(w.table("fct_games"), w.table("dim_teams"), w.rows("dim_teams"))
    for df in (D.season_rating_change(games), D.win_rates(games), D.box_stats(games)):
        p = _plan(df)
        assert "SortAggregate" not in p
        assert "partial_" in p  # map-side combine before the shuffle
    p = _plan(w.side_summary())
    assert "partial_count" in p and "Window" not in p


def test_season_filter_prunes_partitions(spark):
    w = warehouse_for(spark, SF)
    g = D.games_filtered(w.table("fct_games"), w.table("dim_teams"), w.rows("dim_teams"),
                         seasons=[2000])
    p = _plan(g)
    assert "PartitionFilters: [isnotnull(season" in p and "season" in p


def test_running_sum_with_a_hot_team(spark):
    # one team holds most rows and many share a date: totals equal the plain window
    rows = [("hot", dt.date(2001, 1, 1 + i % 5), float(i % 7)) for i in range(500)]
    rows += [("cold", dt.date(2001, 1, 1 + i), 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "t string, d date, v double")
    fast = running_sum(df, ["t"], "d", "v", "c")
    plain = running_sum_window(df, ["t"], "d", "v", "c")
    key = lambda r: (r.t, r.d, r.v, r.c)
    assert sorted(fast.collect(), key=key) == sorted(plain.collect(), key=key)
    plan = _plan(fast)
    if "== Final Plan ==" in plan:  # executed: keep only the final adaptive plan
        plan = plan.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
    # windows run per (team, month) and over the months, never over a whole team's rows
    specs = [line for line in plan.splitlines() if " Window [" in f" {line}"]
    assert specs and all("__day" in x and "__month" in x or "__before" in x for x in specs)


def test_dated_files_prune_a_window(spark, scratch):
    """Files of the fact hold few months each, so a date window overlaps few of them."""
    import pyarrow.dataset as ds
    from courtside.plans.warehouse import dated
    # as on a large cluster: more partitions than months, each large enough to stay
    conf = {"spark.sql.shuffle.partitions": "96", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    w = warehouse_for(spark, SF)
    w.build()
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        dated(w.fct_games(), "game_date", "season").write.partitionBy("season").parquet(f"{scratch}/fct")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    spans = []
    for f in ds.dataset(f"{scratch}/fct", partitioning="hive").get_fragments():
        d = f.to_table(columns=["game_date"])["game_date"].to_pylist()
        assert d == sorted(d)
        spans.append((d[0], d[-1]))
    assert len(spans) > 20
    narrow = [s for s in spans if (s[1] - s[0]).days < 200]
    assert len(narrow) > len(spans) / 2  # a season has 365 days


def test_loading_in_date_order_shuffles_nothing(spark):
    from courtside.plans.warehouse import dated
    from courtside.sources.fixture import read_table
    orders = read_table(spark, SF, "orders").select("o_orderkey", "o_orderdate")
    plan = _plan(dated(orders, "o_orderdate"))
    assert "Sort [o_orderdate" in plan and "Exchange" not in plan
