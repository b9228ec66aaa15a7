"""A customer holding a third of all orders: the orders-customer join is split
by AQE and the team models stay correct (their aggregates combine map-side)."""

from pyspark.sql import functions as F

from courtside.plans import models
from courtside.sources.fixture import games_from_orders, read_table

SF = "/root/testdata/sf0.01"
SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _skewed_orders(spark):
    o = read_table(spark, SF, "orders")
    # every third order moves to customer 1 (derived from the given table)
    return o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("long"))
                        .otherwise(F.col("o_custkey")))


def test_hot_customer_join_is_split_and_correct(spark):
    saved = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        # a large table has many splits; the small one has a single row group, and AQE splits a
        # hot partition by the tasks that wrote it
        orders, customer = _skewed_orders(spark).repartition(8), read_table(spark, SF, "customer")
        games = games_from_orders(orders, customer)
        got = games.groupBy("hk").agg(F.count(F.lit(1)).alias("n"), F.sum("home_score").alias("s"))
        rows = sorted(map(tuple, got.collect()))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "skew=true" in plan  # the hot partition was split
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # same answer with the default plan (broadcast customer)
    games = games_from_orders(_skewed_orders(spark), read_table(spark, SF, "customer"))
    want = sorted(map(tuple, games.groupBy("hk").agg(
        F.count(F.lit(1)).alias("n"), F.sum("home_score").alias("s")).collect()))
    assert rows == want
    hot = orders.filter("o_custkey = 1").count()
    assert hot * 3 >= orders.count() - 3


def test_team_summary_with_hot_team(spark):
    """One team code on a third of the games: the side summary equals a direct count."""
    from courtside.sources.fixture import rated_elo
    elo = rated_elo(spark, SF).withColumn(
        "team1", F.when(F.col("game_id") % 3 == 0, F.lit("NATION_0")).otherwise(F.col("team1")))
    games = models.stg_games(elo)
    summary = models.side_summary(games)
    got = {r.team_code: r.n for r in summary.groupBy("team_code").agg(
        F.sum("games").alias("n")).collect()}
    sides = games.select(F.explode(F.array("home_team", "away_team")).alias("c"))
    want = {r.c: r["count"] for r in sides.groupBy("c").count().collect()}
    assert got == want and got["NATION_0"] * 3 >= games.count()
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # combined map-side before the shuffle
