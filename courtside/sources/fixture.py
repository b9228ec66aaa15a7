"""Game data derived from the TPC-H-like test tables.

Games are orders; the home team is the customer's nation and the visitor a
second nation picked from the order key, so every engine that evaluates the
same expressions sees the same games. Only the columns a model needs are
read (the scans are pruned to them), and the orders-customer join is left
to the planner: AQE broadcasts customer when its runtime size is small and
otherwise shuffles both sides, splitting a hot customer key with skew join.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions.dates import season_of_date


@dataclass(frozen=True)
class FixtureParams:
    """Lookups and dates that the reference takes from its environment."""

    # Alias rows (team_code, team_name, current_team_code): two codes share one id.
    aliases: tuple = (("NATION_24", "Nation Twenty-Four", "NATION_23"),
                      ("NATION_3", "Nation Three", "NATION_3"))
    # Conference by region: regions 0 and 1 Eastern, 2 and 3 Western.
    eastern: tuple = field(default_factory=lambda: tuple(
        f"NATION_{k}" for k in range(25) if k % 5 in (0, 1)))
    western: tuple = field(default_factory=lambda: tuple(
        f"NATION_{k}" for k in range(25) if k % 5 in (2, 3)))
    as_of: dt.date = dt.date(2001, 8, 1)           # "today" for date-range filters
    activity_as_of: dt.date = dt.date(2003, 7, 28)  # "today" for is_active
    fetch_days: int = 30                             # default fetch window (days)


DEFAULT_PARAMS = FixtureParams()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _base_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games_from_orders(read_table(spark, sf_dir, "orders"),
                             read_table(spark, sf_dir, "customer"))


def games_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders joined to their customers' nations, as game rows (fixture mapping)."""
    orders = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                           "o_orderdate", "o_orderpriority")
    customer = customer.select("c_custkey", "c_nationkey")
    g = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    hk = F.col("c_nationkey")
    vk = (F.col("c_nationkey") + 1 + F.col("o_orderkey") % 24) % 25
    return g.select(
        F.col("o_orderkey").alias("game_id"),
        F.col("o_orderdate"),
        hk.cast("int").alias("hk"),
        vk.cast("int").alias("vk"),
        (80 + F.floor("o_totalprice").cast("bigint") % 61).cast("int").alias("home_score"),
        (80 + (F.col("o_custkey") * 31 + F.col("o_orderkey")) % 61).cast("int").alias("away_score"),
        (F.col("o_orderpriority") == "1-URGENT").alias("postseason"),
        (F.col("o_orderpriority") == "5-LOW").alias("neutral_court"),
        F.when(F.col("o_orderstatus") == "F", "Final").otherwise("Scheduled").alias("status"),
    )


def _code(k) -> F.Column:
    return F.concat(F.lit("NATION_"), k.cast("string"))


def base_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined game rows every raw table is projected from (one join pass)."""
    return _base_games(spark, sf_dir)


def raw_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw.games`` (API layout) for every order."""
    return raw_games_from(_base_games(spark, sf_dir))


def raw_games_from(g: DataFrame) -> DataFrame:
    """``raw.games`` as a projection of :func:`base_games` rows."""
    return g.select(
        F.col("game_id"),
        F.col("o_orderdate").cast("timestamp").alias("date"),
        F.col("hk").alias("home_team_id"),
        _code(F.col("hk")).alias("home_team_abbreviation"),
        _code(F.col("hk")).alias("home_team_name"),
        F.col("home_score").alias("home_team_score"),
        F.col("vk").alias("visitor_team_id"),
        _code(F.col("vk")).alias("visitor_team_abbreviation"),
        _code(F.col("vk")).alias("visitor_team_name"),
        F.col("away_score").alias("visitor_team_score"),
        F.lit(4).alias("period"),
        F.col("postseason"),
        season_of_date(F.col("o_orderdate")).alias("season"),
        F.col("status"),
        F.lit("").alias("time"),
    )


def rated_elo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw.elo`` with real-looking ratings (every band is reachable).

    pre = 1500 + (k - 12) * 8, home probability 0.5 + (hk - vk) / 64,
    change = 64 * (result - probability), post = pre + change. All values are
    exact binary fractions, so sums do not depend on addition order.
    """
    return rated_elo_from(_base_games(spark, sf_dir))


def rated_elo_from(base: DataFrame) -> DataFrame:
    """Rated ``raw.elo`` as a projection of :func:`base_games` rows."""
    g = base.filter(F.col("status") == "Final")
    hk, vk = F.col("hk"), F.col("vk")
    pre1 = (1500 + (hk - 12) * 8).cast("double")
    pre2 = (1500 + (vk - 12) * 8).cast("double")
    prob1 = F.lit(0.5) + (hk - vk).cast("double") / 64
    result = (F.when(F.col("home_score") > F.col("away_score"), 1.0)
              .when(F.col("home_score") < F.col("away_score"), 0.0).otherwise(0.5))
    change1 = F.lit(64.0) * (result - prob1)
    return g.select(
        F.col("game_id"),
        F.to_date("o_orderdate").alias("date"),
        season_of_date(F.col("o_orderdate")).alias("season"),
        F.when(F.col("neutral_court"), 1).otherwise(0).alias("neutral"),
        F.when(F.col("postseason"), 1).otherwise(0).alias("playoff"),
        _code(hk).alias("team1"),
        _code(vk).alias("team2"),
        pre1.alias("elo1_pre"),
        pre2.alias("elo2_pre"),
        prob1.alias("elo_prob1"),
        (F.lit(1.0) - prob1).alias("elo_prob2"),
        (pre1 + change1).alias("elo1_post"),
        (pre2 - change1).alias("elo2_post"),
        F.col("home_score").alias("score1"),
        F.col("away_score").alias("score2"),
    )


def inline_rows(spark: SparkSession, rows, columns) -> DataFrame:
    """A small literal table built in the JVM (no Python-side row conversion)."""
    structs = [F.struct(*[F.lit(v).cast("string").alias(c) for v, c in zip(r, columns)])
               for r in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def alias_frame(spark: SparkSession, params: FixtureParams = DEFAULT_PARAMS) -> DataFrame:
    """The alias seed rows (team_code, team_name, current_team_code)."""
    return inline_rows(spark, params.aliases, ["team_code", "team_name", "current_team_code"])
