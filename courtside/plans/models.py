"""The transformation models: raw.elo -> stg_games -> stg_teams / fct_games / dim_teams.

Each function takes and returns DataFrames; nothing is collected. Lookups
(aliases, the team map) are joined as their bytes decide;
the game table itself is never broadcast or shuffled except by aggregation,
which Spark pre-aggregates map-side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtside.functions import bands
from courtside.functions.dates import game_id_date_part
from courtside.operators.joins import lookup_join
from courtside.operators.unpivot import distinct_codes, explode_sides
from courtside.schemas import (DIM_TEAMS_COLUMNS, FCT_GAMES_COLUMNS, STG_GAMES_COLUMNS,
                               STG_TEAMS_COLUMNS)

# ---- fixed values: placeholder ratings for games without ratings ----------
PLACEHOLDER_PRE = 1500.0
PLACEHOLDER_PROB = 0.5
PLACEHOLDER_WIN_POST = 1515.0
PLACEHOLDER_LOSS_POST = 1485.0
# ---- end of fixed values ----------------------------------------------------


def raw_elo(raw_games: DataFrame) -> DataFrame:
    """Game-level rating table from completed API games, with placeholder ratings."""
    g = raw_games.filter(F.col("status") == "Final")
    home, away = F.col("home_team_score"), F.col("visitor_team_score")
    pre, prob = F.lit(PLACEHOLDER_PRE), F.lit(PLACEHOLDER_PROB)
    return g.select(
        "game_id",
        F.to_date("date").alias("date"),
        "season",
        F.lit(0).alias("neutral"),
        bands.bool_flag("postseason").alias("playoff"),
        F.col("home_team_abbreviation").alias("team1"),
        F.col("visitor_team_abbreviation").alias("team2"),
        pre.alias("elo1_pre"), pre.alias("elo2_pre"),
        prob.alias("elo_prob1"), prob.alias("elo_prob2"),
        F.when(home > away, PLACEHOLDER_WIN_POST).otherwise(PLACEHOLDER_LOSS_POST).alias("elo1_post"),
        F.when(away > home, PLACEHOLDER_WIN_POST).otherwise(PLACEHOLDER_LOSS_POST).alias("elo2_post"),
        home.alias("score1"),
        away.alias("score2"),
    )


def stg_games(elo: DataFrame) -> DataFrame:
    """One row per game with differences, winner flags, rating changes and a text id."""
    g = elo.filter(F.col("date").isNotNull() & F.col("team1").isNotNull()
                   & F.col("team2").isNotNull())
    hs, as_ = F.col("score1"), F.col("score2")
    return g.select(
        F.concat(game_id_date_part(F.col("date")), F.lit("_"), F.col("team1"), F.lit("_"),
                 F.col("team2")).alias("game_id"),
        F.col("date").alias("game_date"),
        "season", "neutral", "playoff",
        F.col("team1").alias("home_team"),
        F.col("team2").alias("away_team"),
        hs.alias("home_score"),
        as_.alias("away_score"),
        (hs - as_).alias("home_score_diff"),
        (as_ - hs).alias("away_score_diff"),
        bands.win_flag(hs, as_).alias("home_win_flag"),
        bands.win_flag(as_, hs).alias("away_win_flag"),
        F.col("elo1_pre").alias("home_elo_pre"),
        F.col("elo2_pre").alias("away_elo_pre"),
        F.col("elo1_post").alias("home_elo_post"),
        F.col("elo2_post").alias("away_elo_post"),
        (F.col("elo1_post") - F.col("elo1_pre")).alias("home_elo_change"),
        (F.col("elo2_post") - F.col("elo2_pre")).alias("away_elo_change"),
        F.col("elo_prob1").alias("home_win_prob"),
        F.col("elo_prob2").alias("away_win_prob"),
    ).select(*STG_GAMES_COLUMNS)


# ---- team codes and aliases --------------------------------------------------

def resolve_aliases(aliases: DataFrame) -> DataFrame:
    """One alias row per code: the smallest (current_team_code, team_name).

    A seed listing one code twice would otherwise duplicate every game of
    that code in each join below.
    """
    best = F.min(F.struct("current_team_code", "team_name")).alias("best")
    return (aliases.filter(F.col("team_code").isNotNull()).groupBy("team_code").agg(best)
            .select("team_code", "best.team_name", "best.current_team_code"))


def alias_duplicates(aliases: DataFrame) -> DataFrame:
    """Seed codes listed more than once (each fans out a join by its count)."""
    return (aliases.groupBy("team_code").agg(F.count(F.lit(1)).alias("alias_rows"))
            .filter(F.col("alias_rows") > 1))


def name_codes(codes: DataFrame, resolved: DataFrame, alias_rows: int) -> DataFrame:
    """team_code -> team_name, current_team_code, team_id (the code when unaliased)."""
    j = lookup_join(codes, resolved, "team_code", "left", small_rows=alias_rows)
    return j.select(
        "team_code",
        F.coalesce(resolved["team_name"], F.col("team_code")).alias("team_name"),
        F.coalesce(resolved["current_team_code"], F.col("team_code")).alias("current_team_code"),
        F.coalesce(resolved["current_team_code"], F.col("team_code")).alias("team_id"),
    )


def all_teams(games: DataFrame) -> DataFrame:
    """Distinct team codes that appear on either side of a game."""
    return distinct_codes(games, ["home_team", "away_team"], "team_code")


def side_summary(games: DataFrame) -> DataFrame:
    """Per (team code, season): everything the team models need, in one scan.

    Each game becomes its home and away rows. Activity counts both rows (as
    the reference's UNION ALL does); the performance measures skip the away
    row of a game whose two codes are equal, because the reference's
    ``code = home OR code = away`` join matches such a game once. The
    result has at most codes x seasons rows whatever the number of games,
    and Spark aggregates it partially before the shuffle, so a team or
    season holding a large share of the games costs no more than any other.
    """
    sides = explode_sides(games, ["game_date", "season"], {
        "HOME": {"team_code": F.col("home_team"), "win": F.col("home_win_flag"),
                 "elo_post": F.col("home_elo_post"), "same": F.lit(False)},
        "AWAY": {"team_code": F.col("away_team"), "win": F.col("away_win_flag"),
                 "elo_post": F.col("away_elo_post"),
                 "same": F.coalesce(F.col("home_team") == F.col("away_team"), F.lit(False))},
    })
    counted = ~F.col("same")
    elo = F.when(counted, F.col("elo_post"))
    return sides.groupBy("team_code", "season").agg(
        F.min("game_date").alias("first_game_date"),
        F.max("game_date").alias("last_game_date"),
        F.count(F.lit(1)).alias("games"),
        F.count_if(counted).alias("perf_games"),
        F.sum(F.when(counted, F.col("win")).otherwise(0)).alias("wins"),
        F.sum(elo).alias("elo_sum"),
        F.count(elo).alias("elo_cnt"),
        F.max(elo).alias("elo_max"))


def _named(summary: DataFrame, resolved: DataFrame, alias_rows: int) -> DataFrame:
    """Summary rows with team_name, current_team_code and the canonical team_id."""
    j = lookup_join(summary, resolved, "team_code", "left", small_rows=alias_rows)
    cur = F.coalesce(resolved["current_team_code"], F.col("team_code"))
    return j.select(summary["*"],
                    F.coalesce(resolved["team_name"], F.col("team_code")).alias("team_name"),
                    cur.alias("current_team_code"), cur.alias("team_id"))


def _activity_aggs() -> list:
    return [F.min("first_game_date").alias("first_game_date"),
            F.max("last_game_date").alias("last_game_date"),
            F.countDistinct("season").alias("seasons_played"),
            F.sum("games").cast("bigint").alias("total_games")]


def _performance_aggs() -> list:
    return [F.sum("perf_games").cast("bigint").alias("games_analyzed"),
            F.sum("wins").cast("bigint").alias("total_wins"),
            (F.sum("elo_sum") / F.nullif(F.sum("elo_cnt"), F.lit(0))).alias("avg_elo_rating"),
            F.max("elo_max").alias("peak_elo_rating")]


def team_activity(summary: DataFrame, resolved: DataFrame, alias_rows: int) -> DataFrame:
    """Per canonical team id: first / last game, distinct seasons, games (home + away)."""
    return _named(summary, resolved, alias_rows).groupBy("team_id").agg(*_activity_aggs())


def stg_teams_as_written(summary: DataFrame, aliases: DataFrame, alias_rows: int,
                         as_of: dt.date) -> DataFrame:
    """``stg_teams`` over the unresolved seed, with the reference's fan-out.

    A code listed n times in the seed matches n alias rows, so each of its
    game sides is counted once per row (under each row's team id), as the
    reference's join does. Kept for parity; the contract models use
    :func:`resolve_aliases` first.
    """
    return stg_teams(summary, aliases, alias_rows, as_of)


def team_performance(summary: DataFrame, resolved: DataFrame, alias_rows: int) -> DataFrame:
    """Games, wins and ratings per team id over every game any of its codes played."""
    return _named(summary, resolved, alias_rows).groupBy("team_id").agg(*_performance_aggs())


def stg_teams(summary: DataFrame, resolved: DataFrame, alias_rows: int,
              as_of: dt.date) -> DataFrame:
    """One row per team code with its canonical id, names and the id's activity.

    The id's activity is a window over the (code, season) summary - a few
    rows per team - so codes and activity come from a single scan.
    """
    w = Window.partitionBy("team_id")
    n = _named(summary, resolved, alias_rows)
    return n.select(
        "team_id", "team_code", "team_name", "current_team_code",
        F.min("first_game_date").over(w).alias("first_game_date"),
        F.max("last_game_date").over(w).alias("last_game_date"),
        F.size(F.collect_set("season").over(w)).cast("bigint").alias("seasons_played"),
        F.sum("games").over(w).cast("bigint").alias("total_games"),
    ).distinct().withColumn("is_active", bands.is_active("last_game_date", as_of)) \
        .select(*STG_TEAMS_COLUMNS)


def _dim_measures(perf_cols) -> list:
    wins, games, avg_elo, peak = perf_cols
    return [
        wins.alias("total_wins"),
        F.round(wins * F.lit(100.0) / F.nullif(games, F.lit(0)), 2).alias("historical_win_rate"),
        F.round(avg_elo, 1).alias("avg_elo_rating"),
        F.round(peak, 1).alias("peak_elo_rating"),
    ]


def dim_teams(summary: DataFrame, resolved: DataFrame, alias_rows: int, as_of: dt.date,
              eastern, western) -> DataFrame:
    """Team dimension, exactly one row per team id, in one aggregation.

    When several codes share an id, the code equal to the id names the team
    (else the smallest code); activity and performance are per id.
    """
    pick = F.min_by(F.struct("team_name", "current_team_code"),
                    F.struct(F.col("team_code") != F.col("team_id"), F.col("team_code")))
    per = (_named(summary, resolved, alias_rows).groupBy("team_id")
           .agg(pick.alias("nm"), *_activity_aggs(), *_performance_aggs()))
    return per.select(
        "team_id",
        F.col("nm.team_name").alias("team_name"),
        F.col("nm.current_team_code").alias("current_team_code"),
        bands.conference_of(F.col("team_id"), eastern, western).alias("conference"),
        "first_game_date", "last_game_date", "seasons_played", "total_games",
        *_dim_measures((F.col("total_wins"), F.col("games_analyzed"),
                        F.col("avg_elo_rating"), F.col("peak_elo_rating"))),
        bands.is_active("last_game_date", as_of).alias("is_active"),
    ).select(*DIM_TEAMS_COLUMNS)


def dim_teams_as_written(teams: DataFrame, performance: DataFrame, eastern,
                         western) -> DataFrame:
    """The dimension with the reference's row multiplicity (kept for parity checks).

    Codes sharing an id give several base rows, and the reference then joins
    a per-code conference lookup on the id, so each of an id's n rows comes
    out n times. The conference is a function of the id, so the same result
    is produced by repeating each row n times - no self-join on the id.
    """
    copies = F.count(F.lit(1)).over(Window.partitionBy("team_id"))
    p = performance.alias("p")
    j = teams.withColumn("_copies", copies).join(p, "team_id", "left")
    return j.select(
        "team_id", "team_name", "current_team_code",
        bands.conference_of(F.col("team_id"), eastern, western).alias("conference"),
        "first_game_date", "last_game_date", "seasons_played", "total_games",
        *_dim_measures((F.col("p.total_wins"), F.col("p.games_analyzed"),
                        F.col("p.avg_elo_rating"), F.col("p.peak_elo_rating"))),
        "is_active",
        F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"),
    ).select(*DIM_TEAMS_COLUMNS)


def fct_games(games: DataFrame, resolved: DataFrame, alias_rows: int, extra: tuple = ()) -> DataFrame:
    """One row per team per game with outcome, expectation and impact labels (and, as ``extra``, ``neutral``).

    Both team ids are resolved on the game row (two lookups), then
    the row is exploded into its home and away perspectives - one scan, no
    shuffle anywhere in this model.
    """
    amap = resolved.select("team_code", "current_team_code")
    home_map = amap.select(F.col("team_code").alias("home_team"),
                           F.col("current_team_code").alias("_home_id"))
    away_map = amap.select(F.col("team_code").alias("away_team"),
                           F.col("current_team_code").alias("_away_id"))
    g = lookup_join(games, home_map, "home_team", "left", small_rows=alias_rows)
    g = lookup_join(g, away_map, "away_team", "left", small_rows=alias_rows)
    g = (g.withColumn("_home_id", F.coalesce("_home_id", "home_team"))
         .withColumn("_away_id", F.coalesce("_away_id", "away_team")))

    def side(prefix: str, other: str, label: str) -> dict:
        return {
            "team_id": F.col(f"_{prefix}_id"),
            "opponent_id": F.col(f"_{other}_id"),
            "game_location": F.lit(label),
            "score_for": F.col(f"{prefix}_score"),
            "score_against": F.col(f"{other}_score"),
            "score_diff": F.col(f"{prefix}_score_diff"),
            "win_flag": F.col(f"{prefix}_win_flag"),
            "elo_pre": F.col(f"{prefix}_elo_pre"),
            "elo_post": F.col(f"{prefix}_elo_post"),
            "elo_change": F.col(f"{prefix}_elo_change"),
            "win_probability": F.col(f"{prefix}_win_prob"),
        }

    rows = explode_sides(g, ["game_id", "game_date", "season", "neutral", "playoff"],
                         {"HOME": side("home", "away", "HOME"),
                          "AWAY": side("away", "home", "AWAY")})
    return rows.select(
        F.concat(F.col("game_id"), F.lit("_"), F.col("team_id")).alias("game_team_id"),
        "game_id", "team_id", "opponent_id", "game_date", "season", "game_location",
        bands.adjusted_location(F.col("neutral"), F.col("game_location"))
        .alias("adjusted_game_location"),
        "playoff", "score_for", "score_against", "score_diff", "win_flag", "elo_pre",
        "elo_post", "elo_change", "win_probability",
        bands.outcome_band(F.col("score_diff")).alias("game_outcome_type"),
        bands.performance_vs_expectation(F.col("win_flag"), F.col("win_probability"))
        .alias("performance_vs_expectation"),
        bands.game_impact(F.col("elo_change")).alias("game_impact"), "neutral",
    ).select(*FCT_GAMES_COLUMNS, *extra)
