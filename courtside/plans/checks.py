"""The reference's declared data contracts, bound to the models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions import bands
from courtside.operators import quality as Q
from courtside.operators.exact_sum import exact_sum

# ---- fixed values: declared contracts ------------------------------------
NOT_NULL = {
    "stg_games": ["game_id", "game_date", "home_team", "away_team"],
    "stg_teams": ["team_id", "team_name"],
    "dim_teams": ["team_id", "team_name", "is_active"],
    "fct_games": ["game_team_id", "game_id", "team_id", "opponent_id", "win_flag",
                  "game_location", "playoff", "score_for", "score_against", "elo_pre",
                  "elo_post"],
}
ACCEPTED = [
    ("dim_teams", "conference", bands.CONFERENCES),
    ("fct_games", "win_flag", (0, 1)),
    ("fct_games", "game_location", ("HOME", "AWAY")),
    ("fct_games", "playoff", (0, 1)),
]
MIN_ROW_COUNT = 1000
EXPECTED_COLUMNS = {
    "elo": ["date", "team1", "team2", "elo1_pre", "elo2_pre", "elo1_post", "elo2_post"],
    "alltime_ratings": ["date", "team", "elo", "game_id"],
}
RATING_ZERO_SUM_TOLERANCE = 0.01
# ---- end of fixed values ----------------------------------------------------


def not_null_report(models: dict[str, DataFrame]) -> DataFrame:
    parts = [Q.null_counts(models[m], cols, m) for m, cols in NOT_NULL.items() if m in models]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def accepted_values_report(models: dict[str, DataFrame]) -> DataFrame:
    """All accepted-value checks, one scan per table."""
    by_model: dict[str, list] = {}
    for m, c, vals in ACCEPTED:
        if m in models:
            by_model.setdefault(m, []).append((c, vals))
    parts = [Q.accepted_values_many(models[m], specs, m) for m, specs in by_model.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def per_game_summary(fct: DataFrame) -> DataFrame:
    """Rows, rating-change sum and wins per game: the input of all three per-game
    rules, so they cost one shuffle of the fact together (map-side combined)."""
    return fct.groupBy("game_id").agg(
        F.count(F.lit(1)).alias("team_count"),
        exact_sum("elo_change").alias("total_elo_change"),
        F.sum("win_flag").cast("bigint").alias("total_wins"))


def two_teams_violations(per_game: DataFrame) -> DataFrame:
    return per_game.filter(F.col("team_count") != 2).select("game_id", "team_count")


def zero_sum_violations(per_game: DataFrame) -> DataFrame:
    return per_game.filter(F.abs("total_elo_change") > RATING_ZERO_SUM_TOLERANCE).select(
        "game_id", "total_elo_change")


def one_winner_violations(per_game: DataFrame) -> DataFrame:
    return per_game.filter(F.col("total_wins") != 1).select("game_id", "total_wins")


def games_have_two_teams(fct: DataFrame) -> DataFrame:
    return two_teams_violations(per_game_summary(fct))


def rating_changes_sum_to_zero(fct: DataFrame) -> DataFrame:
    return zero_sum_violations(per_game_summary(fct))


def one_winner_per_game(fct: DataFrame) -> DataFrame:
    return one_winner_violations(per_game_summary(fct))


def scores_match_outcome(fct: DataFrame) -> DataFrame:
    w, d = F.col("win_flag"), F.col("score_diff")
    return fct.filter(((w == 1) & (d <= 0)) | ((w == 0) & (d >= 0)))


def null_scores(raw_games: DataFrame) -> DataFrame:
    """Completed games missing a score (one summary row)."""
    final = F.col("status") == "Final"
    missing = F.col("home_team_score").isNull() | F.col("visitor_team_score").isNull()
    return raw_games.agg(F.count_if(final).alias("final_games"),
                         F.count_if(final & missing).alias("null_score_games"))


def date_range(raw_games: DataFrame) -> DataFrame:
    d = F.to_date("date")
    return raw_games.agg(F.min(d).alias("earliest"), F.max(d).alias("latest"),
                         F.countDistinct(d).alias("unique_dates"))
