"""Explicit schemas for every stored or landed table (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- raw tables (full-refresh loads) -----------------------------------

RAW_TEAMS = _struct(
    ("team_id", _I), ("abbreviation", _S), ("city", _S), ("conference", _S),
    ("division", _S), ("full_name", _S), ("name", _S))

RAW_GAMES = _struct(
    ("game_id", _L), ("date", T.TimestampType()), ("home_team_id", _I),
    ("home_team_abbreviation", _S), ("home_team_name", _S), ("home_team_score", _I),
    ("visitor_team_id", _I), ("visitor_team_abbreviation", _S), ("visitor_team_name", _S),
    ("visitor_team_score", _I), ("period", _I), ("postseason", _B), ("season", _I),
    ("status", _S), ("time", _S))

PLAYER_STAT_COLUMNS = ["fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb",
                       "ast", "stl", "blk", "turnover", "pf", "pts", "fg_pct", "fg3_pct",
                       "ft_pct"]

RAW_PLAYER_STATS = _struct(
    ("player_id", _I), ("season", _I), ("games_played", _I), ("min", _S),
    *[(c, _D) for c in PLAYER_STAT_COLUMNS])

RAW_ELO = _struct(
    ("game_id", _L), ("date", T.DateType()), ("season", _I), ("neutral", _I), ("playoff", _I),
    ("team1", _S), ("team2", _S), ("elo1_pre", _D), ("elo2_pre", _D), ("elo_prob1", _D),
    ("elo_prob2", _D), ("elo1_post", _D), ("elo2_post", _D), ("score1", _I), ("score2", _I))

# Declared source with no loader; types are not given, so strings except the
# obvious numerics.
RAW_ALLTIME_RATINGS = _struct(
    ("gameorder", _L), ("game_id", _S), ("lg_id", _S), ("date", _S), ("franch_id", _S),
    ("opp_franch", _S), ("elo_i", _D), ("elo_n", _D), ("win_equiv", _D), ("opp_id", _S),
    ("opp_elo_i", _D), ("opp_elo_n", _D), ("game_location", _S), ("game_result", _S),
    ("forecast", _D), ("notes", _S))

TEAM_ALIASES = _struct(("team_code", _S), ("team_name", _S), ("current_team_code", _S))

# ---- API pages (landed JSON) -------------------------------------------

_TEAM_REF = _struct(("id", _I), ("abbreviation", _S), ("full_name", _S))
PAGE_META = _struct(("current_page", _L), ("total_pages", _I))

API_TEAM = _struct(("id", _I), ("abbreviation", _S), ("city", _S), ("conference", _S),
                   ("division", _S), ("full_name", _S), ("name", _S))
API_GAME = _struct(
    ("id", _L), ("date", _S), ("home_team", _TEAM_REF), ("home_team_score", _I),
    ("visitor_team", _TEAM_REF), ("visitor_team_score", _I), ("period", _I),
    ("postseason", _B), ("season", _I), ("status", _S), ("time", _S))
API_PLAYER_STAT = _struct(
    ("player_id", _I), ("season", _I), ("games_played", _I), ("min", _S),
    *[(c, _D) for c in PLAYER_STAT_COLUMNS])


def page_of(item: T.StructType) -> T.StructType:
    return _struct(("data", T.ArrayType(item)), ("meta", PAGE_META))


TEAMS_PAGE = page_of(API_TEAM)
GAMES_PAGE = page_of(API_GAME)
PLAYER_STATS_PAGE = page_of(API_PLAYER_STAT)

# ---- model column orders (final projections) ---------------------------

STG_GAMES_COLUMNS = [
    "game_id", "game_date", "season", "neutral", "playoff", "home_team", "away_team",
    "home_score", "away_score", "home_score_diff", "away_score_diff", "home_win_flag",
    "away_win_flag", "home_elo_pre", "away_elo_pre", "home_elo_post", "away_elo_post",
    "home_elo_change", "away_elo_change", "home_win_prob", "away_win_prob"]

STG_TEAMS_COLUMNS = [
    "team_id", "team_code", "team_name", "current_team_code", "first_game_date",
    "last_game_date", "seasons_played", "total_games", "is_active"]

DIM_TEAMS_COLUMNS = [
    "team_id", "team_name", "current_team_code", "conference", "first_game_date",
    "last_game_date", "seasons_played", "total_games", "total_wins", "historical_win_rate",
    "avg_elo_rating", "peak_elo_rating", "is_active"]

FCT_GAMES_COLUMNS = [
    "game_team_id", "game_id", "team_id", "opponent_id", "game_date", "season",
    "game_location", "adjusted_game_location", "playoff", "score_for", "score_against",
    "score_diff", "win_flag", "elo_pre", "elo_post", "elo_change", "win_probability",
    "game_outcome_type", "performance_vs_expectation", "game_impact"]
