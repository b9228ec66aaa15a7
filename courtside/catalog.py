"""The registered queries: name -> (spark, sf_dir) -> DataFrame, and their SQL.

Every query reads the driver's tables (or marts Spark derived from them)
in full; none samples, caps or subsets rows except where the limit is the
feature itself (a top-k list, a preview).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside import oracle_sql as O
from courtside import schemas as S
from courtside.functions import dates as FD
from courtside.functions.bands import conference_of
from courtside.operators import quality as Q
from courtside.operators import selection
from courtside.operators.joins import lookup_join
from courtside.operators.unpivot import explode_sides
from courtside.plans import checks as C
from courtside.plans import dashboard as D
from courtside.plans import exports, models
from courtside.plans import metrics as M
from courtside.plans.warehouse import PLACEHOLDER, Warehouse, warehouse_for
from courtside.session import scratch_path
from courtside.sources import api_pages as AP
from courtside.sources import csv_tables as CSV
from courtside.sources import snapshots as SN
from courtside.sources.fixture import inline_rows
from courtside.streaming import landing as ST
from courtside.streaming import state as ST_STATE

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(warehouse_for(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = O.with_ctes(sql)
        return fn
    return deco


def _marts(w: Warehouse):
    return w.table("fct_games"), w.table("dim_teams"), w.rows("dim_teams")


# ---- models -----------------------------------------------------------------

@register("raw_elo", "SELECT * FROM elo_placeholder")
def q_raw_elo(w: Warehouse) -> DataFrame:
    """Completed games with the reference's placeholder ratings."""
    return warehouse_for(w.spark, w.sf_dir, PLACEHOLDER).derive_raw_elo()


@register("stg_games", "SELECT * FROM stg_games")
def q_stg_games(w):
    return w.stg_games()


@register("all_teams", "SELECT * FROM all_teams")
def q_all_teams(w):
    return models.all_teams(w.stg_games())


@register("team_activity", "SELECT * FROM team_activity")
def q_team_activity(w):
    return w.team_activity()


@register("stg_teams", "SELECT * FROM stg_teams")
def q_stg_teams(w):
    return w.stg_teams()


@register("team_performance", "SELECT * FROM team_performance")
def q_team_performance(w):
    return w.team_performance()


@register("dim_teams", "SELECT * FROM dim_teams")
def q_dim_teams(w):
    return w.dim_teams()


@register("dim_teams_as_written", "SELECT * FROM dim_teams_as_written")
def q_dim_teams_as_written(w):
    return w.dim_teams_as_written()


@register("fct_games", "SELECT * FROM fct_games")
def q_fct_games(w):
    return w.fct_games()


def _repeated(w) -> tuple[DataFrame, int]:
    """The alias seed with codes listed more than once, as a shipped seed may have them."""
    return inline_rows(w.spark, O.REPEATED, ["team_code", "team_name", "current_team_code"]), len(O.REPEATED)


@register("stg_teams_as_written", "SELECT * FROM stg_teams_repeated")
def q_stg_teams_as_written(w):
    """The team model over a seed that repeats codes, with the fan-out of a plain join."""
    return models.stg_teams_as_written(w.side_summary(), *_repeated(w), w.params.activity_as_of)


@register("fct_games_as_written", "SELECT * FROM fct_games_repeated")
def q_fct_games_as_written(w):
    """The fact over that team model: a game of a repeated code has more than two rows."""
    teams, n = q_stg_teams_as_written(w), 2 * len(O.REPEATED)
    return models.fct_games(w.stg_games(), teams, n)


@register("dq_two_teams_as_written", """
SELECT game_id, COUNT(DISTINCT team_id) AS team_count, COUNT(*) AS row_count
FROM fct_games_repeated GROUP BY game_id HAVING COUNT(DISTINCT team_id) <> 2 OR COUNT(*) <> 2""")
def q_dq_two_teams_as_written(w):
    """Games of that fact that break the two-teams rule."""
    per = q_fct_games_as_written(w).groupBy("game_id").agg(
        F.countDistinct("team_id").alias("team_count"), F.count(F.lit(1)).alias("row_count"))
    return per.where("team_count <> 2 OR row_count <> 2")


# ---- exports ------------------------------------------------------------------

O.CTES["win_rates_export"] = """
SELECT team_name, season, count(*) AS games_played, sum(win_flag)::BIGINT AS wins,
       round(sum(win_flag)::DOUBLE * 100 / count(*), 2) AS win_rate,
       round(avg(score_diff), 2) AS avg_point_diff
FROM fct_games JOIN (SELECT team_id, team_name FROM dim_teams) USING (team_id)
GROUP BY ALL"""


@register("team_win_rates", "SELECT * FROM win_rates_export")
def q_team_win_rates(w):
    return exports.team_win_rates(*_marts(w))


@register("elo_trends", f"""
SELECT d.team_name, f.game_date, f.season, f.elo_pre, f.elo_post, f.elo_change,
       sum(f.elo_change) OVER (PARTITION BY d.team_name ORDER BY f.game_date
                               RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           AS cumulative_elo_change
FROM fct_games f JOIN dim_teams d USING (team_id)
WHERE f.game_date >= DATE '{O.TREND_START}'""")
def q_elo_trends(w):
    fct, dim, n = _marts(w)
    return exports.elo_trends(fct, dim, w.params.as_of, n, dates=w.season_dates())


@register("point_diff_by_season", """
SELECT d.team_name, f.season, count(*) AS games,
       round(avg(f.score_diff), 2) AS avg_point_diff,
       round(stddev_samp(f.score_diff), 2) AS stddev_point_diff,
       min(f.score_diff) AS worst_loss, max(f.score_diff) AS best_win,
       quantile_cont(f.score_diff, 0.25) AS q1_point_diff,
       quantile_cont(f.score_diff, 0.5) AS median_point_diff,
       quantile_cont(f.score_diff, 0.75) AS q3_point_diff
FROM fct_games f JOIN dim_teams d USING (team_id)
GROUP BY ALL""")
def q_point_diff_by_season(w):
    return exports.point_diff_by_season(*_marts(w))


@register("export_summary", """
SELECT * FROM (VALUES ('dim_teams', (SELECT count(*) FROM dim_teams)),
                      ('fct_games', (SELECT count(*) FROM fct_games))) v(table_name, row_count)""")
def q_export_summary(w):
    return exports.export_summary({"dim_teams": w.table("dim_teams"),
                                   "fct_games": w.table("fct_games")})


# ---- data quality -------------------------------------------------------------



def _nn_sql() -> str:
    parts = []
    for model, cols in C.NOT_NULL.items():
        for c in cols:
            parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, "
                         f"COUNT(*) AS row_count, COUNT(*) - COUNT({c}) AS null_count "
                         f"FROM {model}")
    return "\nUNION ALL\n".join(parts)


@register("dq_not_null", _nn_sql())
def q_dq_not_null(w):
    return C.not_null_report({"stg_games": w.stg_games(), "stg_teams": w.stg_teams(),
                              "dim_teams": w.table("dim_teams"),
                              "fct_games": w.table("fct_games")})


@register("dq_unique_game_id", """
SELECT game_id, COUNT(*) AS n_records FROM stg_games WHERE game_id IS NOT NULL
GROUP BY game_id HAVING COUNT(*) > 1""")
def q_dq_unique_game_id(w):
    return Q.duplicate_keys(w.stg_games(), "game_id")


@register("dq_unique_team_id_stg", """
SELECT team_id, COUNT(*) AS n_records FROM stg_teams WHERE team_id IS NOT NULL
GROUP BY team_id HAVING COUNT(*) > 1""")
def q_dq_unique_team_id_stg(w):
    return Q.duplicate_keys(w.stg_teams(), "team_id")


@register("dq_unique_team_id_dim", """
SELECT team_id, COUNT(*) AS n_records FROM dim_teams_as_written WHERE team_id IS NOT NULL
GROUP BY team_id HAVING COUNT(*) > 1""")
def q_dq_unique_team_id_dim(w):
    """On the dimension as the reference joins it (the contract one is unique by build)."""
    return Q.duplicate_keys(w.dim_teams_as_written(), "team_id")


@register("dq_unique_game_team_id", """
SELECT game_team_id, COUNT(*) AS n_records FROM fct_games WHERE game_team_id IS NOT NULL
GROUP BY game_team_id HAVING COUNT(*) > 1""")
def q_dq_unique_game_team_id(w):
    return Q.duplicate_text_keys(w.table("fct_games"), "game_team_id")


def _accepted_sql() -> str:
    parts = []
    for model, c, vals in C.ACCEPTED:
        lits = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in vals)
        parts.append(f"SELECT '{model}' AS model, '{c}' AS column_name, "
                     f"CAST({c} AS VARCHAR) AS value, COUNT(*) AS row_count, "
                     f"{c} IN ({lits}) AS is_accepted FROM {model} GROUP BY {c}")
    return "\nUNION ALL\n".join(parts)


@register("dq_accepted_values", _accepted_sql())
def q_dq_accepted_values(w):
    return C.accepted_values_report({"dim_teams": w.table("dim_teams"),
                                     "fct_games": w.table("fct_games")})


def _rel_sql(column: str) -> str:
    return f"""
SELECT 'fct_games' AS model, '{column}' AS column_name, COUNT(*) AS checked_rows,
       COUNT(*) FILTER (WHERE d.team_id IS NULL) AS orphan_rows
FROM fct_games f LEFT JOIN (SELECT DISTINCT team_id FROM dim_teams) d ON f.{column} = d.team_id
WHERE f.{column} IS NOT NULL"""


@register("dq_relationships_team", _rel_sql("team_id"))
def q_dq_relationships_team(w):
    return Q.relationship_summary(w.table("fct_games"), "team_id", w.table("dim_teams"),
                                  "team_id", "fct_games", w.rows("dim_teams"))


@register("dq_relationships_opponent", _rel_sql("opponent_id"))
def q_dq_relationships_opponent(w):
    return Q.relationship_summary(w.table("fct_games"), "opponent_id", w.table("dim_teams"),
                                  "team_id", "fct_games", w.rows("dim_teams"))


@register("dq_two_teams", """
SELECT game_id, count(*) AS team_count FROM fct_games GROUP BY game_id HAVING count(*) <> 2""")
def q_dq_two_teams(w):
    return C.games_have_two_teams(w.table("fct_games"))


@register("dq_rating_zero_sum", f"""
SELECT game_id, sum(elo_change) AS total_elo_change FROM fct_games_placeholder
GROUP BY game_id HAVING abs(sum(elo_change)) > {C.RATING_ZERO_SUM_TOLERANCE}""")
def q_dq_rating_zero_sum(w):
    """On placeholder ratings, where a tie gives both teams the losing rating."""
    return C.rating_changes_sum_to_zero(
        warehouse_for(w.spark, w.sf_dir, PLACEHOLDER).table("fct_games"))


@register("dq_one_winner", """
SELECT game_id, CAST(sum(win_flag) AS BIGINT) AS total_wins FROM fct_games
GROUP BY game_id HAVING sum(win_flag) <> 1""")
def q_dq_one_winner(w):
    return C.one_winner_per_game(w.table("fct_games"))


@register("dq_scores_match_outcome", """
SELECT * FROM fct_games
WHERE (win_flag = 1 AND score_diff <= 0) OR (win_flag = 0 AND score_diff >= 0)""")
def q_dq_scores_match_outcome(w):
    return C.scores_match_outcome(w.table("fct_games")).select(*S.FCT_GAMES_COLUMNS)


@register("dq_null_scores", """
SELECT COUNT(*) FILTER (WHERE status = 'Final') AS final_games,
       COUNT(*) FILTER (WHERE (home_team_score IS NULL OR visitor_team_score IS NULL)
                        AND status = 'Final') AS null_score_games
FROM raw_games""")
def q_dq_null_scores(w):
    return C.null_scores(w.raw_games())


@register("dq_date_range", """
SELECT MIN(CAST(date AS DATE)) AS earliest, MAX(CAST(date AS DATE)) AS latest,
       COUNT(DISTINCT CAST(date AS DATE)) AS unique_dates
FROM raw_games""")
def q_dq_date_range(w):
    return C.date_range(w.raw_games())


@register("dq_min_rows", f"""
SELECT table_name, row_count, CAST({C.MIN_ROW_COUNT} AS BIGINT) AS min_rows,
       row_count >= {C.MIN_ROW_COUNT} AS passed
FROM (SELECT 'raw_games' AS table_name, COUNT(*) AS row_count FROM raw_games
      UNION ALL SELECT 'stg_games', COUNT(*) FROM stg_games
      UNION ALL SELECT 'fct_games', COUNT(*) FROM fct_games)""")
def q_dq_min_rows(w):
    return Q.min_rows({"raw_games": w.raw_games(), "stg_games": w.stg_games(),
                       "fct_games": w.table("fct_games")}, C.MIN_ROW_COUNT)


@register("dq_primary_key", """
SELECT COUNT(*) AS row_count, COUNT(*) - COUNT(game_id) AS null_keys,
       (SELECT COUNT(*) FROM (SELECT game_id FROM raw_games WHERE game_id IS NOT NULL
                              GROUP BY game_id HAVING COUNT(*) > 1)) AS duplicate_keys
FROM raw_games""")
def q_dq_primary_key(w):
    return Q.primary_key_profile(w.raw_games(), "game_id")


# ---- metrics ------------------------------------------------------------------


def _metric_sql(name: str, grain: str) -> str:
    spec = M.METRICS[name]
    call = {"average": "AVG({})", "sum": "SUM({})", "derived": "{}"}[spec.calculation_method]
    expr = call.format(spec.expression.replace("100.0", "CAST(100.0 AS DOUBLE)"))
    # the fact of this SQL labels neutral games and has no flag of its own
    known = {"is_not_null": "{} IS NOT NULL", "=": "CASE adjusted_game_location WHEN 'NEUTRAL' THEN 1 ELSE 0 END = 0"}
    where = " AND ".join(known[f.operator].format(f.field) for f in spec.filters)
    dims = ", ".join(spec.dimensions)
    return (f"SELECT CAST(date_trunc('{grain}', game_date) AS DATE) AS period_start, {dims}, "
            f"{expr} AS {name} FROM fct_games {'WHERE ' + where if where else ''} "
            f"GROUP BY 1, {dims}")


def _register_metric(name: str, grain: str, key: str) -> None:
    @register(key, _metric_sql(name, grain))
    def q(w):
        return M.evaluate(w.table("fct_games"), name, grain)


for _name, _spec in M.METRICS.items():
    for _i, _grain in enumerate(_spec.time_grains):
        _register_metric(_name, _grain, f"metric_{_name}" if _i == 0 else
                         f"metric_{_name}_{_grain}")


_DIMS = ("team_id", "season", "game_location", "playoff")


def _all_metrics_sql() -> str:
    parts = []
    for name, spec in M.METRICS.items():
        for grain in spec.time_grains:
            dims = ", ".join(f"CAST({d if d in spec.dimensions else 'NULL'} AS "
                             f"{'INTEGER' if d in ('season', 'playoff') else 'VARCHAR'}) AS {d}" for d in _DIMS)
            parts.append(f"SELECT '{name}' AS metric, '{grain}' AS grain, period_start, {dims}, "
                         f"CAST({name} AS DOUBLE) AS value FROM ({_metric_sql(name, grain)})")
    return "\nUNION ALL\n".join(parts)


@register("metrics_all", _all_metrics_sql())
def q_metrics_all(w):
    """Every declared metric at every grain, merged from one scan's partial sums by day."""
    return M.evaluate_all(w.table("fct_games"))


# ---- dashboard ----------------------------------------------------------------


O.CTES["games_df"] = """
SELECT f.game_date, f.season, t.team_name, t.conference, f.win_flag, f.score_diff,
       f.elo_pre, f.elo_post, f.elo_change, f.game_location, f.playoff
FROM fct_games f JOIN dim_teams t ON f.team_id = t.team_id"""
O.CTES["win_rates_df"] = """
SELECT team_name, season, CAST(SUM(win_flag) AS BIGINT) AS wins, COUNT(*) AS games,
       ROUND(SUM(win_flag) / COUNT(*) * 100, 2) AS win_rate
FROM games_df GROUP BY team_name, season"""
O.CTES["rating_change_df"] = """
SELECT team_name, season,
       MIN(elo_pre) FILTER (WHERE game_date = d0) AS elo_pre,
       MAX(elo_post) FILTER (WHERE game_date = d1) AS elo_post,
       SUM(elo_change) AS elo_change,
       MAX(elo_post) FILTER (WHERE game_date = d1) - MIN(elo_pre) FILTER (WHERE game_date = d0)
           AS total_change
FROM (SELECT *, MIN(game_date) OVER (PARTITION BY team_name, season) AS d0,
             MAX(game_date) OVER (PARTITION BY team_name, season) AS d1 FROM games_df)
GROUP BY team_name, season"""
O.CTES["location_df"] = """
SELECT team_name, game_location AS location, CAST(SUM(win_flag) AS BIGINT) AS wins,
       COUNT(*) AS games, AVG(score_diff) AS avg_diff,
       ROUND(SUM(win_flag) / COUNT(*) * 100, 2) AS win_rate
FROM games_df GROUP BY team_name, game_location"""


#: Seasons of the test tables' completed games (1995-01-01 to 2001-08-01), for the SQL.
SEASONS = tuple(range(1994, 2001))


def _games(w):
    fct, dim, n = _marts(w)
    return D.games_filtered(fct, dim, n)


@register("teams_by_conference", """
SELECT team_id, team_name, conference, is_active, historical_win_rate, avg_elo_rating,
       peak_elo_rating, total_games FROM dim_teams ORDER BY team_name""")
def q_teams_by_conference(w):
    return D.teams_by_conference(w.table("dim_teams"))


@register("conference_list", "SELECT DISTINCT conference FROM dim_teams ORDER BY conference")
def q_conference_list(w):
    return D.conference_list(w.table("dim_teams"))


@register("season_list", "SELECT DISTINCT season FROM games_df ORDER BY season DESC LIMIT 3")
def q_season_list(w):
    return D.season_list(_games(w))


@register("default_teams", "SELECT team_name FROM dim_teams ORDER BY team_name LIMIT 5")
def q_default_teams(w):
    return D.default_teams(w.table("dim_teams"))


@register("games_filtered", "SELECT * FROM games_df ORDER BY game_date DESC")
def q_games_filtered(w):
    return D.games_ordered(w.table("fct_games"), w.table("dim_teams"))


#: A dashboard selection: some teams and the three latest seasons.
SELECTED_TEAMS = ("NATION_1", "NATION_7", "NATION_12", "Nation Three")
SELECTED_SEASONS = SEASONS[-3:]
_SELECTED = (f"team_name IN ({', '.join(repr(t) for t in SELECTED_TEAMS)}) "
             f"AND season IN ({', '.join(map(str, SELECTED_SEASONS))})")


def _selected_games(w):
    fct, dim, n = _marts(w)
    return D.games_filtered(fct, dim, n, SELECTED_TEAMS, SELECTED_SEASONS)


@register("games_filtered_selected", f"SELECT * FROM games_df WHERE {_SELECTED}")
def q_games_filtered_selected(w):
    return _selected_games(w)


@register("dash_win_rates_selected", f"SELECT * FROM win_rates_df WHERE {_SELECTED}")
def q_dash_win_rates_selected(w):
    return D.win_rates(_selected_games(w))


@register("teams_in_conference", """
SELECT team_id, team_name, conference, is_active, historical_win_rate, avg_elo_rating,
       peak_elo_rating, total_games FROM dim_teams WHERE conference = 'Eastern'""")
def q_teams_in_conference(w):
    return D.teams_by_conference(w.table("dim_teams"), "Eastern")


@register("dash_win_rates", "SELECT * FROM win_rates_df")
def q_dash_win_rates(w):
    return D.win_rates(_games(w))


@register("dash_best_season", """
SELECT * FROM win_rates_df ORDER BY win_rate DESC, team_name, season LIMIT 1""")
def q_dash_best_season(w):
    return D.best_season(D.win_rates(_games(w)))


@register("dash_summary", """
SELECT AVG(CAST(ROUND(win_rate * 100) AS BIGINT)) / 100 AS avg_win_rate,
       CAST(SUM(games) AS BIGINT) AS total_games,
       COUNT(DISTINCT team_name) AS teams_analyzed FROM win_rates_df""")
def q_dash_summary(w):
    return D.rates_summary(D.win_rates(_games(w)))


@register("team_rating_series", """
SELECT team_name, game_date, elo_post FROM games_df ORDER BY team_name, game_date""")
def q_team_rating_series(w):
    fct, dim, n = _marts(w)
    return D.rating_series(D.games_filtered(fct, dim, n, extra=(D.ROW_KEY,)), w.rows("fct_games"))


@register("season_rating_change", "SELECT * FROM rating_change_df")
def q_season_rating_change(w):
    return D.season_rating_change(_games(w))


@register("season_rating_change_as_written", """
SELECT team_name, season, MIN(elo_pre) FILTER (WHERE game_date = d1) AS elo_pre,
       MAX(elo_post) FILTER (WHERE game_date = d0) AS elo_post, SUM(elo_change) AS elo_change,
       MAX(elo_post) FILTER (WHERE game_date = d0) - MIN(elo_pre) FILTER (WHERE game_date = d1)
           AS total_change
FROM (SELECT *, MIN(game_date) OVER (PARTITION BY team_name, season) AS d0,
             MAX(game_date) OVER (PARTITION BY team_name, season) AS d1 FROM games_df)
GROUP BY team_name, season""")
def q_season_rating_change_as_written(w):
    return D.season_rating_change_as_written(_games(w))


@register("season_rating_pivot", "SELECT team_name, " + ", ".join(
    f'MAX(total_change) FILTER (WHERE season = {s}) AS "{s}"' for s in SEASONS)
    + " FROM rating_change_df GROUP BY team_name")
def q_season_rating_pivot(w):
    """A column for each season that the written fact has a folder of."""
    seasons = sorted(s for s, _ in w.season_dates() if s is not None)
    return D.season_rating_pivot(D.season_rating_change(_games(w)), seasons)


@register("point_diff_stats", """
SELECT team_name, ROUND(AVG(score_diff), 2) AS average, ROUND(STDDEV_SAMP(score_diff), 2) AS std_dev,
       MIN(score_diff) AS worst_loss, MAX(score_diff) AS best_win,
       ROUND(MEDIAN(score_diff), 2) AS median
FROM games_df GROUP BY team_name""")
def q_point_diff_stats(w):
    return D.point_diff_stats(_games(w))


@register("box_stats", """
SELECT team_name, playoff, MIN(score_diff) AS min_diff,
       PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY score_diff) AS q1_diff,
       PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY score_diff) AS median_diff,
       PERCENTILE_CONT(0.75) WITHIN GROUP (ORDER BY score_diff) AS q3_diff,
       MAX(score_diff) AS max_diff
FROM games_df GROUP BY team_name, playoff""")
def q_box_stats(w):
    return D.box_stats(_games(w))


@register("rating_percentiles", """
SELECT team_name, QUANTILE_CONT(elo_post, 0.1) AS p10_rating, QUANTILE_CONT(elo_post, 0.25) AS p25_rating,
       QUANTILE_CONT(elo_post, 0.5) AS median_rating, QUANTILE_CONT(elo_post, 0.75) AS p75_rating,
       QUANTILE_CONT(elo_post, 0.9) AS p90_rating FROM games_df GROUP BY team_name""")
def q_rating_percentiles(w):
    """Spread of the ratings: doubles, so windows of values are narrowed instead of counting each."""
    return selection.percentiles(_games(w), ["team_name"], "elo_post", {
        "p10_rating": 0.1, "p25_rating": 0.25, "median_rating": 0.5, "p75_rating": 0.75, "p90_rating": 0.9})


@register("location_stats", "SELECT * FROM location_df")
def q_location_stats(w):
    return D.location_stats(_games(w))


@register("home_advantage_pivot", """
SELECT team_name,
       MAX(win_rate) FILTER (WHERE location = 'HOME') AS home_win_rate,
       MAX(win_rate) FILTER (WHERE location = 'AWAY') AS away_win_rate,
       MAX(win_rate) FILTER (WHERE location = 'HOME') - MAX(win_rate) FILTER (WHERE location = 'AWAY')
           AS home_advantage
FROM location_df GROUP BY team_name""")
def q_home_advantage_pivot(w):
    return D.home_advantage_pivot(D.location_stats(_games(w)))


# ---- date functions --------------------------------------------------------------




@register("season_of_date", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, {O.season_sql('o_orderdate')} AS season
FROM orders""")
def q_season_of_date(w):
    o = w.source("orders")
    return o.select("o_orderkey", F.to_date("o_orderdate").alias("order_date"),
                    FD.season_of_date(F.col("o_orderdate")).alias("season"))


@register("season_bounds", """
SELECT season, CAST(CAST(season AS VARCHAR) || '-10-01' AS DATE) AS season_start,
       CAST(CAST(season + 1 AS VARCHAR) || '-06-30' AS DATE) AS season_end,
       COUNT(*) AS games,
       COUNT(*) FILTER (WHERE game_date < CAST(CAST(season AS VARCHAR) || '-10-01' AS DATE)
                        OR game_date > CAST(CAST(season + 1 AS VARCHAR) || '-06-30' AS DATE))
           AS games_outside
FROM stg_games GROUP BY season""")
def q_season_bounds(w):
    g = w.stg_games()
    start, end = FD.season_start_date(F.col("season")), FD.season_end_date(F.col("season"))
    out = (g.groupBy("season").agg(
        F.count(F.lit(1)).alias("games"),
        F.count_if((F.col("game_date") < start) | (F.col("game_date") > end)).alias("games_outside")))
    return out.select("season", start.alias("season_start"), end.alias("season_end"), "games",
                      "games_outside")


@register("days_between", f"""
SELECT o_orderkey, CAST(date_diff('day', o_orderdate, TIMESTAMP '{O.AS_OF} 00:00:00') AS BIGINT) AS days_to_as_of
FROM orders""")
def q_days_between(w):
    o = w.source("orders")
    return o.select("o_orderkey", FD.days_between(F.col("o_orderdate"),
                                                  F.lit(w.params.as_of)).alias("days_to_as_of"))


# ---- sources and sinks --------------------------------------------------------------


def _range_bounds(w):
    end = dt.datetime.combine(w.params.as_of, dt.time())
    return end - dt.timedelta(days=w.params.fetch_days), end


def _games_in_range(w) -> DataFrame:
    return w.raw_games(*_range_bounds(w))


def _landing_csv(w) -> str:
    """raw.games written once as a CSV snapshot (the fetch step's output)."""
    def make():
        base = scratch_path(w.spark, "landing-csv")
        SN.write_snapshot(w.raw_games(), base, "games", "19000101_000000")
        return base
    return w.once("landing_csv", make)


_DAYS = O.P.fetch_days
# A CSV load turns empty fields into NULL (the empty `time` included).
O.CTES["raw_games_loaded"] = "SELECT * REPLACE (NULLIF(time, '') AS time) FROM raw_games"
_RANGE_SQL = (f"SELECT * FROM raw_games WHERE date BETWEEN TIMESTAMP '{O.AS_OF} 00:00:00' "
              f"- INTERVAL {_DAYS} DAY AND TIMESTAMP '{O.AS_OF} 00:00:00'")


@register("raw_games", "SELECT * FROM raw_games_loaded")
def q_raw_games(w):
    """Typed CSV load of the games snapshot (header, empty = NULL, fail fast)."""
    return CSV.read_games(w.spark, f"{_landing_csv(w)}/games/{SN.SNAPSHOT_COL}=19000101_000000")


@register("games_in_range", _RANGE_SQL)
def q_games_in_range(w):
    """Games dated within the fetch window ending at as_of."""
    return _games_in_range(w)


@register("latest_snapshot", _RANGE_SQL.replace("FROM raw_games", "FROM raw_games_loaded"))
def q_latest_snapshot(w):
    """Two fetches land as snapshots (older games, then the last window); read the latest."""
    def make():
        base = scratch_path(w.spark, "landing-snapshots")
        start, _ = _range_bounds(w)
        SN.write_snapshot(w.raw_games().filter(F.col("date") < F.lit(start)), base,
                          "games", "20010101_030000")
        SN.write_snapshot(_games_in_range(w), base, "games", "20010801_030000")
        return base
    base = w.once("landing_snapshots", make)
    return SN.read_latest(w.spark, base, "games", S.RAW_GAMES)


@register("latest_season", "SELECT MAX(season) AS latest_season FROM raw_games")
def q_latest_season(w):
    return w.raw_games().agg(F.max("season").alias("latest_season"))


@register("seed_scan", """
SELECT t.team_code, COALESCE(a.team_name, t.team_code) AS team_name,
       COALESCE(a.current_team_code, t.team_code) AS current_team_code
FROM all_teams t LEFT JOIN team_aliases a ON t.team_code = a.team_code""")
def q_seed_scan(w):
    """A seed of every team code, landed as CSV and scanned with the seed's schema."""
    def make():
        path = scratch_path(w.spark, "landing-seed")
        rows = models.all_teams(w.stg_games()).join(w.aliases(), "team_code", "left").select(
            "team_code", F.coalesce("team_name", "team_code").alias("team_name"),
            F.coalesce("current_team_code", "team_code").alias("current_team_code"))
        CSV.write_csv(rows, path)
        return path
    return CSV.read_aliases(w.spark, w.once("landing_seed", make))


@register("seed_aliases", """
SELECT t.team_code, COALESCE(a.team_name, t.team_code) AS team_name,
       COALESCE(a.current_team_code, t.team_code) AS current_team_code,
       COALESCE(a.current_team_code, t.team_code) AS team_id,
       (SELECT COUNT(*) FROM team_aliases s WHERE s.team_code = t.team_code) AS alias_rows
FROM all_teams t LEFT JOIN team_aliases a ON t.team_code = a.team_code""")
def q_seed_aliases(w):
    """Every team code in the games with its alias resolution and seed row count."""
    codes = models.all_teams(w.stg_games())
    named = models.name_codes(codes, w.resolved_aliases(), w.alias_rows)
    counts = w.aliases().groupBy("team_code").agg(F.count(F.lit(1)).alias("alias_rows"))
    j = lookup_join(named, counts, "team_code", "left", small_rows=w.alias_rows)
    return j.select("team_code", "team_name", "current_team_code", "team_id",
                    F.coalesce("alias_rows", F.lit(0)).cast("bigint").alias("alias_rows"))


def _pages(w, key: str, items_fn) -> str:
    def make():
        path = scratch_path(w.spark, f"landing-pages-{key}")
        AP.pack_pages(items_fn()).write.mode("overwrite").text(path)
        return path
    return w.once(f"pages_{key}", make)


_FLAT_GAMES_SQL = """
SELECT game_id, strftime(date, '%Y-%m-%dT%H:%M:%S.000Z') AS date, home_team_id,
       home_team_abbreviation, home_team_name, home_team_score, visitor_team_id,
       visitor_team_abbreviation, visitor_team_name, visitor_team_score, period, postseason,
       season, status, time
FROM raw_games"""


@register("api_games_flatten", _FLAT_GAMES_SQL)
def q_api_games_flatten(w):
    """Games packed into 100-item JSON pages, re-read with the page schema and flattened."""
    path = _pages(w, "games", lambda: AP.game_items(w.raw_games()))
    return AP.flatten_games(AP.read_pages(w.spark, path, S.GAMES_PAGE))


def _team_rows(w) -> DataFrame:
    g = w.raw_games()
    sides = g.select(F.explode(F.array(
        F.struct(F.col("home_team_id").alias("id"), F.col("home_team_abbreviation").alias("abbreviation"),
                 F.col("home_team_name").alias("full_name")),
        F.struct(F.col("visitor_team_id").alias("id"),
                 F.col("visitor_team_abbreviation").alias("abbreviation"),
                 F.col("visitor_team_name").alias("full_name")))).alias("t")).select("t.*").distinct()
    nation = w.source("nation").select(F.col("n_nationkey").alias("id"), "n_regionkey")
    region = w.source("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    t = lookup_join(sides, nation, "id", "left")
    t = lookup_join(t, region, "n_regionkey", "left")
    return t.select(F.col("id").cast("long").alias("key"), F.struct(
        "id", "abbreviation", F.col("r_name").alias("city"),
        conference_of(F.col("abbreviation"), w.params.eastern, w.params.western).alias("conference"),
        F.col("r_name").alias("division"), "full_name",
        F.col("abbreviation").alias("name")).alias("item"))


O.CTES["flat_teams"] = f"""
SELECT DISTINCT s.id AS team_id, s.abbreviation, r.r_name AS city,
       CASE WHEN s.abbreviation IN ({O.EAST}) THEN 'Eastern'
            WHEN s.abbreviation IN ({O.WEST}) THEN 'Western' ELSE 'Historical' END AS conference,
       r.r_name AS division, s.full_name, s.abbreviation AS name
FROM (SELECT home_team_id AS id, home_team_abbreviation AS abbreviation, home_team_name AS full_name FROM raw_games
      UNION SELECT visitor_team_id, visitor_team_abbreviation, visitor_team_name FROM raw_games) s
LEFT JOIN nation n ON s.id = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""


@register("api_teams_flatten", "SELECT * FROM flat_teams")
def q_api_teams_flatten(w):
    """Teams seen in the games, as API team pages, re-read and flattened."""
    path = _pages(w, "teams", lambda: _team_rows(w))
    return AP.flatten_teams(AP.read_pages(w.spark, path, S.TEAMS_PAGE))


@register("raw_teams", "SELECT * FROM flat_teams")
def q_raw_teams(w):
    """Typed CSV load of the teams snapshot."""
    def make():
        base = scratch_path(w.spark, "landing-teams")
        SN.write_snapshot(q_api_teams_flatten(w), base, "teams", "19000101_000000")
        return base
    base = w.once("landing_teams", make)
    return CSV.read_teams(w.spark, f"{base}/teams/{SN.SNAPSHOT_COL}=19000101_000000")


def _player_rows(w) -> DataFrame:
    """Player season lines: a supplier is a player, a year of its lineitems a season. The i-th
    figure sums the quantities of every 18th line, over 64: exact binary fractions."""
    line = F.col("l_orderkey") + F.col("l_linenumber")
    return w.source("lineitem").groupBy(
        F.col("l_suppkey").cast("int").alias("player_id"),
        F.year("l_shipdate").alias("season")).agg(
        F.count(F.lit(1)).cast("int").alias("games_played"),
        F.concat(F.floor(F.sum("l_quantity") / F.count(F.lit(1))).cast("string"), F.lit(":30")).alias("min"),
        *[(F.sum(F.when(line % len(S.PLAYER_STAT_COLUMNS) == i, F.col("l_quantity")).otherwise(0.0)) / 64).alias(c)
          for i, c in enumerate(S.PLAYER_STAT_COLUMNS)])


O.CTES["player_seasons"] = f"""
SELECT CAST(l_suppkey AS INTEGER) AS player_id, CAST(year(l_shipdate) AS INTEGER) AS season,
       CAST(COUNT(*) AS INTEGER) AS games_played,
       CAST(CAST(floor(SUM(l_quantity) / COUNT(*)) AS BIGINT) AS VARCHAR) || ':30' AS min,
       {", ".join(f"SUM(CASE WHEN (l_orderkey + l_linenumber) % {len(S.PLAYER_STAT_COLUMNS)} = {i} "
                  f"THEN l_quantity ELSE 0.0 END) / 64 AS {c}"
                  for i, c in enumerate(S.PLAYER_STAT_COLUMNS))}
FROM lineitem GROUP BY l_suppkey, year(l_shipdate)"""


@register("raw_player_stats", "SELECT * FROM player_seasons")
def q_raw_player_stats(w):
    """Typed CSV load of the player statistics snapshot."""
    def make():
        base = scratch_path(w.spark, "landing-players")
        SN.write_snapshot(_player_rows(w), base, "player_stats", "19000101_000000")
        return base
    base = w.once("landing_players", make)
    return CSV.read_player_stats(w.spark, f"{base}/player_stats/{SN.SNAPSHOT_COL}=19000101_000000")


@register("api_player_stats_flatten", "SELECT * FROM player_seasons")
def q_api_player_stats_flatten(w):
    """Player seasons packed into JSON pages, re-read permissively and flattened."""
    path = _pages(w, "player_stats", lambda: _player_rows(w).select(
        F.struct("player_id", "season").alias("key"),
        F.struct(*[f.name for f in S.API_PLAYER_STAT.fields]).alias("item")))
    return AP.flatten_player_stats(AP.read_pages(w.spark, path, S.PLAYER_STATS_PAGE, mode="PERMISSIVE"))


@register("alltime_ratings", """
SELECT 2 * game_id + side AS gameorder,
       CAST(game_id AS VARCHAR) AS game_id, 'NBA' AS lg_id, strftime(date, '%Y-%m-%d') AS date,
       franch_id, opp_franch, elo_i, elo_n, CAST(NULL AS DOUBLE) AS win_equiv, opp_franch AS opp_id,
       opp_elo_i, opp_elo_n, game_location, CASE WHEN score > other THEN 'W' WHEN score < other THEN 'L' END AS game_result,
       forecast, CAST(NULL AS VARCHAR) AS notes
FROM (SELECT game_id, date, 1 AS side, team1 AS franch_id, team2 AS opp_franch, elo1_pre AS elo_i,
             elo1_post AS elo_n, elo2_pre AS opp_elo_i, elo2_post AS opp_elo_n,
             CASE WHEN neutral = 1 THEN 'N' ELSE 'H' END AS game_location, score1 AS score,
             score2 AS other, elo_prob1 AS forecast FROM elo
      UNION ALL
      SELECT game_id, date, 2, team2, team1, elo2_pre, elo2_post, elo1_pre, elo1_post,
             CASE WHEN neutral = 1 THEN 'N' ELSE 'A' END, score2, score1, elo_prob2 FROM elo)""")
def q_alltime_ratings(w):
    """Both sides of every rated game, landed as CSV in the all-time layout and read with its schema."""
    def make():
        path = scratch_path(w.spark, "landing-alltime")
        sides = explode_sides(w.raw_elo(), ["game_id", "date", "neutral"], {
            "H": {"side": F.lit(1), "at": F.lit("H"), "franch_id": F.col("team1"), "opp_franch": F.col("team2"),
                  "elo_i": F.col("elo1_pre"), "elo_n": F.col("elo1_post"), "opp_elo_i": F.col("elo2_pre"),
                  "opp_elo_n": F.col("elo2_post"), "diff": F.col("score1") - F.col("score2"),
                  "forecast": F.col("elo_prob1")},
            "A": {"side": F.lit(2), "at": F.lit("A"), "franch_id": F.col("team2"), "opp_franch": F.col("team1"),
                  "elo_i": F.col("elo2_pre"), "elo_n": F.col("elo2_post"), "opp_elo_i": F.col("elo1_pre"),
                  "opp_elo_n": F.col("elo1_post"), "diff": F.col("score2") - F.col("score1"),
                  "forecast": F.col("elo_prob2")}})
        CSV.write_csv(sides.select(
            (2 * F.col("game_id") + F.col("side")).alias("gameorder"), F.col("game_id").cast("string").alias("game_id"),
            F.lit("NBA").alias("lg_id"), F.date_format("date", "yyyy-MM-dd").alias("date"), "franch_id",
            "opp_franch", "elo_i", "elo_n", F.lit(None).cast("double").alias("win_equiv"),
            F.col("opp_franch").alias("opp_id"), "opp_elo_i", "opp_elo_n",
            F.when(F.col("neutral") == 1, "N").otherwise(F.col("at")).alias("game_location"),
            F.when(F.col("diff") > 0, "W").when(F.col("diff") < 0, "L").alias("game_result"), "forecast",
            F.lit(None).cast("string").alias("notes")), path)
        return path
    return CSV.read_alltime_ratings(w.spark, w.once("landing_alltime", make))


@register("api_games_stream", "SELECT * FROM raw_games")
def q_api_games_stream(w):
    """Landed game pages ingested by a file-source stream (availableNow) into a table."""
    def make():
        pages = _pages(w, "games", lambda: AP.game_items(w.raw_games()))
        table = scratch_path(w.spark, "stream-raw-games")
        q = ST.ingest_game_pages(w.spark, pages, table, scratch_path(w.spark, "stream-ckpt"))
        q.awaitTermination()
        return table
    return ST.read_ingested(w.spark, w.once("stream_games", make))


def _landings(w, name: str, first: Callable[[], DataFrame], second: Callable[[], DataFrame]) -> str:
    """The keyed table of an input after two overlapping landings, each streamed on its own."""
    def make():
        pages, table, mark = (scratch_path(w.spark, f"{kind}-{name}") for kind in ("landings", "current", "mark"))
        for items in (first, second):
            AP.pack_pages(items()).write.mode("append").text(pages)
            ST_STATE.ingest_current(w.spark, pages, table, mark, name).awaitTermination()
        return table
    return w.once(f"current_{name}", make)


@register("api_games_current", "SELECT * FROM raw_games")
def q_api_games_current(w):
    """Games of the last window landed without scores, then the whole window again with them."""
    start, end = _range_bounds(w)
    recent = F.col("date").between(F.lit(start), F.lit(end))

    def scheduled():
        g = w.raw_games()
        open_ = {c: F.when(recent, F.lit(None).cast("int")).otherwise(F.col(c))
                 for c in ("home_team_score", "visitor_team_score")}
        return AP.game_items(g.withColumns(open_ | {"status": F.when(recent, "Scheduled").otherwise(F.col("status"))}))

    table = _landings(w, "games", scheduled, lambda: AP.game_items(w.raw_games(start, end)))
    return ST_STATE.current(w.spark, table, "games")


@register("api_teams_current", "SELECT * FROM flat_teams")
def q_api_teams_current(w):
    """All teams landed without their division, then again with it."""
    item = F.col("item")
    table = _landings(w, "teams", lambda: _team_rows(w).withColumn("item", item.withField("division", F.lit("?"))),
                      lambda: _team_rows(w))
    return ST_STATE.current(w.spark, table, "teams")


@register("api_players_current", "SELECT * FROM player_seasons")
def q_api_players_current(w):
    """All player seasons, the last one unfinished; then the last one again, finished."""
    rows = lambda: _player_rows(w)
    last = lambda: rows().agg(F.max("season")).scalar()
    items = lambda df: df.select(F.struct("player_id", "season").alias("key"),
                                 F.struct(*S.API_PLAYER_STAT.fieldNames()).alias("item"))

    def unfinished():
        late = F.col("season") == last()
        return items(rows().withColumn("games_played", F.when(late, F.col("games_played") - 1)
                                       .otherwise(F.col("games_played")).cast("int")))

    table = _landings(w, "player_stats", unfinished, lambda: items(rows().where(F.col("season") == last())))
    return ST_STATE.current(w.spark, table, "player_stats")


@register("export_listing", f"""
SELECT * FROM (VALUES
    ('team_win_rates', '20010801_030000', (SELECT COUNT(*) FROM win_rates_export)),
    ('elo_trends', '20010801_030000', (SELECT COUNT(*) FROM fct_games JOIN dim_teams USING (team_id)
                                       WHERE game_date >= DATE '{O.TREND_START}')),
    ('point_diff_by_season', '20010801_030000', (SELECT COUNT(*) FROM (
        SELECT DISTINCT team_name, season FROM fct_games JOIN dim_teams USING (team_id))))
) v(name, snapshot_ts, row_count)""")
def q_export_listing(w):
    """All exports written as CSV snapshots (two of one), listed with the rows of their latest."""
    fct, dim, n = _marts(w)
    reports = {"team_win_rates": exports.team_win_rates(fct, dim, n),
               "elo_trends": exports.elo_trends(fct, dim, w.params.as_of, n),
               "point_diff_by_season": exports.point_diff_by_season(fct, dim, n)}

    def make():
        base = scratch_path(w.spark, "export-listing")
        SN.write_snapshot(reports["team_win_rates"], base, "team_win_rates", "20010731_030000")
        for name, df in reports.items():
            SN.write_snapshot(df, base, name, "20010801_030000")
        return base
    base = w.once("export_listing", make)
    counts = exports.export_summary({name: SN.read_latest(w.spark, base, name, df.schema)
                                     for name, df in reports.items()})
    return SN.list_latest(w.spark, base).join(counts.withColumnRenamed("table_name", "name"), "name").select(
        "name", SN.SNAPSHOT_COL, "row_count")


@register("export_preview", """
SELECT *, (SELECT count(*) FROM win_rates_export) AS total_rows
FROM win_rates_export
ORDER BY season DESC, win_rate DESC, team_name LIMIT 100""")
def q_export_preview(w):
    """The win-rate export written as CSV, read back: first 100 rows and the total."""
    def make():
        base = scratch_path(w.spark, "exports")
        SN.write_snapshot(exports.team_win_rates(*_marts(w)), base, "team_win_rates")
        return base
    base = w.once("exports", make)
    schema = exports.team_win_rates(*_marts(w)).schema
    df = SN.read_latest(w.spark, base, "team_win_rates", schema)
    return SN.preview(df, [F.desc_nulls_last("season"), F.desc_nulls_last("win_rate"),
                           F.asc_nulls_last("team_name")])
