"""The exported reports: win rates, rating trends, point differential, summary.

All of them join the fact to the team dimension; the dimension is
broadcast when its bytes are below the session's threshold.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions import dates as FD
from courtside.functions.dates import years_before
from courtside.operators.histogram import histogram, histogram_mean, histogram_stddev
from courtside.operators.joins import lookup_join
from courtside.operators.running import running_sum


def with_team(fct: DataFrame, dim: DataFrame, dim_rows: int | None,
              dim_cols=("team_name",)) -> DataFrame:
    """Fact joined (inner) to the dimension's columns on team_id."""
    d = dim.select("team_id", *dim_cols)
    return lookup_join(fct, d, "team_id", "inner", small_rows=dim_rows)


def team_win_rates(fct: DataFrame, dim: DataFrame, dim_rows: int | None = None) -> DataFrame:
    j = with_team(fct.select("team_id", "season", "win_flag", "score_diff"), dim, dim_rows)
    wins = F.sum("win_flag")
    return (j.groupBy("team_name", "season").agg(
        F.count(F.lit(1)).alias("games_played"),
        wins.cast("bigint").alias("wins"),
        F.round(wins * F.lit(100.0) / F.count(F.lit(1)), 2).alias("win_rate"),
        F.round(F.avg("score_diff"), 2).alias("avg_point_diff"))
        .orderBy(F.desc("season"), F.desc("win_rate")))


def season_dates(fct: DataFrame) -> list[tuple]:
    """(season, last game date) of each season of the fact: a row a season."""
    return [(r.season, r.latest) for r in fct.groupBy("season").agg(F.max("game_date").alias("latest")).collect()]


def in_seasons_since(fct: DataFrame, start: dt.date, dates: list[tuple]) -> DataFrame:
    """``fct`` without the seasons whose last game was before ``start``: a partition filter."""
    late = [s for s, latest in dates if latest is not None and latest >= start]
    known = F.col("season").isin([s for s in late if s is not None])
    return fct.filter(known | F.col("season").isNull() if None in late else known)


def elo_trends(fct: DataFrame, dim: DataFrame, as_of: dt.date, dim_rows: int | None = None,
               years: int = 2, dates: list[tuple] | None = None) -> DataFrame:
    """Per team and game, the running rating change since the window start.

    The date filter runs before the window, as in the reference (moving it
    after would change every running total). With ``dates`` (`season_dates`) only
    seasons that reach into the window are opened.
    """
    if dates is not None:
        fct = in_seasons_since(fct, FD.years_before_day(as_of, years), dates)
    f = fct.select("team_id", "game_date", "season", "elo_pre", "elo_post", "elo_change") \
        .filter(F.col("game_date") >= years_before(F.lit(as_of), years))
    j = with_team(f, dim, dim_rows).drop("team_id")
    out = running_sum(j, ["team_name"], "game_date", "elo_change", "cumulative_elo_change")
    return out.select("team_name", "game_date", "season", "elo_pre", "elo_post", "elo_change",
                      "cumulative_elo_change").orderBy(
        F.asc_nulls_last("team_name"), F.asc_nulls_last("game_date"), "elo_pre", "elo_post")


def point_diff_by_season(fct: DataFrame, dim: DataFrame,
                         dim_rows: int | None = None) -> DataFrame:
    """Per team and season: spread of the point differential with exact quartiles.

    Games are counted per (team, season, differential) in a hash aggregate
    first; moments and percentiles come from these counts, a few hundred rows
    a group however many games it holds.
    """
    j = with_team(fct.select("team_id", "season", "score_diff"), dim, dim_rows)
    d = F.col("score_diff")
    return (histogram(j, ["team_name", "season"], "score_diff").groupBy("team_name", "season").agg(
        F.sum("n").alias("games"),
        F.round(histogram_mean(d), 2).alias("avg_point_diff"),
        F.round(histogram_stddev(d), 2).alias("stddev_point_diff"),
        F.min(d).alias("worst_loss"),
        F.max(d).alias("best_win"),
        F.percentile(d, 0.25, F.col("n")).alias("q1_point_diff"),
        F.percentile(d, 0.5, F.col("n")).alias("median_point_diff"),
        F.percentile(d, 0.75, F.col("n")).alias("q3_point_diff"))
        .orderBy(F.desc("season"), F.desc("avg_point_diff")))


def export_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count; a missing (None) table is skipped."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items() if df is not None]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
