"""Dashboard data: selectors, filtered games and the aggregates behind each chart.

The reference pulls the filtered games into pandas and aggregates there;
here every aggregate is a Spark group-by over the filtered games, and the
driver only ever receives the (small) aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.operators.joins import lookup_join
from courtside.operators.histogram import histogram, histogram_mean, histogram_stddev

GAME_COLUMNS = ["game_date", "season", "team_name", "conference", "win_flag", "score_diff",
                "elo_pre", "elo_post", "elo_change", "game_location", "playoff"]
TEAM_COLUMNS = ["team_id", "team_name", "conference", "is_active", "historical_win_rate",
                "avg_elo_rating", "peak_elo_rating", "total_games"]
LOCATIONS = ("HOME", "AWAY")
#: A row's own key, which splits equal sort keys over many tasks' ranges.
ROW_KEY = "game_team_id"
#: Rows that one task sorts (about 100 bytes of memory each).
SORT_ROWS = 250_000


def in_list(df: DataFrame, column: str, values: Sequence | None) -> DataFrame:
    """Keep rows whose ``column`` is in ``values``; an empty or missing list keeps all."""
    return df if not values else df.filter(F.col(column).isin(list(values)))


def teams_by_conference(dim: DataFrame, conference: str = "All") -> DataFrame:
    t = dim.select(*TEAM_COLUMNS)
    if conference != "All":
        t = t.filter(F.col("conference") == conference)
    return t.orderBy(F.asc_nulls_last("team_name"))


def conference_list(dim: DataFrame) -> DataFrame:
    return dim.select("conference").distinct().orderBy(F.asc_nulls_last("conference"))


def default_teams(dim: DataFrame, conference: str = "All", k: int = 5) -> DataFrame:
    """The first ``k`` team names of the (conference-filtered) list: the default selection."""
    return teams_by_conference(dim, conference).select("team_name").limit(k)


def games_filtered(fct: DataFrame, dim: DataFrame, dim_rows: int | None = None,
                   teams: Sequence[str] | None = None,
                   seasons: Sequence[int] | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """Team-games with team attributes, filtered by optional team / season lists."""
    f = in_list(fct, "season", seasons)
    d = in_list(dim.select("team_id", "team_name", "conference"), "team_name", teams)
    j = lookup_join(f, d, "team_id", "inner", small_rows=dim_rows)
    return j.select(*GAME_COLUMNS, *extra)


def games_ordered(fct: DataFrame, dim: DataFrame, teams: Sequence[str] | None = None,
                  seasons: Sequence[int] | None = None) -> DataFrame:
    """:func:`games_filtered`, latest first; the row's own key splits a (date, team) over many rows' ranges."""
    key = "game_team_id"
    f = in_list(fct, "season", seasons)
    d = in_list(dim.select("team_id", "team_name", "conference"), "team_name", teams)
    j = lookup_join(f, d, "team_id", "inner").select(*GAME_COLUMNS, key)
    return j.orderBy(F.desc_nulls_last("game_date"), "team_name", key).drop(key)


def season_list(games: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` latest seasons (the default season selection)."""
    return games.select("season").distinct().orderBy(F.desc_nulls_last("season")).limit(k)


def win_rates(games: DataFrame) -> DataFrame:
    """Per team and season: wins, games and the rounded win percentage."""
    g = games.groupBy("team_name", "season").agg(
        F.sum("win_flag").cast("bigint").alias("wins"), F.count(F.lit(1)).alias("games"))
    return g.withColumn("win_rate", F.round(F.col("wins") / F.col("games") * 100, 2))


def download_win_rates(rates: DataFrame, path: str) -> None:
    """The win-rate table as a CSV download (header, one file per task)."""
    from courtside.sources.csv_tables import write_csv
    write_csv(rates, path)


def best_season(rates: DataFrame) -> DataFrame:
    """The top (team, season) by win rate; ties go to the first in (team, season) order."""
    return rates.orderBy(F.desc_nulls_last("win_rate"), F.asc_nulls_last("team_name"),
                         F.asc_nulls_last("season")).limit(1)


def rates_summary(rates: DataFrame) -> DataFrame:
    """Mean win rate, total games, teams. Rates are whole hundredths, so the mean
    is taken over integer hundredths: an exact sum, whatever the addition order."""
    hundredths = F.round(F.col("win_rate") * 100).cast("long")
    return rates.agg((F.avg(hundredths) / 100).alias("avg_win_rate"),
                     F.sum("games").cast("bigint").alias("total_games"),
                     F.countDistinct("team_name").alias("teams_analyzed"))


def rating_series(games: DataFrame, rows: int) -> DataFrame:
    """Each team's post-game rating in date order (one sort, no per-team loop).

    ``games`` has ``ROW_KEY``; ``rows``, their number or more, sets the sort's tasks: sorted
    rows pack so well that AQE, which goes by shuffled bytes, would put tens of millions in one.
    """
    order = [F.asc_nulls_last("team_name"), F.asc_nulls_last("game_date"), F.asc("elo_post"), F.asc(ROW_KEY)]
    series = games.select("team_name", "game_date", "elo_post", ROW_KEY)
    return series.repartitionByRange(max(1, -(-rows // SORT_ROWS)), *order).orderBy(*order).drop(ROW_KEY)


def season_rating_change(games: DataFrame) -> DataFrame:
    """Per team and season: rating before the first game, after the last, and the sum
    of changes. Games on the same first (last) date tie; the smaller first
    (larger last) rating wins, so the result never depends on row order."""
    # Two hash aggregations: per day first (partial, map-side), then per
    # season with the date as a primitive ordering key - a struct key would
    # force a sort-based aggregation over every game.
    daily = games.groupBy("team_name", "season", "game_date").agg(
        F.min("elo_pre").alias("day_pre"), F.max("elo_post").alias("day_post"),
        F.sum("elo_change").alias("day_change"))
    return (daily.groupBy("team_name", "season").agg(
        F.min_by("day_pre", "game_date").alias("elo_pre"),
        F.max_by("day_post", "game_date").alias("elo_post"),
        F.sum("day_change").alias("elo_change"))
        .withColumn("total_change", F.col("elo_post") - F.col("elo_pre")))


def season_rating_change_as_written(games: DataFrame) -> DataFrame:
    """The change as the dashboard's first/last over rows in descending date order give it:
    the rating before the last game and the one after the first. Ties of a date go to the
    smaller rating before and the larger one after it."""
    daily = games.groupBy("team_name", "season", "game_date").agg(
        F.min("elo_pre").alias("day_pre"), F.max("elo_post").alias("day_post"),
        F.sum("elo_change").alias("day_change"))
    return (daily.groupBy("team_name", "season").agg(
        F.max_by("day_pre", "game_date").alias("elo_pre"),
        F.min_by("day_post", "game_date").alias("elo_post"),
        F.sum("day_change").alias("elo_change"))
        .withColumn("total_change", F.col("elo_post") - F.col("elo_pre")))


def season_rating_pivot(changes: DataFrame, seasons: Sequence[int]) -> DataFrame:
    """Team x season grid of the total change; a season outside ``seasons`` (a null one too) is an error."""
    known = F.when(F.col("season").isin(list(seasons)), F.col("season")).otherwise(
        F.raise_error(F.concat(F.lit("season without a column: "),
                               F.coalesce(F.col("season").cast("string"), F.lit("NULL")))).cast("int"))
    return (changes.withColumn("season", known).groupBy("team_name")
            .pivot("season", list(seasons)).agg(F.max("total_change")))


def point_diff_stats(games: DataFrame) -> DataFrame:
    d = F.col("score_diff")
    return histogram(games, ["team_name"], "score_diff").groupBy("team_name").agg(
        F.round(histogram_mean(d), 2).alias("average"),
        F.round(histogram_stddev(d), 2).alias("std_dev"),
        F.min(d).alias("worst_loss"),
        F.max(d).alias("best_win"),
        F.round(F.percentile(d, 0.5, F.col("n")), 2).alias("median"))


def box_stats(games: DataFrame) -> DataFrame:
    """Five-number summary of the differential per team and playoff flag."""
    d = F.col("score_diff")
    return histogram(games, ["team_name", "playoff"], "score_diff").groupBy("team_name", "playoff").agg(
        F.min(d).alias("min_diff"), F.percentile(d, 0.25, F.col("n")).alias("q1_diff"),
        F.percentile(d, 0.5, F.col("n")).alias("median_diff"), F.percentile(d, 0.75, F.col("n")).alias("q3_diff"),
        F.max(d).alias("max_diff"))


def location_stats(games: DataFrame) -> DataFrame:
    g = games.groupBy("team_name", F.col("game_location").alias("location")).agg(
        F.sum("win_flag").cast("bigint").alias("wins"), F.count(F.lit(1)).alias("games"),
        F.avg("score_diff").alias("avg_diff"))
    return g.withColumn("win_rate", F.round(F.col("wins") / F.col("games") * 100, 2))


def home_advantage_pivot(stats: DataFrame) -> DataFrame:
    """Team x location win rate, plus home minus away."""
    p = stats.groupBy("team_name").pivot("location", list(LOCATIONS)).agg(F.first("win_rate"))
    return (p.withColumnRenamed("HOME", "home_win_rate").withColumnRenamed("AWAY", "away_win_rate")
            .withColumn("home_advantage", F.col("home_win_rate") - F.col("away_win_rate")))
