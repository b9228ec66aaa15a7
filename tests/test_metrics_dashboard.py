import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtside.plans import dashboard as D
from courtside.plans import metrics as M


def _fct(spark):
    rows = [(dt.date(2001, 1, 5), 2000, "A", "HOME", "HOME", 1, 5, 10.0, 0.2, 1500.0, 1510.0),
            (dt.date(2001, 1, 5), 2000, "A", "AWAY", "NEUTRAL", 0, -5, -10.0, 0.6, 1510.0, 1500.0),
            (dt.date(2001, 2, 5), 2000, "A", "AWAY", "AWAY", 1, 3, 4.0, 0.5, 1500.0, 1504.0)]
    return spark.createDataFrame(rows, "game_date date, season int, team_id string, "
                                       "game_location string, adjusted_game_location string, "
                                       "win_flag int, score_diff int, elo_change double, "
                                       "win_probability double, elo_pre double, elo_post double") \
        .withColumn("score_for", F.lit(1)).withColumn("playoff", F.lit(0)) \
        .withColumn("performance_vs_expectation",
                    F.when(F.col("win_probability") < 0.3, "Major Upset").otherwise("Expected Result"))


def test_metric_grains_and_filters(spark):
    f = _fct(spark)
    m = {(r.period_start, r.game_location): r.win_rate
         for r in M.evaluate(f, "win_rate", "month").collect()}
    assert m[(dt.date(2001, 1, 1), "HOME")] == 100.0
    ha = M.evaluate(f, "home_advantage", "year").first()
    assert ha.home_advantage == 0.0  # neutral game excluded: home 1/1, away 1/1
    up = M.evaluate(f, "upset_rate", "quarter").first()
    assert abs(up.upset_rate - 100.0 / 3) < 1e-9


def test_metric_rejects_unknown(spark):
    f = _fct(spark)
    with pytest.raises(ValueError):
        M.evaluate(f, "elo_change_season", "month")
    with pytest.raises(ValueError):
        M.evaluate(f, "win_rate", "year", ["conference"])
    with pytest.raises(ValueError):
        M.filter_predicate(M.MetricFilter("x", "like", "a"))


def test_dashboard_aggregates(spark):
    g = _fct(spark).withColumn("team_name", F.col("team_id"))
    rates = D.win_rates(g).first()
    assert (rates.wins, rates.games, rates.win_rate) == (2, 3, 66.67)
    ch = D.season_rating_change(g).first()
    assert (ch.elo_pre, ch.elo_post, ch.total_change) == (1500.0, 1504.0, 4.0)
    hp = D.home_advantage_pivot(D.location_stats(g)).first()
    assert (hp.home_win_rate, hp.away_win_rate, hp.home_advantage) == (100.0, 50.0, 50.0)
    assert D.in_list(g, "season", []).count() == 3
    assert D.in_list(g, "season", [1999]).count() == 0
    one = g.filter("game_location = 'HOME'")
    st = D.point_diff_stats(one).first()
    assert st.std_dev is None and st.median == 5.0  # one game: stddev NULL


def test_conference_selector_and_default_teams(spark):
    dim = spark.createDataFrame(
        [("B", "Bee", "Eastern"), ("A", "Ay", "Western"), ("C", "Cee", "Eastern"),
         ("D", "Dee", "Eastern")], "team_id string, team_name string, conference string") \
        .withColumn("is_active", F.lit(True)).withColumn("historical_win_rate", F.lit(50.0)) \
        .withColumn("avg_elo_rating", F.lit(1500.0)).withColumn("peak_elo_rating", F.lit(1510.0)) \
        .withColumn("total_games", F.lit(10).cast("long"))
    east = [r.team_name for r in D.teams_by_conference(dim, "Eastern").collect()]
    assert east == ["Bee", "Cee", "Dee"]
    assert [r.team_name for r in D.default_teams(dim, "All", 2).collect()] == ["Ay", "Bee"]
    assert [r.conference for r in D.conference_list(dim).collect()] == ["Eastern", "Western"]


def test_metric_dimension_subset_and_extra_filter(spark):
    f = _fct(spark)
    one = M.evaluate(f, "win_rate", "year", ["team_id"]).collect()
    assert len(one) == 1 and abs(one[0].win_rate - 200.0 / 3) < 1e-9
    assert one[0].asDict().keys() == {"period_start", "team_id", "win_rate"}
    home = M.evaluate(f, "win_rate", "year", ["team_id"],
                      [M.MetricFilter("game_location", "=", "HOME")]).first()
    assert home.win_rate == 100.0
