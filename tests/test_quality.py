from pyspark.sql import functions as F

from courtside.operators import quality as Q
from courtside.plans import checks as C


def _fct(spark, rows):
    return spark.createDataFrame(rows, "game_id string, team_id string, win_flag int, "
                                       "score_diff int, elo_change double")


GOOD = [("g1", "A", 1, 5, 10.0), ("g1", "B", 0, -5, -10.0)]


def test_business_rules_pass_on_good_rows(spark):
    f = _fct(spark, GOOD)
    for check in (C.games_have_two_teams, C.rating_changes_sum_to_zero, C.one_winner_per_game,
                  C.scores_match_outcome):
        assert check(f).count() == 0


def test_business_rules_report_bad_rows(spark):
    bad = GOOD + [("g2", "A", 0, 0, -15.0), ("g2", "B", 0, 0, -15.0), ("g3", "A", 1, 3, 1.0)]
    f = _fct(spark, bad)
    assert {r.game_id for r in C.games_have_two_teams(f).collect()} == {"g3"}
    assert {r.game_id for r in C.rating_changes_sum_to_zero(f).collect()} == {"g2", "g3"}
    assert {r.game_id for r in C.one_winner_per_game(f).collect()} == {"g2"}
    assert C.scores_match_outcome(f).count() == 2  # the tie rows


def test_not_null_unique_accepted(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3)], "k string, v int")
    nn = {r.column_name: r.null_count for r in Q.null_counts(df, ["k", "v"], "m").collect()}
    assert nn == {"k": 1, "v": 1}
    assert Q.not_null_violations(df, ["k", "v"]).count() == 2
    assert [tuple(r) for r in Q.duplicate_keys(df, "k").collect()] == [("a", 2)]
    prof = {r.value: r.is_accepted for r in Q.accepted_values(df, "v", [1, 2], "m").collect()}
    assert prof == {"1": True, "3": False, None: None}


def test_relationships(spark):
    child = spark.createDataFrame([("A",), ("B",), (None,)], "t string")
    parent = spark.createDataFrame([("A",)], "team_id string")
    assert [r.t for r in Q.relationship_orphans(child, "t", parent, "team_id").collect()] == ["B"]
    s = Q.relationship_summary(child, "t", parent, "team_id", "m").first()
    assert (s.checked_rows, s.orphan_rows) == (2, 1)


def test_min_rows_primary_key_and_columns(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k long")
    r = Q.min_rows({"t": df}, 1000).first()
    assert (r.row_count, r.passed) == (4, False)
    pk = Q.primary_key_profile(df, "k").first()
    assert (pk.row_count, pk.null_keys, pk.duplicate_keys) == (4, 1, 1)
    assert Q.missing_columns(df, ["k", "team"]) == ["team"]


def test_null_scores_and_date_range(spark):
    import datetime as dt
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 23), None, 90, "Final"), (dt.datetime(2024, 1, 2), 1, 2, "Final"),
         (dt.datetime(2024, 1, 2, 5), None, None, "Scheduled")],
        "date timestamp, home_team_score int, visitor_team_score int, status string")
    r = C.null_scores(df).first()
    assert (r.final_games, r.null_score_games) == (2, 1)
    d = C.date_range(df).first()
    assert (d.earliest, d.latest, d.unique_dates) == (dt.date(2024, 1, 1), dt.date(2024, 1, 2), 2)


def test_assert_empty_raises(spark):
    import pytest
    df = spark.createDataFrame([(1,)], "x int")
    with pytest.raises(Q.QualityError):
        Q.assert_empty("x", df)
    Q.assert_empty("none", df.filter(F.col("x") > 5))
