import datetime as dt
import os

from pyspark.sql import functions as F

from courtside.operators.running import running_sum, running_sum_window
from courtside.plans import models
from courtside.sources.csv_tables import read_aliases
from helpers import aliases, elo_rows

SEED = os.path.join(os.path.dirname(os.path.dirname(__file__)), "courtside", "seeds",
                    "team_aliases.csv")
AS_OF = dt.date(2003, 7, 28)


def _chain(spark, rows, alias_rows=()):
    games = models.stg_games(elo_rows(spark, rows))
    al = aliases(spark, list(alias_rows)) if alias_rows else aliases(spark, [])
    resolved = models.resolve_aliases(al)
    n = al.count()
    summary = models.side_summary(games)
    return games, resolved, n, summary


def test_stg_games_tie_null_and_dropped_rows(spark):
    rows = [("2001-01-02", "A", "B", 100, 100), ("2001-01-03", "A", "B", None, 90),
            (None, "A", "B", 1, 2), ("2001-01-04", None, "B", 1, 2), ("2001-01-05", "A", None, 1, 2)]
    g = models.stg_games(elo_rows(spark, rows)).orderBy("game_date").collect()
    assert len(g) == 2  # NULL date / team dropped
    tie, null = g
    assert tie.game_id == "20010102_A_B" and tie.home_win_flag == 0 and tie.away_win_flag == 0
    assert null.home_win_flag == 0 and null.away_win_flag == 0 and null.home_score_diff is None


def test_fct_labels_for_tie_and_null_score(spark):
    rows = [("2001-01-02", "A", "B", 100, 100), ("2001-01-03", "A", "B", None, 90)]
    games, resolved, n, _ = _chain(spark, rows)
    f = models.fct_games(games, resolved, n).collect()
    assert len(f) == 4
    by = {(r.game_date.day, r.game_location): r for r in f}
    assert by[(2, "HOME")].game_outcome_type == "Tie"
    assert by[(3, "HOME")].game_outcome_type == "Blowout Loss"  # NULL diff -> ELSE label
    assert by[(2, "HOME")].game_team_id == "20010102_A_B_A"


def test_duplicate_aliases_fan_out_only_without_resolution(spark):
    seed = read_aliases(spark, SEED)
    assert models.alias_duplicates(seed).count() == 3  # Nets, Hornets, Royals
    rows = [("2001-01-02", "Hornets", "Nets", 100, 90)]
    games = models.stg_games(elo_rows(spark, rows))
    resolved = models.resolve_aliases(seed)
    f = models.fct_games(games, resolved, seed.count()).collect()
    assert len(f) == 2  # exactly one row per side
    home = [r for r in f if r.game_location == "HOME"][0]
    assert home.team_id == "Hornets"  # min(current_team_code): Hornets < Pelicans
    # the unresolved seed would fan out: 3 Hornets rows x 2 Nets rows per perspective
    raw_join = games.join(seed.withColumnRenamed("team_code", "home_team"), "home_team", "left")
    assert raw_join.count() == 3


def test_home_equals_away_counted_once_in_performance(spark):
    rows = [("2001-01-02", "A", "A", 100, 90), ("2001-01-03", "A", "B", 80, 90)]
    games, resolved, n, summary = _chain(spark, rows)
    perf = {r.team_id: r for r in models.team_performance(summary, resolved, n).collect()}
    assert perf["A"].games_analyzed == 2 and perf["A"].total_wins == 1
    act = {r.team_id: r for r in models.team_activity(summary, resolved, n).collect()}
    assert act["A"].total_games == 3  # UNION ALL of both sides counts the A-A game twice


def test_codes_sharing_an_id(spark):
    rows = [("2001-01-02", "X", "Y", 100, 90), ("2001-02-02", "Y", "Z", 100, 90)]
    al = [("Y", "Old Name", "X")]
    games, resolved, n, summary = _chain(spark, rows, al)
    stg = models.stg_teams(summary, resolved, n, AS_OF).collect()
    assert sorted((r.team_code, r.team_id) for r in stg) == [("X", "X"), ("Y", "X"), ("Z", "Z")]
    x_rows = [r for r in stg if r.team_id == "X"]
    assert all(r.total_games == 3 for r in x_rows)
    dim = models.dim_teams(summary, resolved, n, AS_OF, (), ()).collect()
    assert sorted(r.team_id for r in dim) == ["X", "Z"]  # one row per id
    x = [r for r in dim if r.team_id == "X"][0]
    assert x.team_name == "X" and x.total_wins == 2 and x.historical_win_rate == 66.67
    perf = models.team_performance(summary, resolved, n)
    as_written = models.dim_teams_as_written(
        models.stg_teams(summary, resolved, n, AS_OF), perf, (), ()).collect()
    assert len([r for r in as_written if r.team_id == "X"]) == 4  # n codes -> n*n rows


def test_running_sum_matches_window_with_peers(spark):
    rows = [("a", dt.date(2001, 1, d), float(v)) for d, v in
            [(1, 1), (1, 2), (2, 4), (3, 8), (3, 16)]] + [("b", dt.date(2001, 1, 1), 5.0)]
    df = spark.createDataFrame(rows, "t string, d date, v double")
    fast = running_sum(df, ["t"], "d", "v", "c").orderBy("t", "d", "v").collect()
    plain = running_sum_window(df, ["t"], "d", "v", "c").orderBy("t", "d", "v").collect()
    assert [tuple(r) for r in fast] == [tuple(r) for r in plain]
    assert [r.c for r in fast if r.t == "a"] == [3.0, 3.0, 7.0, 31.0, 31.0]


def test_no_nested_loop_or_cartesian_in_model_plans(spark):
    from courtside.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    for df in (w.dim_teams(), w.fct_games(), w.stg_teams(), w.dim_teams_as_written()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_fact_scan_is_pruned(spark):
    from courtside.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    from courtside.sources.fixture import base_games
    plan = base_games(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan
    assert "o_clerk" not in plan and "o_comment" not in plan
    summary = w.side_summary()._jdf.queryExecution().executedPlan().toString()
    assert "elo1_pre" not in summary  # the summary reads only the columns it aggregates


def test_running_sum_over_months_matches_window(spark):
    # a hot key with many days over several months, NULL values, keys and dates, inexact doubles
    rows = [("hot", dt.date(2001, 1, 1) + dt.timedelta(days=i % 200), float(i % 11) if i % 13 else None)
            for i in range(900)]
    rows += [("cold", dt.date(2001, 1, 1) + dt.timedelta(days=i), None) for i in range(3)]
    rows += [("cold", dt.date(2001, 2, 1), 2.0), (None, dt.date(2001, 1, 5), 0.1),
             (None, dt.date(2001, 3, 5), 0.2), ("cold", None, 0.3), (None, None, 0.7), (None, None, None)]
    df = spark.createDataFrame(rows, "t string, d date, v double")
    fast = running_sum(df, ["t"], "d", "v", "c")
    plain = running_sum_window(df, ["t"], "d", "v", "c")
    key = lambda r: (str(r.t), str(r.d), str(r.v), -1.0 if r.c is None else round(r.c, 9))
    assert sorted(map(key, fast.collect())) == sorted(map(key, plain.collect()))


def test_running_totals_on_the_trend_input(spark):
    """Real fact rows (sf0.01)."""
    from courtside.plans.warehouse import warehouse_for
    w = warehouse_for(spark, "/root/testdata/sf0.01")
    fct, dim = w.table("fct_games"), w.table("dim_teams")
    rows = fct.join(dim.select("team_id", "team_name"), "team_id").select(
        "team_name", "game_date", "elo_change")
    fast = running_sum(rows, ["team_name"], "game_date", "elo_change", "c")
    plain = running_sum_window(rows, ["team_name"], "game_date", "elo_change", "c")
    assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, plain.collect()))


def test_stg_teams_as_written_fans_out_over_duplicate_codes(spark):
    seed = read_aliases(spark, SEED)
    rows = [("2001-01-02", "Hornets", "Nets", 100, 90), ("2001-02-02", "Kings", "Hornets", 99, 98)]
    games = models.stg_games(elo_rows(spark, rows))
    summary = models.side_summary(games)
    n = seed.count()
    written = {(r.team_code, r.team_id): r for r in
               models.stg_teams_as_written(summary, seed, n, AS_OF).collect()}
    # Hornets -> Hornets (1 seed row) and Pelicans (2 seed rows): its 2 sides count
    # once under Hornets and twice under Pelicans
    assert written[("Hornets", "Hornets")].total_games == 2
    assert written[("Hornets", "Pelicans")].total_games == 4
    contract = {(r.team_code, r.team_id): r for r in
                models.stg_teams(summary, models.resolve_aliases(seed), n, AS_OF).collect()}
    assert contract[("Hornets", "Hornets")].total_games == 2
    assert ("Hornets", "Pelicans") not in contract
