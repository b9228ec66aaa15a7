"""Latest landings kept by key, checks taken by the write, buckets and date folders."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from courtside import schemas
from courtside.catalog import QUERIES
from courtside.operators import quality as Q
from courtside.plans import checks as C
from courtside.plans import exports, metrics, observed
from courtside.plans import warehouse as W
from courtside.plans.pipeline import run_pipeline
from courtside.sources import api_pages as AP
from courtside.sources import snapshots as SN
from courtside.sources.fixture import raw_games
from courtside.streaming import state

SF = "/root/testdata/sf0.001"


def _land(folder, name, number, items, mtime):
    os.makedirs(f"{folder}/{name}", exist_ok=True)
    path = f"{folder}/{name}/page{number}.json"
    with open(path, "w") as f:
        f.write(json.dumps({"data": items, "meta": {"current_page": number, "total_pages": 1}}) + "\n")
    os.utime(path, (mtime, mtime))


def _player(player, season, games):
    return {"player_id": player, "season": season, "games_played": games, "min": "30:00",
            **{c: 1.5 for c in schemas.PLAYER_STAT_COLUMNS}}


def _team(team, city):
    return {"id": team, "abbreviation": "T", "city": city, "conference": "East", "division": "D",
            "full_name": "Team", "name": "T"}


def test_second_batch_touches_only_its_parts(spark, scratch):
    pages, table = f"{scratch}/pages", f"{scratch}/table"
    _land(pages, "player_stats", 1, [_player(p, s, 10) for p in (1, 2, 3) for s in (1999, 2000, 2001)], 1000)
    run = lambda: state.ingest_current(spark, f"{pages}/player_stats", table, f"{scratch}/mark",
                                       "player_stats").awaitTermination()
    run()
    _land(pages, "player_stats", 2, [_player(1, 2001, 20), _player(4, 2001, 5)], 2000)
    run()
    rows = {(r.player_id, r.season): r.games_played for r in state.current(spark, table, "player_stats").collect()}
    assert len(rows) == 10 and rows[1, 2001] == 20 and rows[4, 2001] == 5 and rows[1, 2000] == 10
    assert sorted(os.listdir(f"{table}/data/version=1")) == sorted(
        n for n in os.listdir(f"{table}/data/version=1") if "2001" in n or n.startswith(("_", ".")))
    read = state.current(spark, table, "player_stats").inputFiles()
    assert {f.split("version=")[1].split("/part-")[0] for f in read} == {
        "0/part=1999", "0/part=2000", "1/part=2001"}


def test_a_batch_that_runs_again_counts_once_and_late_landings_lose(spark, scratch):
    of = state.INPUTS["teams"]
    rows = [(1, "T", "Old", "E", "D", "F", "N", 10), (1, "T", "New", "E", "D", "F", "N", 20), (2, *["x"] * 6, 5)]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in of.rows.fields)
    batch = lambda rs: spark.createDataFrame(rs, schema + ", at int").withColumn(
        "landed_at", F.timestamp_seconds("at")).drop("at")
    table = f"{scratch}/teams"
    assert state.current(spark, table, "teams").count() == 0
    for _ in range(2):
        state.merge(batch(rows), 0, table, "teams")
    state.merge(batch([(1, "T", "Older", "E", "D", "F", "N", 3), (None, *["y"] * 6, 1)]), 1, table, "teams")
    got = {r.team_id: r.city for r in state.current(spark, table, "teams").collect()}
    assert got == {1: "New", 2: "x", None: "y"}
    assert state.merge(batch([]), 2, table, "teams") == []


def test_overlapping_landings_give_one_row_a_key(spark, scratch):
    pages = f"{scratch}/pages"
    AP.pack_pages(AP.game_items(raw_games(spark, SF))).write.text(f"{pages}/games")
    for number, (games, city) in enumerate([(10, "Old"), (20, "New")], 1):
        _land(pages, "player_stats", number, [_player(1, 2001, games), _player(2, 2000 + number, 3)], 1000 * number)
        _land(pages, "teams", number, [_team(1, city)], 1000 * number)
    run_pipeline(spark, pages, f"{scratch}/out", layout="pages", fail_on=())
    players = spark.read.parquet(f"{scratch}/out/raw/player_stats").collect()
    assert sorted((r.player_id, r.season, r.games_played) for r in players) == [
        (1, 2001, 20), (2, 2001, 3), (2, 2002, 3)]
    assert [r.city for r in spark.read.parquet(f"{scratch}/out/raw/teams").collect()] == ["New"]


def test_pipeline_over_keyed_tables(spark, scratch):
    land = f"{scratch}/land"
    g = raw_games(spark, SF)
    AP.pack_pages(AP.game_items(g)).write.text(f"{scratch}/pages")
    state.ingest_current(spark, f"{scratch}/pages", f"{land}/games", f"{scratch}/mark", "games").awaitTermination()
    res = run_pipeline(spark, land, f"{scratch}/out", layout="state", fail_on=())
    assert res.row_counts["fct_games"] == 2 * g.filter("status = 'Final'").count()
    assert "raw/teams" not in res.paths


def test_failed_export_is_reported_and_exits_nonzero(spark, scratch, capsys, monkeypatch):
    from courtside.__main__ import main
    land = f"{scratch}/landing"
    SN.write_snapshot(raw_games(spark, SF), land, "games")

    def broken(*args, **kw):
        return args[0].select("no_such_column")
    monkeypatch.setattr(exports, "elo_trends", broken)
    assert main(["pipeline", land, f"{scratch}/out", "--report-only"]) == 1
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(out["failed_exports"]) == {"elo_trends"} and "team_win_rates" in out["exports"]
    assert out["profile"]["games"] > 0 and out["rejected"] == {}


def test_missing_column_aborts_the_load(spark, scratch, monkeypatch):
    from courtside.plans import pipeline
    monkeypatch.setattr(pipeline.snapshots, "read_latest",
                        lambda s, d, name, schema: raw_games(s, SF).drop("season") if name == "games"
                        else (_ for _ in ()).throw(FileNotFoundError("Path does not exist")))
    with pytest.raises(Q.QualityError, match="season"):
        run_pipeline(spark, f"{scratch}/none", f"{scratch}/out")


def test_checks_observed_by_the_write_equal_their_queries(spark, scratch):
    w = W.warehouse_for(spark, SF, W.PLACEHOLDER)
    facts = w.table("fct_games").withColumn("win_flag", F.when(F.crc32("game_id") % 50 == 0, 3).otherwise(F.col("win_flag")))
    facts = facts.withColumn("playoff", F.when(F.crc32("game_id") % 70 == 0, None).otherwise(F.col("playoff")))
    df, seen = observed.observed(facts)
    df.write.parquet(f"{scratch}/fct")
    counts = seen.get
    nulls = {r.column_name: r.null_count for r in C.not_null_report({"fct_games": facts}).collect()}
    assert {k[5:]: v for k, v in counts.items() if k.startswith("null.")} == nulls and sum(nulls.values()) > 0
    outside = {}
    for r in C.accepted_values_report({"fct_games": facts}).filter(~F.col("is_accepted")).collect():
        outside[r.column_name] = outside.get(r.column_name, 0) + r.row_count
    assert {k[8:]: v for k, v in counts.items() if k.startswith("outside.") and v} == outside
    assert counts["rows"] == facts.count()
    assert counts["scores_match_outcome"] == C.scores_match_outcome(facts).count()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["dq_two_teams", "dq_one_winner", "dq_rating_zero_sum"])
def test_per_game_rules_need_no_exchange(spark, name):
    df = QUERIES[name](spark, SF)
    assert "Exchange" not in _plan(df)
    plain = "spark.sql.sources.bucketing.enabled"
    rows = sorted(map(tuple, df.collect()))
    spark.conf.set(plain, "false")
    try:
        unbucketed = QUERIES[name](spark, SF)
        assert "Exchange" in _plan(unbucketed) and sorted(map(tuple, unbucketed.collect())) == rows
    finally:
        spark.conf.unset(plain)


def test_text_keys_are_counted_whatever_their_hashes(spark):
    keys = [None, None, "a", "b", "b", "c", "", "", "", *map(str, range(50))]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for digest in (F.xxhash64, F.length, lambda c: F.lit(1)):  # the last two collide
        found = Q.duplicate_text_keys(df, "k", digest=digest).collect()
        assert sorted((r.k, r.n_records) for r in found) == [("", 3), ("b", 2)]


def test_date_windows_open_only_their_folders(spark):
    w = W.warehouse_for(spark, SF)
    window = QUERIES["games_in_range"](spark, SF)
    assert "load_year" in _plan(window).split("PartitionFilters: [")[1].split("]")[0]
    whole = w.raw_games().inputFiles()
    late = [f for f in whole if "load_year=2001" in f]
    assert 0 < len(late) < len(whole)
    trends = _plan(QUERIES["elo_trends"](spark, SF))
    assert "season" in trends.split("PartitionFilters: [")[1].split("]")[0]
    dates = [(1999, dt.date(2000, 6, 1)), (2000, dt.date(2001, 6, 1)), (None, dt.date(2001, 1, 1)), (2001, None)]
    df = spark.createDataFrame([(1999,), (2000,), (2001,), (None,)], "season int")
    assert [r.season for r in exports.in_seasons_since(df, dt.date(2001, 1, 1), dates).collect()] == [2000, None]


def test_home_advantage_leaves_out_games_whose_flag_is_unknown(spark):
    rows = [("A", 2000, dt.date(2000, 1, 1), "HOME", "HOME", 1, 0), ("A", 2000, dt.date(2000, 1, 2), "AWAY", "AWAY", 0, 0),
            ("A", 2000, dt.date(2000, 1, 3), "HOME", "NEUTRAL", 0, 1), ("A", 2000, dt.date(2000, 1, 4), "HOME", "HOME", 0, None)]
    fct = spark.createDataFrame(rows, "team_id string, season int, game_date date, game_location string, "
                                      "adjusted_game_location string, win_flag int, neutral int")
    assert metrics.evaluate(fct, "home_advantage", "year").first().home_advantage == 100.0
    assert metrics.evaluate(fct.drop("neutral"), "home_advantage", "year").first().home_advantage == 50.0


def test_pivot_has_a_column_for_any_season(spark):
    from courtside.plans import dashboard as D
    changes = spark.createDataFrame([("A", 2010, 1.5), ("B", 1950, 2.0)], "team_name string, season int, total_change double")
    grid = D.season_rating_pivot(changes, [1950, 2010])
    assert grid.columns == ["team_name", "1950", "2010"] and grid.where("team_name = 'A'").first()["2010"] == 1.5


def test_changed_lineitem_is_a_new_warehouse(spark, scratch):
    import shutil
    folder = f"{scratch}/sf"
    os.makedirs(folder)
    for name in W.SOURCES:
        shutil.copy(f"{SF}/{name}.parquet", folder)
    before = W.warehouse_for(spark, folder)
    assert W.warehouse_for(spark, folder) is before
    os.utime(f"{folder}/lineitem.parquet", (1, 1))
    assert W.warehouse_for(spark, folder) is not before


def test_reports_with_a_selection(spark, scratch):
    from courtside.plans.pipeline import report
    land, out = f"{scratch}/landing", f"{scratch}/out"
    SN.write_snapshot(raw_games(spark, SF), land, "games")
    run_pipeline(spark, land, out, fail_on=())
    teams = [r.team_name for r in report(spark, out, "default_teams").limit(2).collect()]
    seasons = [r.season for r in report(spark, out, "season_list").limit(1).collect()]
    pick = {"teams": teams, "seasons": seasons}
    for name in ("games", "rating_series", "win_rates", "team_win_rates", "elo_trends"):
        rows = report(spark, out, name, **pick)
        assert 0 < rows.count() < report(spark, out, name).count()
        assert {r.team_name for r in rows.select("team_name").distinct().collect()} <= set(teams)
    assert report(spark, out, "season_rating_pivot", **pick).columns == ["team_name", str(seasons[0])]
    assert report(spark, out, "best_season", **pick).count() == 1 and report(spark, out, "summary", **pick).first().teams_analyzed == 2
    assert report(spark, out, "win_rate", **pick).select("team_id").distinct().count() <= 2
    west = report(spark, out, "games", conference="Western")
    assert {r.conference for r in west.select("conference").distinct().collect()} <= {"Western"}


def test_a_write_that_dies_leaves_the_old_table(spark, scratch):
    from courtside.sources.tables import replace_table
    path = f"{scratch}/t/games"
    replace_table(spark.range(10).withColumn("p", F.col("id") % 2), path, ["p"])
    broken = spark.range(20).withColumn("p", F.when(F.col("id") == 19, F.raise_error(F.lit("dead")).cast("long")).otherwise(1))
    with pytest.raises(Exception, match="dead"):
        replace_table(broken, path, ["p"])
    assert spark.read.parquet(path).count() == 10
    assert replace_table(spark.range(5).withColumn("p", F.lit(1)), path, ["p"]).count() == 5
    assert sorted(os.listdir(f"{scratch}/t")) == ["games"]
