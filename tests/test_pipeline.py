from pyspark.sql import functions as F

from courtside.plans.pipeline import run_pipeline
from courtside.sources import snapshots as SN
from courtside.sources.fixture import raw_games


def test_pipeline_end_to_end(spark, scratch):
    land = f"{scratch}/landing"
    SN.write_snapshot(raw_games(spark, "/root/testdata/sf0.001"), land, "games")
    res = run_pipeline(spark, land, f"{scratch}/out", stamp="20240101_030000", fail_on=())
    assert res.row_counts["fct_games"] > 0 and res.row_counts["dim_teams"] > 0
    assert "raw/teams" not in res.paths  # missing input skipped
    assert res.checks["relationships_team"] == 0
    assert res.checks["elo_changes_sum_to_zero"] > 0  # placeholder ties break zero-sum
    assert set(res.exports) == {"team_win_rates", "elo_trends", "point_diff_by_season"}
    names = {r.name for r in SN.list_latest(spark, f"{scratch}/out/exports").collect()}
    assert names == set(res.exports)
    fct = spark.read.parquet(f"{scratch}/out/marts/fct_games")
    assert "last_updated" in fct.columns and "season" in fct.columns


def test_pages_to_exports_like_the_smoke_run(spark, scratch):
    """Landed team and game pages -> typed raw snapshots -> pipeline -> exports."""
    import json
    import os

    from courtside import schemas
    from courtside.sources import api_pages as AP

    pages = f"{scratch}/pages"
    os.makedirs(pages)
    game = {"id": 1001, "date": "2024-01-15T00:00:00.000Z",
            "home_team": {"id": 1, "abbreviation": "LAL", "full_name": "Los Angeles Lakers"},
            "home_team_score": 110,
            "visitor_team": {"id": 2, "abbreviation": "BOS", "full_name": "Boston Celtics"},
            "visitor_team_score": 105, "period": 4, "postseason": False, "season": 2024,
            "status": "Final", "time": ""}
    with open(f"{pages}/games.json", "w") as f:
        f.write(json.dumps({"data": [game], "meta": {"current_page": 1, "total_pages": 1}}))
    games = AP.typed_games(AP.flatten_games(AP.read_pages(spark, pages, schemas.GAMES_PAGE)))
    land = f"{scratch}/landing"
    SN.write_snapshot(games, land, "games", "20240116_030000")
    res = run_pipeline(spark, land, f"{scratch}/out", stamp="20240116_040000")
    assert res.row_counts == {"dim_teams": 2, "fct_games": 2}
    assert res.checks["one_winner_per_game"] == 0 and res.checks["elo_changes_sum_to_zero"] == 0
    rates = SN.read_latest(spark, f"{scratch}/out/exports", "team_win_rates",
                           "team_name string, season int, games_played long, wins long, "
                           "win_rate double, avg_point_diff double").collect()
    assert sorted((r.team_name, r.win_rate) for r in rates) == [("BOS", 0.0), ("LAL", 100.0)]


def test_failing_check_stops_before_export(spark, scratch):
    import os

    import pytest
    from courtside.operators.quality import QualityError
    land = f"{scratch}/landing"
    SN.write_snapshot(raw_games(spark, "/root/testdata/sf0.001"), land, "games")
    with pytest.raises(QualityError, match="elo_changes_sum_to_zero|unique|one_winner|scores"):
        run_pipeline(spark, land, f"{scratch}/out")
    assert not os.path.exists(f"{scratch}/out/exports")


def test_load_aborts_on_repeated_primary_key(spark, scratch):
    import pytest
    from courtside.operators.quality import QualityError
    g = raw_games(spark, "/root/testdata/sf0.001")
    land = f"{scratch}/landing"
    SN.write_snapshot(g.unionByName(g.limit(1)), land, "games")
    with pytest.raises(QualityError):
        run_pipeline(spark, land, f"{scratch}/out")


def test_flat_timestamped_landing(spark, scratch):
    import os
    import shutil

    from courtside.sources.csv_tables import write_csv
    land = f"{scratch}/raw"
    os.makedirs(land)
    g = raw_games(spark, "/root/testdata/sf0.001")
    for stamp, df in (("20240101_030000", g.limit(10)), ("20240102_030000", g)):
        tmp = f"{scratch}/tmp_{stamp}"
        write_csv(df.coalesce(1), tmp)
        part = [f for f in os.listdir(tmp) if f.endswith(".csv")][0]
        shutil.copy(f"{tmp}/{part}", f"{land}/games_{stamp}.csv")
    assert SN.latest_flat_file(spark, land, "games").endswith("games_20240102_030000.csv")
    res = run_pipeline(spark, land, f"{scratch}/out", layout="flat", fail_on=())
    assert res.row_counts["fct_games"] == 2 * g.filter("status = 'Final'").count()


def test_pages_landing(spark, scratch):
    from courtside.sources import api_pages as AP
    g = raw_games(spark, "/root/testdata/sf0.001")
    AP.pack_pages(AP.game_items(g)).write.text(f"{scratch}/pages/games")
    res = run_pipeline(spark, f"{scratch}/pages", f"{scratch}/out", layout="pages", fail_on=())
    assert res.row_counts["fct_games"] == 2 * g.filter("status = 'Final'").count()
    assert "raw/teams" not in res.paths


def test_command_line_pipeline(spark, scratch, capsys):
    import json

    from courtside.__main__ import main
    land = f"{scratch}/landing"
    SN.write_snapshot(raw_games(spark, "/root/testdata/sf0.001"), land, "games")
    assert main(["pipeline", land, f"{scratch}/out", "--report-only"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["row_counts"]["dim_teams"] == 24 and "team_win_rates" in out["exports"]


def test_reports_over_pipeline_marts(spark, scratch):
    from courtside.plans.pipeline import report
    land = f"{scratch}/landing"
    SN.write_snapshot(raw_games(spark, "/root/testdata/sf0.001"), land, "games")
    run_pipeline(spark, land, f"{scratch}/out", fail_on=())
    rates = report(spark, f"{scratch}/out", "team_win_rates")
    assert rates.count() > 0 and "win_rate" in rates.columns
    assert report(spark, f"{scratch}/out", "win_rate", grain="year").count() > 0
    assert "home_advantage" in report(spark, f"{scratch}/out", "home_advantage").columns


def test_pipeline_with_the_alias_seed_file(spark, scratch):
    import os
    seed = os.path.join(os.path.dirname(os.path.dirname(__file__)), "courtside", "seeds",
                        "team_aliases.csv")
    land = f"{scratch}/landing"
    SN.write_snapshot(raw_games(spark, "/root/testdata/sf0.001"), land, "games")
    res = run_pipeline(spark, land, f"{scratch}/out", aliases_path=seed, fail_on=())
    assert res.checks["alias_duplicates (report only)"] == 3  # Nets, Hornets, Royals
    assert res.row_counts["fct_games"] == 2 * raw_games(spark, "/root/testdata/sf0.001") \
        .filter("status = 'Final'").count()


def test_overlapping_page_landings_end_with_every_export(spark, scratch):
    """Two fetches land overlapping games; the later page of a game counts, from pages and stream."""
    import os
    import time

    from courtside.sources import api_pages as AP
    from courtside.streaming import landing as ST
    g = raw_games(spark, "/root/testdata/sf0.001").where("status = 'Final'").orderBy("game_id")
    n, again = g.count(), g.limit(40).withColumn("home_team_score", F.lit(200))
    AP.pack_pages(AP.game_items(g)).write.text(f"{scratch}/pages/games")
    for f in os.listdir(f"{scratch}/pages/games"):
        os.utime(f"{scratch}/pages/games/{f}", (time.time() - 3600,) * 2)
    AP.pack_pages(AP.game_items(again)).write.mode("append").text(f"{scratch}/pages/games")

    res = run_pipeline(spark, f"{scratch}/pages", f"{scratch}/out", layout="pages", fail_on=())
    assert res.profile["games"] == n and not res.failed_exports and len(res.exports) == 3
    raw = spark.read.parquet(f"{scratch}/out/raw/games")
    assert raw.where("home_team_score = 200").count() == 40

    ST.ingest_game_pages(spark, f"{scratch}/pages/games", f"{scratch}/tables/games",
                         f"{scratch}/ckpt").awaitTermination()
    res2 = run_pipeline(spark, f"{scratch}/tables", f"{scratch}/out2", layout="table", fail_on=())
    assert res2.profile == res.profile and res2.row_counts == res.row_counts


def test_profile_of_a_load(spark, scratch):
    land = f"{scratch}/landing"
    g = raw_games(spark, "/root/testdata/sf0.001")
    no_score = F.when(F.col("status") != "Final", F.col("home_team_score"))
    SN.write_snapshot(g.withColumn("home_team_score", F.when(
        F.col("game_id") % 2 == 0, F.col("home_team_score")).otherwise(no_score)), land, "games")
    res = run_pipeline(spark, land, f"{scratch}/out", fail_on=(), min_rows=10 ** 9)
    odd = g.where("game_id % 2 = 1 AND status = 'Final'").count()
    assert res.profile["null_scores"] == odd > 0 and res.profile["teams"] is None
    assert res.profile["games"] == g.count()
    assert res.checks["min_rows (report only)"] == 2
