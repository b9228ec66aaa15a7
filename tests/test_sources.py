import json
import os

import pytest
from pyspark.sql import functions as F

from courtside import schemas
from courtside.sources import api_pages as AP
from courtside.sources import csv_tables as CSV
from courtside.sources import snapshots as SN

GAME = {"id": 1001, "date": "2024-01-15T00:00:00.000Z",
        "home_team": {"id": 1, "abbreviation": "LAL", "full_name": "Los Angeles Lakers"},
        "home_team_score": 110,
        "visitor_team": {"id": 2, "abbreviation": "BOS", "full_name": "Boston Celtics"},
        "visitor_team_score": 105, "period": 4, "postseason": False, "season": 2024,
        "status": "Final", "time": ""}
TEAM = {"id": 1, "abbreviation": "LAL", "city": "Los Angeles", "conference": "West",
        "division": "Pacific", "full_name": "Los Angeles Lakers", "name": "Lakers"}


def _write_pages(path, pages):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "page.json"), "w") as f:
        for p in pages:
            f.write(json.dumps(p) + "\n")


def test_flatten_games_and_missing_time(spark, scratch):
    g2 = dict(GAME, id=1002)
    g2.pop("time")
    _write_pages(scratch, [{"data": [GAME, g2], "meta": {"current_page": 1, "total_pages": 1}}])
    flat = AP.flatten_games(AP.read_pages(spark, scratch, schemas.GAMES_PAGE))
    assert len(flat.columns) == 15
    rows = {r.game_id: r for r in flat.collect()}
    assert rows[1001].home_team_abbreviation == "LAL" and rows[1001].visitor_team_score == 105
    assert rows[1002].time == ""
    typed = AP.typed_games(flat).first()
    assert typed.date.year == 2024 and typed.date.hour == 0


def test_flatten_teams(spark, scratch):
    _write_pages(scratch, [{"data": [TEAM]}])
    t = AP.flatten_teams(AP.read_pages(spark, scratch, schemas.TEAMS_PAGE)).first()
    assert (t.team_id, t.name, t.division) == (1, "Lakers", "Pacific")


def test_player_stats_keep_good_pages(spark, scratch):
    good = {"data": [{"player_id": 7, "season": 2024, "games_played": 3, "min": "31:20",
                      **{c: 1.5 for c in schemas.PLAYER_STAT_COLUMNS}}]}
    os.makedirs(scratch, exist_ok=True)
    with open(os.path.join(scratch, "p.json"), "w") as f:
        f.write(json.dumps(good) + "\n{not json\n")
    pages = AP.read_pages(spark, scratch, schemas.PLAYER_STATS_PAGE, mode="PERMISSIVE")
    rows = AP.flatten_player_stats(pages).collect()
    bad = [r.page for r in AP.rejected_pages(pages).collect()]
    assert bad == ["{not json"]
    assert len(rows) == 1 and rows[0]["min"] == "31:20" and len(rows[0]) == 22


def test_csv_empty_is_null_and_bad_type_fails(spark, scratch):
    p = os.path.join(scratch, "teams")
    os.makedirs(p)
    with open(os.path.join(p, "a.csv"), "w") as f:
        f.write("team_id,abbreviation,city,conference,division,full_name,name\n"
                "1,LAL,,West,Pacific,Los Angeles Lakers,Lakers\n")
    r = CSV.read_teams(spark, p).first()
    assert r.city is None and r.team_id == 1
    bad = os.path.join(scratch, "bad")
    os.makedirs(bad)
    with open(os.path.join(bad, "a.csv"), "w") as f:
        f.write("team_id,abbreviation,city,conference,division,full_name,name\nx,L,,,,,\n")
    with pytest.raises(Exception):
        CSV.read_teams(spark, bad).collect()


def test_games_csv_round_trip(spark, scratch):
    from courtside.sources.fixture import raw_games
    g = raw_games(spark, "/root/testdata/sf0.001")
    CSV.write_csv(g, f"{scratch}/games")
    back = CSV.read_games(spark, f"{scratch}/games")
    assert back.schema == schemas.RAW_GAMES
    diff = g.withColumn("time", F.lit(None).cast("string")).exceptAll(back)
    assert diff.count() == 0  # empty time comes back NULL, everything else equal


def test_missing_input_is_skipped(spark, scratch):
    assert CSV.optional(CSV.read_games, spark, f"{scratch}/nope") is None


def test_snapshots_latest_pointer(spark, scratch):
    a = spark.createDataFrame([(1, "old")], "team_id int, abbreviation string")
    b = spark.createDataFrame([(2, "new")], "team_id int, abbreviation string")
    SN.write_snapshot(a, scratch, "teams", "20240101_000000")
    SN.write_snapshot(b, scratch, "teams", "20240102_000000")
    assert SN.latest_stamp(spark, scratch, "teams") == "20240102_000000"
    got = SN.read_latest(spark, scratch, "teams", a.schema).collect()
    assert [tuple(r) for r in got] == [(2, "new")]
    assert [r.name for r in SN.list_latest(spark, scratch).collect()] == ["teams"]
    pv = SN.preview(b, [F.col("team_id")], 100).first()
    assert pv.total_rows == 1


def test_pack_pages_round_trip(spark, scratch):
    from courtside.sources.fixture import raw_games
    g = raw_games(spark, "/root/testdata/sf0.001")
    AP.pack_pages(AP.game_items(g), 100).write.text(f"{scratch}/pages")
    pages = AP.read_pages(spark, f"{scratch}/pages", schemas.GAMES_PAGE)
    sizes = [r[0] for r in pages.select(F.size("data")).collect()]
    assert max(sizes) <= 100 and sum(sizes) == g.count()
    totals = {r[0] for r in pages.select("meta.total_pages").collect()}
    assert totals == {len(sizes)}


def test_player_stats_and_allelo_csv(spark, scratch):
    p = os.path.join(scratch, "ps")
    os.makedirs(p)
    cols = ["player_id", "season", "games_played", "min"] + schemas.PLAYER_STAT_COLUMNS
    with open(os.path.join(p, "a.csv"), "w") as f:
        f.write(",".join(cols) + "\n" + "7,2024,3,31:20," + ",".join(["1.5"] * 18) + "\n")
    r = CSV.read_player_stats(spark, p).first()
    assert r["min"] == "31:20" and r.pts == 1.5 and r.player_id == 7
    a = os.path.join(scratch, "allelo")
    os.makedirs(a)
    with open(os.path.join(a, "a.csv"), "w") as f:
        f.write(",".join(f.name for f in schemas.RAW_ALLTIME_RATINGS.fields) + "\n"
                "1,g1,LG,1/1/1947,Knicks,Celtics,1300.0,1310.0,40.0,BOS,1300.0,1290.0,H,W,0.64,\n")
    r = CSV.read_alltime_ratings(spark, a).first()
    assert r.game_location == "H" and r.notes is None and r.forecast == 0.64


def test_expected_columns_check(spark):
    from courtside.operators.quality import missing_columns
    from courtside.plans.checks import EXPECTED_COLUMNS
    elo = spark.createDataFrame([], schemas.RAW_ELO)
    assert missing_columns(elo, EXPECTED_COLUMNS["elo"]) == []
    allelo = spark.createDataFrame([], schemas.RAW_ALLTIME_RATINGS)
    assert missing_columns(allelo, EXPECTED_COLUMNS["alltime_ratings"]) == ["team", "elo"]


def test_win_rates_download(spark, scratch):
    from courtside.plans import dashboard as D
    rates = spark.createDataFrame([("A", 2000, 2, 3, 66.67)],
                                  "team_name string, season int, wins long, games long, win_rate double")
    D.download_win_rates(rates, f"{scratch}/dl")
    back = CSV.read_csv(spark, f"{scratch}/dl", rates.schema).collect()
    assert [tuple(r) for r in back] == [("A", 2000, 2, 3, 66.67)]


def test_pack_pages_bounded_with_repeated_keys(spark, scratch):
    items = spark.range(0, 1000, 1, 4).select(F.lit(7).cast("long").alias("key"),
                                             F.struct(F.col("id").alias("id")).alias("item"))
    AP.pack_pages(items, 100).write.text(f"{scratch}/p")
    schema = "data array<struct<id:bigint>>, meta struct<current_page:bigint,total_pages:int>"
    pages = spark.read.schema(schema).json(f"{scratch}/p")
    sizes = [r[0] for r in pages.select(F.size("data")).collect()]
    assert max(sizes) <= 100 and sum(sizes) == 1000
    assert pages.select("meta.current_page").distinct().count() == len(sizes)


def test_broken_pointer_is_no_missing_input(spark, scratch):
    import pytest

    from courtside.sources import snapshots as SN
    from courtside.sources.csv_tables import optional
    df = spark.createDataFrame([(1,)], "a int")
    SN.write_snapshot(df, scratch, "games", "20010101_000000")
    SN.write_snapshot(df, scratch, "games", "20010102_000000")
    assert SN.latest_stamp(spark, scratch, "games") == "20010102_000000"
    (spark.range(1).selectExpr("'games' AS name", "'20990101_000000' AS snapshot_ts", "'x' AS path")
     .write.mode("append").json(f"{scratch}/games/{SN.POINTER}"))
    with pytest.raises(SN.BrokenPointer):
        optional(SN.read_latest, spark, scratch, "games", df.schema)
    assert optional(SN.read_latest, spark, scratch, "absent", df.schema) is None


def test_csv_header_must_match_the_schema(spark, scratch):
    import pytest
    from courtside.sources.csv_tables import read_teams, write_csv
    rows = spark.createDataFrame([(1, "A", "x", "East", "d", "Full", "n")],
                                 "team_id int, abbreviation string, city string, conference string, "
                                 "division string, full_name string, name string")
    write_csv(rows, f"{scratch}/good")
    assert read_teams(spark, f"{scratch}/good").count() == 1
    write_csv(rows.select("team_id", "city", "abbreviation", "conference", "division", "full_name",
                          "name"), f"{scratch}/swapped")
    with pytest.raises(Exception, match="header|schema|MALFORMED"):
        read_teams(spark, f"{scratch}/swapped").collect()
