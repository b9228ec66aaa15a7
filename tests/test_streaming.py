import os
import time

from pyspark.sql import functions as F

from courtside import schemas
from courtside.sources import api_pages as AP
from courtside.sources.fixture import raw_games
from courtside.streaming import landing as ST


def test_stream_ingest_is_exactly_once(spark, scratch):
    g = raw_games(spark, "/root/testdata/sf0.001")
    land, table, ckpt = f"{scratch}/landing", f"{scratch}/table", f"{scratch}/ckpt"
    first = g.filter("game_id % 2 = 0")
    AP.pack_pages(AP.game_items(first)).write.text(f"{land}/batch=1")
    ST.ingest_game_pages(spark, land, table, ckpt).awaitTermination()
    assert ST.read_landings(spark, table).count() == first.count()
    # a second landing: only the new files are processed, nothing twice
    AP.pack_pages(AP.game_items(g.filter("game_id % 2 = 1"))).write.text(f"{land}/batch=2")
    ST.ingest_game_pages(spark, land, table, ckpt).awaitTermination()
    assert ST.read_landings(spark, table).count() == g.count()
    got = ST.read_ingested(spark, table)
    assert got.schema == schemas.RAW_GAMES
    assert got.exceptAll(g).count() == 0 and g.exceptAll(got).count() == 0


def test_overlapping_fetch_keeps_latest_landing(spark, scratch):
    g = raw_games(spark, "/root/testdata/sf0.001").filter("game_id < 200")
    land, table, ckpt = f"{scratch}/landing", f"{scratch}/table", f"{scratch}/ckpt"
    early = g.withColumn("status", F.lit("Scheduled"))
    AP.pack_pages(AP.game_items(early)).write.text(f"{land}/day=1")
    ST.ingest_game_pages(spark, land, table, ckpt).awaitTermination()
    time.sleep(1.1)  # the next fetch lands later
    AP.pack_pages(AP.game_items(g)).write.text(f"{land}/day=2")
    ST.ingest_game_pages(spark, land, table, ckpt).awaitTermination()
    assert ST.read_landings(spark, table).count() == 2 * g.count()
    cur = ST.read_ingested(spark, table)
    assert cur.count() == g.count()
    assert cur.exceptAll(g).count() == 0  # the later status won
