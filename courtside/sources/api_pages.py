"""Landed API pages (``{data: [...], meta: {...}}``) -> flat rows.

Pages are read with an explicit schema, one page per JSON line, so a folder
of pages splits across tasks like any text input; ``explode`` turns each
page's array into rows without leaving the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside import schemas

CORRUPT = "_corrupt_record"


def read_pages(spark: SparkSession, path: str, page_schema: T.StructType,
               mode: str = "FAILFAST", multiline: bool = False) -> DataFrame:
    """Read pages. PERMISSIVE keeps the good pages and flags bad ones in ``_corrupt_record``."""
    schema = page_schema
    reader = spark.read.option("mode", mode).option("multiLine", multiline)
    if mode == "PERMISSIVE":
        schema = T.StructType([*page_schema.fields, T.StructField(CORRUPT, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(schema).json(path)


def _items(pages: DataFrame, keep=()) -> DataFrame:
    if CORRUPT in pages.columns:
        pages = pages.filter(F.col(CORRUPT).isNull())
    return pages.select(F.explode("data").alias("g"), *keep)


def rejected_pages(pages: DataFrame) -> DataFrame:
    """The pages of a PERMISSIVE read that are no valid page, as landed."""
    # a raw JSON scan must read a data column beside the rejected text
    return pages.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("page"), F.col("data").isNotNull().alias("partly_read"))


def flatten_teams(pages: DataFrame, keep=()) -> DataFrame:
    """7 team columns; ``id`` becomes ``team_id``."""
    return _items(pages, keep).select(
        F.col("g.id").alias("team_id"), "g.abbreviation", "g.city", "g.conference",
        "g.division", "g.full_name", "g.name", *keep)


def flatten_games(pages: DataFrame, keep=()) -> DataFrame:
    """15 game columns from the nested home/visitor team structs; missing time = ''.

    ``keep`` names page-level columns to carry onto every row.
    """
    return _items(pages, keep).select(
        F.col("g.id").alias("game_id"),
        F.col("g.date").alias("date"),
        F.col("g.home_team.id").alias("home_team_id"),
        F.col("g.home_team.abbreviation").alias("home_team_abbreviation"),
        F.col("g.home_team.full_name").alias("home_team_name"),
        F.col("g.home_team_score").alias("home_team_score"),
        F.col("g.visitor_team.id").alias("visitor_team_id"),
        F.col("g.visitor_team.abbreviation").alias("visitor_team_abbreviation"),
        F.col("g.visitor_team.full_name").alias("visitor_team_name"),
        F.col("g.visitor_team_score").alias("visitor_team_score"),
        F.col("g.period").alias("period"),
        F.col("g.postseason").alias("postseason"),
        F.col("g.season").alias("season"),
        F.col("g.status").alias("status"),
        F.coalesce(F.col("g.time"), F.lit("")).alias("time"),
        *keep,
    )


def flatten_player_stats(pages: DataFrame, keep=()) -> DataFrame:
    """22 player season-average columns (``min`` stays a string)."""
    return _items(pages, keep).select(*[F.col(f"g.{f.name}").alias(f.name)
                                        for f in schemas.API_PLAYER_STAT.fields], *keep)


def typed_games(flat: DataFrame, keep=()) -> DataFrame:
    """Flattened games with the ISO date string parsed to a timestamp (raw.games types)."""
    return flat.withColumn("date", F.to_timestamp("date")).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.RAW_GAMES.fields],
        *keep)


def read_landed(spark: SparkSession, pages_dir: str, name: str,
                schema: T.StructType | None = None) -> DataFrame:
    """``<pages_dir>/<name>`` pages as a typed raw table (games, teams, player_stats).

    Games and teams fail fast on a bad page; player statistics keep the
    good pages (PERMISSIVE), as the fetch step keeps what it read.
    """
    path = f"{pages_dir.rstrip('/')}/{name}"
    if name == "games":
        return typed_games(flatten_games(read_pages(spark, path, schemas.GAMES_PAGE)))
    if name == "teams":
        flat = flatten_teams(read_pages(spark, path, schemas.TEAMS_PAGE))
        return flat.select(*[F.col(f.name).cast(f.dataType) for f in schemas.RAW_TEAMS.fields])
    if name == "player_stats":
        return flatten_player_stats(read_pages(spark, path, schemas.PLAYER_STATS_PAGE,
                                               mode="PERMISSIVE"))
    raise KeyError(name)


# ---- writing pages (landing data for tests and the round-trip queries) --------

def game_items(raw_games: DataFrame) -> DataFrame:
    """raw.games rows -> API game structs (``date`` as ISO-8601 with ``Z``)."""
    def team(prefix: str):
        return F.struct(F.col(f"{prefix}_team_id").alias("id"),
                        F.col(f"{prefix}_team_abbreviation").alias("abbreviation"),
                        F.col(f"{prefix}_team_name").alias("full_name"))
    return raw_games.select(
        F.col("game_id").alias("key"),
        F.struct(
            F.col("game_id").alias("id"),
            F.date_format("date", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("date"),
            team("home").alias("home_team"),
            F.col("home_team_score"),
            team("visitor").alias("visitor_team"),
            F.col("visitor_team_score"),
            "period", "postseason", "season", "status", "time").alias("item"))


def pack_pages(items: DataFrame, page_size: int = 100) -> DataFrame:
    """(key, item) rows -> one JSON page per line, at most ``page_size`` items each.

    Pages are cut from each input partition in row order, so a page never
    spans two partitions and never holds more than ``page_size`` items,
    however the keys repeat; grouping on (partition, page) then gathers at
    most ``page_size`` rows per group. Items inside a page are sorted by key.
    ``current_page`` is a unique page id (partition * 2^31 + page number);
    ``total_pages`` is sum(ceil(rows / page_size)) over partitions, a
    scalar subquery on a partial count.
    """
    part = F.spark_partition_id()
    pos = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    paged = items.select("key", "item", part.alias("part"),
                         F.floor(pos / page_size).alias("local"))
    pages = (paged.groupBy("part", "local")
             .agg(F.sort_array(F.collect_list(F.struct("key", "item"))).alias("entries")))
    per_part = paged.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    total = per_part.agg(F.sum(F.ceil(F.col("n") / page_size)).cast("int")).scalar()
    page_id = F.col("part").cast("long") * (1 << 31) + F.col("local") + 1
    return pages.select(F.to_json(F.struct(
        F.transform("entries", lambda e: e["item"]).alias("data"),
        F.struct(page_id.alias("current_page"), total.alias("total_pages")).alias("meta")))
        .alias("value"))
