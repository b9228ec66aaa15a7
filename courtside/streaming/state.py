"""The latest landing of each key, kept as a table that micro-batches update in place.

A keyed table is cut into parts by an expression over its keys (games by ranges of ids,
player seasons by season), so what lands together is kept together. A micro-batch is
first reduced to the latest row of each of its keys. Only the parts these keys
belong to are read, merged and written again, under the batch's own version; a
manifest names the version of each part that the batch replaced. Readers take
the newest version of each part, so a half-written batch is never read, and a
batch that runs again after a failure writes the same version anew from the
versions before it: in effect each landing counts exactly once.

Versions that no manifest names any more are not read again and may be removed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from courtside import schemas
from courtside.sources import api_pages

LANDED_AT = "landed_at"
PART, VERSION = "part", "version"
_MANIFEST = T.StructType([T.StructField(PART, T.StringType()), T.StructField(VERSION, T.LongType())])


@dataclass(frozen=True)
class KeyedInput:
    """A landed input: its page layout, typed rows and keys, and the part a key belongs to."""

    name: str
    keys: tuple[str, ...]
    part: str                       # SQL expression over the keys
    page: T.StructType
    rows: T.StructType
    flatten: Callable[..., DataFrame]
    mode: str = "FAILFAST"


#: Games in ranges of ids (ids rise with time), players by season, teams in one part.
INPUTS = {
    "games": KeyedInput("games", ("game_id",), "game_id div 10000", schemas.GAMES_PAGE, schemas.RAW_GAMES,
                        api_pages.flatten_games),
    "teams": KeyedInput("teams", ("team_id",), "'all'", schemas.TEAMS_PAGE, schemas.RAW_TEAMS,
                        api_pages.flatten_teams),
    "player_stats": KeyedInput("player_stats", ("player_id", "season"), "season", schemas.PLAYER_STATS_PAGE,
                               schemas.RAW_PLAYER_STATS, api_pages.flatten_player_stats, "PERMISSIVE"),
}


def typed(pages: DataFrame, of: KeyedInput) -> DataFrame:
    """Rows of landed pages in the input's types, with the time their page landed."""
    pages = pages.withColumn(LANDED_AT, F.col("_metadata.file_modification_time"))
    flat = of.flatten(pages, keep=[LANDED_AT])
    if of.name == "games":
        return api_pages.typed_games(flat, keep=[LANDED_AT])
    return flat.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in of.rows.fields], LANDED_AT)


def latest(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The row that landed last for each key (null keys are one key); of rows landed together the largest.

    Combined map-side: a key that landed many times is one row a task before the shuffle.
    """
    top = F.max(F.struct(LANDED_AT, *columns)).alias("r")
    return rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(top).select(
        *[f"r.{c}" for c in columns], f"r.{LANDED_AT}")


def landed(spark: SparkSession, pages_dir: str, name: str) -> DataFrame:
    """The latest landing of each key of a folder of pages (batch), in the raw table's layout."""
    of = INPUTS[name]
    pages = api_pages.read_pages(spark, f"{pages_dir.rstrip('/')}/{name}", of.page, mode=of.mode)
    columns = [f.name for f in of.rows.fields]
    return latest(typed(pages, of), of.keys, columns).select(*columns)


def _versions(spark: SparkSession, table_dir: str, before: int | None = None,
              parts: Sequence[str] | None = None) -> list[tuple[str, int]]:
    """(part, version) of the newest version of each part; a row for each part."""
    try:
        named = spark.read.schema(_MANIFEST).json(f"{table_dir.rstrip('/')}/manifest/*")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []
    if before is not None:
        named = named.where(F.col(VERSION) < before)
    if parts is not None:
        named = named.where(F.col(PART).isin(list(parts)))
    return [(r[PART], r[VERSION]) for r in named.groupBy(PART).agg(F.max(VERSION).alias(VERSION)).collect()]


def _part_path(table_dir: str, part: str, version: int) -> str:
    return f"{table_dir.rstrip('/')}/data/{VERSION}={version}/{PART}={part}"


def _read(spark: SparkSession, table_dir: str, of: KeyedInput, versions: list[tuple[str, int]]) -> DataFrame:
    schema = T.StructType([*of.rows.fields, T.StructField(LANDED_AT, T.TimestampType())])
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[_part_path(table_dir, p, v) for p, v in versions]).select(
        *schema.fieldNames())


def current(spark: SparkSession, table_dir: str, name: str) -> DataFrame:
    """The keyed table as of its last batch, in the raw table's layout."""
    of = INPUTS[name]
    return _read(spark, table_dir, of, _versions(spark, table_dir)).select(*[f.name for f in of.rows.fields])


def merge(batch: DataFrame, version: int, table_dir: str, name: str) -> list[str]:
    """Merge a micro-batch of typed rows into the keyed table; the parts that were written again."""
    of, spark = INPUTS[name], batch.sparkSession
    columns = [f.name for f in of.rows.fields]
    part = F.coalesce(F.expr(of.part).cast("string"), F.lit("none")).alias(PART)
    new = latest(batch, of.keys, columns)
    parts = sorted(r[PART] for r in new.select(part).distinct().collect())  # a row for each part of the batch
    if not parts:
        return parts
    old = _read(spark, table_dir, of, _versions(spark, table_dir, version, parts))
    merged = latest(new.unionByName(old), of.keys, columns).select("*", part)
    merged.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(
        f"{table_dir.rstrip('/')}/data/{VERSION}={version}")
    named = spark.range(0, 1, 1, 1).select(F.explode(F.lit(parts)).alias(PART), F.lit(version).cast("long").alias(VERSION))
    named.write.mode("overwrite").json(f"{table_dir.rstrip('/')}/manifest/batch={version}")
    return parts


def ingest_current(spark: SparkSession, pages_dir: str, table_dir: str, checkpoint_dir: str, name: str,
                   available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream landed pages of an input into its keyed table; with ``available_now`` until the backlog is merged.

    A table belongs to one checkpoint, whose batch numbers are its versions.
    """
    of = INPUTS[name]
    schema = of.page
    if of.mode == "PERMISSIVE":
        schema = T.StructType([*of.page.fields, T.StructField(api_pages.CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).option("mode", of.mode).option(
        "columnNameOfCorruptRecord", api_pages.CORRUPT)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (typed(reader.json(pages_dir), of).writeStream.option("checkpointLocation", checkpoint_dir)
              .foreachBatch(lambda batch, number: merge(batch, number, table_dir, name)))
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()
