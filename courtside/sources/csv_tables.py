"""Typed CSV loads (header, ',' delimiter, empty field = NULL) and CSV writes.

Loads use an explicit schema and FAILFAST: a field of the wrong type aborts
the load (when the action runs) instead of silently becoming NULL.
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from courtside import schemas

log = logging.getLogger(__name__)

ISO_TS = "yyyy-MM-dd'T'HH:mm:ss[.SSS][XXX]"


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             mode: str = "FAILFAST") -> DataFrame:
    return (spark.read.schema(schema).option("header", True).option("sep", ",")
            .option("nullValue", "").option("emptyValue", "").option("mode", mode)
            .option("enforceSchema", False)  # a header that differs from the schema is an error
            .option("timestampFormat", ISO_TS).csv(path))


def read_teams(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_TEAMS)


def read_games(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_GAMES)


def read_player_stats(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_PLAYER_STATS)


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.TEAM_ALIASES)


def read_alltime_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Reader for the declared all-time ratings source (no loader exists for it)."""
    return read_csv(spark, path, schemas.RAW_ALLTIME_RATINGS)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header + ISO timestamps; one file per task (no single-file funnel)."""
    (df.write.mode(mode).option("header", True).option("nullValue", "")
     .option("emptyValue", "").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
     .csv(path))


def optional(loader, *args, what: str = "input"):
    """Run ``loader``; a missing path gives ``None`` and a warning, other errors raise."""
    try:
        df = loader(*args)
        df.schema  # noqa: B018  (forces the path listing)
        return df
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            log.warning("missing input %s: skipped", what)
            return None
        raise
    except FileNotFoundError:
        log.warning("missing input %s: skipped", what)
        return None
