"""Timestamped snapshots with a "latest" pointer (CSV raw data and CSV exports).

A snapshot is appended as a ``snapshot_ts=...`` partition of one dataset;
after the write commits, a one-row pointer naming that partition is added, and
the pointer with the largest stamp counts. Readers go through the pointers, so a half-written
snapshot is never read, and the partition filter prunes every older
snapshot at listing time (no scan of old data to find the newest).
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.sources.csv_tables import read_csv, write_csv

POINTER = "_latest"
SNAPSHOT_COL = "snapshot_ts"
_POINTER_SCHEMA = T.StructType([T.StructField("name", T.StringType()),
                                T.StructField(SNAPSHOT_COL, T.StringType()),
                                T.StructField("path", T.StringType())])


class BrokenPointer(RuntimeError):
    """A pointer names a snapshot that does not exist (not a missing optional input)."""


def snapshot_stamp(when: dt.datetime | None = None) -> str:
    """``%Y%m%d_%H%M%S`` stamp of the snapshot time."""
    return (when or dt.datetime.now(dt.timezone.utc)).strftime("%Y%m%d_%H%M%S")


def write_snapshot(df: DataFrame, base_dir: str, name: str, stamp: str | None = None) -> str:
    """Append ``df`` as a new snapshot of ``name``, then append a pointer to it.

    Pointers are added, never replaced, and the largest stamp counts, so a
    reader or a crash at any moment finds the last complete snapshot.
    """
    stamp = stamp or snapshot_stamp()
    path = f"{base_dir.rstrip('/')}/{name}"
    write_csv(df, f"{path}/{SNAPSHOT_COL}={stamp}", mode="overwrite")
    spark = df.sparkSession
    pointer = spark.range(0, 1, 1, 1).select(F.lit(name).alias("name"), F.lit(stamp).alias(SNAPSHOT_COL),
                                    F.lit(path).alias("path"))
    pointer.write.mode("append").json(f"{path}/{POINTER}")
    return stamp


def latest_stamp(spark: SparkSession, base_dir: str, name: str) -> str | None:
    pointers = spark.read.schema(_POINTER_SCHEMA).json(f"{base_dir.rstrip('/')}/{name}/{POINTER}")
    return pointers.agg(F.max(SNAPSHOT_COL)).first()[0]


def read_latest(spark: SparkSession, base_dir: str, name: str,
                schema: T.StructType) -> DataFrame:
    """The newest committed snapshot of ``name`` with the given schema."""
    stamp = latest_stamp(spark, base_dir, name)
    if stamp is None:
        raise FileNotFoundError(f"no snapshot of {name} under {base_dir}")
    path = f"{base_dir.rstrip('/')}/{name}/{SNAPSHOT_COL}={stamp}"
    try:
        return read_csv(spark, path, schema)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        raise BrokenPointer(f"the pointer of {name} names {path}, which is gone") from e


def list_latest(spark: SparkSession, base_dir: str) -> DataFrame:
    """One row per dataset with a pointer: (name, snapshot_ts, path)."""
    pointers = spark.read.schema(_POINTER_SCHEMA).json(f"{base_dir.rstrip('/')}/*/{POINTER}")
    return pointers.groupBy("name").agg(F.max(F.struct(SNAPSHOT_COL, "path")).alias("p")).select(
        "name", f"p.{SNAPSHOT_COL}", "p.path")


def preview(df: DataFrame, order_by: list, n: int = 100) -> DataFrame:
    """First ``n`` rows in a total order, each carrying the dataset's row count."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return df.orderBy(*order_by).limit(n).withColumn("total_rows", total)


def latest_flat_file(spark: SparkSession, raw_dir: str, name: str) -> str | None:
    """Newest ``<name>_YYYYMMDD_HHMMSS.csv`` in a folder of timestamped files.

    The listing is a Spark file scan that selects only ``path`` (no file
    content is read); the stamp sorts chronologically as text.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", f"{name}_*.csv")
             .load(raw_dir).select("path"))
    stamp = F.regexp_extract("path", rf"{name}_(\d{{8}}_\d{{6}})\.csv$", 1)
    row = files.filter(stamp != "").agg(F.max_by("path", stamp)).first()
    return row[0] if row else None


def read_latest_flat(spark: SparkSession, raw_dir: str, name: str,
                     schema: T.StructType) -> DataFrame:
    """The newest timestamped CSV of ``name`` (the layout a fetch step leaves behind)."""
    path = latest_flat_file(spark, raw_dir, name)
    if path is None:
        raise FileNotFoundError(f"Path does not exist: no {name}_*.csv under {raw_dir}")
    return read_csv(spark, path, schema)
