"""What the corpus operators share: text folding, word splitting, written tables, global order."""

from __future__ import annotations

import string
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtside.session import scratch_path
from courtside.sources.tables import write_and_read

#: Broadcast at most this many bytes of a lookup; larger lookups go in blocks or by shuffle.
BROADCAST_BYTES = 32 << 20
#: Rows go to Python in Arrow batches of about this many bytes.
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def fold(text: Column) -> Column:
    """``text`` with A-Z (and nothing else) in lower case.

    A text of ASCII characters only goes through the fast byte-wise ``lower``;
    others, where ``lower`` would also change letters beyond A-Z, through ``translate``.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below spark.checkpoint.dir and read back (cuts lineage, fixes row ids)."""
    return write_and_read(df, f"llm/{name}").df


def written_alone(df: DataFrame, name: str) -> DataFrame:
    """`written`, whose shuffle files go once the table is there."""
    spark, key = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        return written(df, name)
    finally:
        spark.conf.set(key, before)


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             schema: str) -> DataFrame:
    """``df.mapInArrow(run, schema)``, its rows handed over in batches of about ``BATCH_BYTES``.

    Spark fills a batch up to 64 MB or 10,000 rows, and each task has it several times over:
    in the executor's buffers, as they grow, and in Python, beside the next one. The session's
    bound is read when the rows are computed, long after this returns, so it stays lowered.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(key, BATCH_BYTES)
    return df.mapInArrow(run, schema)


def keys_to_join(keys: DataFrame) -> DataFrame:
    """``keys`` (a written table of a few numbers a row), to be broadcast if it is small."""
    return F.broadcast(keys) if keys.count() * 32 <= BROADCAST_BYTES else keys


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir for files that tasks write themselves."""
    return scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex[:6]}")


def numbered(df: DataFrame, order: list[str], out: str, name: str,
             partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out``: each row's place (from 0) in the order of ``order``, in parallel.

    Rows are range-partitioned and sorted, then written, so the layout is
    fixed on any retry. A row's place is its place within its partition
    plus the rows of the partitions before: a table of one row a partition.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part, row = f"{out}__part", f"{out}__row"
    ranged = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn(row, F.monotonically_increasing_id())
              .withColumn(part, F.shiftright(row, 33))
              .withColumn(row, F.col(row).bitwiseAND(F.lit((1 << 33) - 1))))
    fixed = written(ranged, name)
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = fixed.groupBy(part).count().select(
        part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(f"{out}__start"))
    # one row a partition, at most n of them: a bounded broadcast
    return (fixed.join(F.broadcast(starts), part)
            .withColumn(out, F.col(row) + F.col(f"{out}__start"))
            .drop(part, row, f"{out}__start"))


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of ``keys``."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond
