"""Written tables in the shared checkpoint folder.

Writing an intermediate result and reading it back cuts lineage (a lost
executor costs a re-read, not a recomputation of the whole plan), gives the
planner true file sizes, and makes row counts cheap (Parquet footers), which
is what the broadcast checks in :mod:`courtside.operators.joins` rely on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from courtside.session import scratch_path


@dataclass
class WrittenTable:
    path: str
    df: DataFrame
    _rows: int | None = None

    @property
    def rows(self) -> int:
        """Row count, read from the Parquet footers on first use."""
        if self._rows is None:
            self._rows = self.df.count()
        return self._rows


def write_and_read(df: DataFrame, name: str, partition_by: list[str] | None = None,
                   count: bool = False) -> WrittenTable:
    """Write ``df`` as Parquet under the shared folder and return it read back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    back = spark.read.schema(df.schema).parquet(path).select(*df.columns)
    table = WrittenTable(path, back)
    if count:
        table.rows  # noqa: B018
    return table


def write_bucketed(df: DataFrame, name: str, partition_by: list[str], bucket_by: str, buckets: int,
                   sort_by: str) -> WrittenTable:
    """``df`` written under the shared folder in buckets of ``bucket_by``, as a table of the session's
    catalogue (where Spark keeps the buckets), and read back.

    Rows go to the task of their bucket first, so a folder has one file a bucket.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = "courtside_" + "".join(c if c.isalnum() else "_" for c in path.rsplit("/", 1)[-1])
    (df.repartition(buckets, bucket_by).write.format("parquet").partitionBy(*partition_by)
     .bucketBy(buckets, bucket_by).sortBy(sort_by).option("path", path).saveAsTable(table))
    return WrittenTable(path, spark.table(table).select(*df.columns))


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` written beside ``path`` and put in its place once it is whole; read back.

    A run that dies while it writes leaves the old table as it was; the folders change
    places by renaming, so a reader finds the old or the new one.
    """
    spark = df.sparkSession
    path = path.rstrip("/")
    new, old = f"{path}__new", f"{path}__old"
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(new)
    as_path = spark._jvm.org.apache.hadoop.fs.Path
    store = as_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    store.delete(as_path(old), True)
    if store.exists(as_path(path)) and not store.rename(as_path(path), as_path(old)):
        raise OSError(f"{path} can't be moved aside")
    if not store.rename(as_path(new), as_path(path)):
        store.rename(as_path(old), as_path(path))
        raise OSError(f"{new} can't take the place of {path}")
    store.delete(as_path(old), True)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
