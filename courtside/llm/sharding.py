"""Proportional stratified interleaving of documents into shards.

Rows are ranked in a seeded random order within each source; a row's
fractional rank is (rank + 1/2) / rows of its source. Sorted by fractional
rank, every stretch of the order holds the sources in the proportions of the
whole, so cutting it into equal stretches gives shards of the same mixture,
whose row counts differ by at most one.

Both orders are built by :func:`numbered` (a range-partitioned sort plus a
table of partition counts) over a narrow table without texts: a source with a
third of all rows is spread over many tasks, as its rows are split by hash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import numbered, read, same, written

SHARDS, SEED = 8, 17


def stratified_shards(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED,
                      id_col: str = "doc_id", text_col: str = "text", by: str = "source",
                      carry: Sequence[Column] = ()) -> DataFrame:
    """doc_id, size, text_crc32, the stratum, shard and slot for every row, and carried columns.

    Defined cases: a null text has size 1 and the checksum of the empty text;
    null strata form a stratum of their own; null ids and repeated rows are
    rows like any other (rows equal in stratum, id and text are
    interchangeable, so ties have no effect); an empty table gives no rows;
    with fewer rows than shards some shards stay empty. ``slot`` counts from 0
    within a shard, in interleaved order.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = written(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("bigint").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.col(by).alias("_stratum"),
        F.struct(F.lit(0).alias("_"), *carry).alias("_carry"))
        .withColumn("_key", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")), "shard-rows")
    n = max(1, rows.count())
    tie = ["_key", "doc_id", "text_crc32"]
    ranked = numbered(rows, ["_stratum", *tie], "_i", "shard-ranked")
    # written, so that AQE may split the rows of a hot stratum in the join below
    strata = written(ranked.groupBy("_stratum").agg(F.min("_i").alias("_first"),
                                                    F.count(F.lit(1)).alias("_rows")), "shard-strata")
    frac = (2 * (F.col("_i") - F.col("_first")) + 1) / (2 * F.col("_rows"))
    mixed = (ranked.join(strata, same(ranked, strata, ["_stratum"]))
             .select(ranked["*"], frac.alias("_frac")))
    placed = numbered(mixed, ["_frac", "_stratum", *tie], "_j", "shard-mixed")
    # shard s takes the places from ceil(s * n / n_shards) on
    cut = placed.withColumn("_shard", F.expr(f"(_j * {n_shards}L) div {n}L"))
    return cut.select(
        "doc_id", "size", "text_crc32", F.col("_stratum").alias("stratum"),
        F.col("_shard").cast("int").alias("shard"),
        F.expr(f"_j - (_shard * {n}L + {n_shards - 1}L) div {n_shards}L").alias("slot"),
        *[F.col("_carry").getField(f.name).alias(f.name)
          for f in placed.schema["_carry"].dataType.fields if f.name != "_"])


def write_shards(assigned: DataFrame, path: str) -> None:
    """One folder a shard; rows keep their slot order within each file."""
    (assigned.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    out = stratified_shards(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      F.col("slot").cast("bigint").alias("slot"),
                      F.lit(None).cast("int").alias("grown_shard"),
                      F.col("stratum").alias("source"))
