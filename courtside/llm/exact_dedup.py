"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each step looks closer at fewer rows. Byte lengths are grouped first; rows
whose length is shared are grouped by (length, hash of the first
``PREFIX_CHARS`` characters); only rows whose pair is shared too get the
SHA-256 of their whole text. Folding A-Z never changes a text's byte length,
so the length needs no folding.

All groupings combine map-side to one row a key, and rows meet their
group's row in a join whose group side has one row a key, so a group of any
size is split by AQE's skew join. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import fold, read, written

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    return fold(F.coalesce(text, F.lit("")))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                carry: Sequence[Column] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, and the carried columns.

    Texts are equal when identical after lower-casing A-Z only. Of equal texts
    the row with the largest id stays. Defined cases: a null text counts as
    empty, and empty texts are equal to each other; a null id is smaller than
    any other (keep_id is null if all of a group's ids are); of repeated rows
    with the same id and equal texts exactly one is kept; an empty table gives
    no rows; other columns of ``docs`` are not read unless carried.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.struct(F.lit(0).alias("_"), *carry).alias("_carry"),
        text.alias("_text"), F.octet_length(text).alias("_len"),
        # length and prefix in one key: grouping by it needs rows dealt anew after the join
        # on the length, so AQE may split a length that very many rows share
        F.xxhash64(F.octet_length(text), fold(F.left(text, F.lit(PREFIX_CHARS)))).alias("_start"))
    # each group table is written: AQE splits a hot key only if a join reads both sides from
    # a shuffle, not from an aggregate
    lengths = written(rows.groupBy("_len").count().where("count > 1").select("_len"),
                      "exact-lengths")
    starts = written(rows.select("_len", "_start").join(lengths, "_len", "left_semi")
                     .groupBy("_start").count().where("count > 1")
                     .select("_start", F.lit(True).alias("_shared")), "exact-starts")
    hashed = written(
        rows.join(starts, "_start", "left").select(
            "doc_id", "_carry",
            F.when(F.col("_shared"), F.sha2(fold(F.col("_text")), 256)).alias("_full"),
            F.monotonically_increasing_id().alias("_row")), "exact-hashed")
    groups = written(hashed.where(F.col("_full").isNotNull()).groupBy("_full")
                     .agg(F.max(F.struct("doc_id", "_row")).alias("_keep"),
                          F.count(F.lit(1)).alias("_n"))
                     .where("_n > 1"), "exact-groups")
    shared = hashed.where(F.col("_full").isNotNull()).join(groups, "_full", "left")
    alone = hashed.where(F.col("_full").isNull()).select(
        "*", F.lit(None).cast(groups.schema["_keep"].dataType).alias("_keep"),
        F.lit(None).cast("bigint").alias("_n"))
    return shared.unionByName(alone).select(
        "doc_id",
        F.when(F.col("_keep").isNull(), F.col("doc_id")).otherwise(F.col("_keep.doc_id"))
        .alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("_keep._row") == F.col("_row"), F.lit(True)).alias("kept"),
        *[F.col("_carry").getField(f.name).alias(f.name)
          for f in hashed.schema["_carry"].dataType.fields if f.name != "_"])


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return exact_dedup(docs, carry=[F.sha2(normalised(F.col("text")), 256).alias("text_sha256")])


def exact_dedup_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept rows of ``docs``, with all their columns."""
    out = exact_dedup(docs, carry=[F.struct(*[docs[c] for c in docs.columns]).alias("_doc")])
    return out.where("kept").select("_doc.*")


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = f"""
WITH d AS (SELECT doc_id, {LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)
"""
