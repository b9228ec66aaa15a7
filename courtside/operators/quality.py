"""Generic data-quality operators: each returns the rows that violate a rule.

An empty result means the check passed. Column checks run as one
aggregation pass per table, however many columns are checked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.operators.joins import lookup_join
from courtside.sources.tables import write_and_read


def null_counts(df: DataFrame, columns: Sequence[str], model: str) -> DataFrame:
    """One row per column: (model, column_name, row_count, null_count), in one pass."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(columns)]
    one = df.agg(*aggs)
    per_col = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                 F.col(f"__n{i}").alias("null_count"))
                        for i, c in enumerate(columns)])
    return one.select(F.lit(model).alias("model"), F.col("__rows").alias("row_count"),
                      F.inline(per_col)).select("model", "column_name", "row_count",
                                                "null_count")


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``columns``."""
    cond = None
    for c in columns:
        cond = F.col(c).isNull() if cond is None else (cond | F.col(c).isNull())
    return df.filter(cond)


def duplicate_keys(df: DataFrame, keys: Sequence[str] | str, count_col: str = "n_records") -> DataFrame:
    """Non-null key values that occur more than once, with their counts."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    nonnull = df
    for k in keys:
        nonnull = nonnull.filter(F.col(k).isNotNull())
    return (nonnull.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def duplicate_text_keys(df: DataFrame, key: str, count_col: str = "n_records",
                        digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """:func:`duplicate_keys` of a long text key, by refinement.

    Rows are counted by an 8-byte hash of the key first, so that is all the
    shuffle carries. Only rows whose hash occurs twice (repeated keys and colliding
    ones) are counted by the key itself; these hashes are written, so the planner knows
    how few they are.
    """
    keyed = df.filter(F.col(key).isNotNull()).select(F.col(key), digest(F.col(key)).alias("__hash"))
    twice = write_and_read(keyed.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
                           .select("__hash"), "quality/hashes").df
    return duplicate_keys(keyed.join(twice, "__hash", "left_semi"), key, count_col)


def accepted_values(df: DataFrame, column: str, accepted: Iterable, model: str) -> DataFrame:
    """Value profile of one column: (model, column_name, value, row_count, is_accepted)."""
    return accepted_values_many(df, [(column, accepted)], model)


def accepted_values_many(df: DataFrame, specs: Sequence[tuple], model: str) -> DataFrame:
    """Value profiles of several columns of one table in a single pass.

    Each row becomes one (column, value, accepted) triple per checked column
    and the triples are counted (combined map-side), so the table is scanned
    once however many columns are checked. Violations are the rows with
    ``is_accepted = false``; a NULL value is neither accepted nor rejected
    (``is_accepted`` is NULL), as in SQL.
    """
    triples = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                 F.col(c).cast("string").alias("value"),
                                 F.col(c).isin(list(acc)).alias("is_accepted"))
                        for c, acc in specs])
    return (df.select(F.inline(triples))
            .groupBy("column_name", "value", "is_accepted").agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(model).alias("model"), "column_name", "value", "row_count",
                    "is_accepted"))


def _parent_keys(parent: DataFrame, parent_col: str) -> DataFrame:
    return parent.select(F.col(parent_col).alias("__key")).filter(
        F.col("__key").isNotNull()).distinct()


def relationship_orphans(child: DataFrame, column: str, parent: DataFrame, parent_col: str,
                         parent_rows: int | None = None) -> DataFrame:
    """Child rows whose non-null ``column`` has no match in the parent."""
    keys = _parent_keys(parent, parent_col)
    c = child.filter(F.col(column).isNotNull())
    return lookup_join(c, keys, c[column] == keys["__key"], "left_anti",
                       small_rows=parent_rows)


def relationship_summary(child: DataFrame, column: str, parent: DataFrame, parent_col: str,
                         model: str, parent_rows: int | None = None) -> DataFrame:
    """One row: (model, column_name, checked_rows, orphan_rows) in a single pass."""
    keys = _parent_keys(parent, parent_col).withColumn("__hit", F.lit(True))
    c = child.select(column).filter(F.col(column).isNotNull())
    j = lookup_join(c, keys, c[column] == keys["__key"], "left", small_rows=parent_rows)
    return j.agg(F.count(F.lit(1)).alias("checked_rows"),
                 F.count_if(F.col("__hit").isNull()).alias("orphan_rows")).select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), "checked_rows",
        "orphan_rows")


def min_rows(tables: dict[str, DataFrame], minimum: int) -> DataFrame:
    """(table_name, row_count, min_rows, passed) per table."""
    parts = [t.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(n).alias("table_name"), "row_count") for n, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "row_count", F.lit(minimum).cast("bigint").alias("min_rows"),
                      (F.col("row_count") >= minimum).alias("passed"))


def missing_columns(df: DataFrame, expected: Iterable[str]) -> list[str]:
    """Expected column names absent from ``df`` (a schema check, no data read)."""
    have = set(df.columns)
    return [c for c in expected if c not in have]


def primary_key_profile(df: DataFrame, key: str) -> DataFrame:
    """One row: (row_count, null_keys, duplicate_keys) for a declared key column."""
    per = df.groupBy(F.col(key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    return per.agg(
        F.sum("__n").cast("bigint").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("__k").isNull(), F.col("__n"))), F.lit(0))
        .cast("bigint").alias("null_keys"),
        F.count_if(F.col("__k").isNotNull() & (F.col("__n") > 1)).alias("duplicate_keys"))


class QualityError(RuntimeError):
    """Raised by :func:`assert_empty` when a check finds violations."""


def assert_empty(name: str, violations: DataFrame) -> None:
    """Fail like a failing test: raise with a few example rows if any exist."""
    sample = violations.take(5)
    if sample:
        raise QualityError(f"quality check {name} failed, e.g. {sample}")
