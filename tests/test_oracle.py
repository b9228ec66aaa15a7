"""Every registered query against its DuckDB oracle (sf0.001, full tables)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from courtside.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_listed():
    missing = set(QUERIES) - set(E.oracle_sql())
    assert missing == set()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["team_name", "season", "games_played", "wins", "win_rate",
                          "avg_point_diff"]
    assert df.count() > 0


SQL_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
            "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    d_cols, d_rows = rel.columns, rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    s_types = {f.name: SQL_TYPE.get(f.dataType.simpleString()) for f in df.schema.fields}
    assert s_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
