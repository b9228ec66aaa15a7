"""Property tests: Spark columns vs plain-Python statements of the same rules."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from courtside.functions import bands, dates
from courtside.operators.running import running_sum

FEW = settings(max_examples=8, deadline=None)


def outcome_py(d):
    if d is None:
        return "Blowout Loss"
    for bound, label in ((20, "Blowout Win"), (10, "Comfortable Win"), (0, "Close Win")):
        if d > bound:
            return label
    if d == 0:
        return "Tie"
    return "Close Loss" if d > -10 else ("Comfortable Loss" if d > -20 else "Blowout Loss")


@FEW
@given(st.lists(st.one_of(st.none(), st.integers(-60, 60)), min_size=1, max_size=40))
def test_outcome_band_matches_rule(spark, diffs):
    df = spark.createDataFrame([(d,) for d in diffs], "d int")
    assert [r[0] for r in df.select(bands.outcome_band("d")).collect()] == \
        [outcome_py(d) for d in diffs]


@FEW
@given(st.lists(st.dates(dt.date(1900, 1, 1), dt.date(2100, 12, 31)), min_size=1, max_size=40))
def test_season_of_date_matches_rule(spark, ds):
    df = spark.createDataFrame([(d,) for d in ds], T.StructType([T.StructField("d", T.DateType())]))
    got = [r[0] for r in df.select(dates.season_of_date("d")).collect()]
    assert got == [d.year if d.month >= 10 else d.year - 1 for d in ds]


@FEW
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(1, 6), st.integers(-50, 50)),
                min_size=1, max_size=60))
def test_running_sum_matches_range_frame(spark, rows):
    data = [(t, dt.date(2001, 1, d), float(v)) for t, d, v in rows]
    df = spark.createDataFrame(data, "t string, d date, v double")
    got = sorted(tuple(r) for r in running_sum(df, ["t"], "d", "v", "c").collect())
    want = sorted((t, d, v, sum(v2 for t2, d2, v2 in data if t2 == t and d2 <= d))
                  for t, d, v in data)
    assert got == want


@FEW
@given(st.lists(st.tuples(st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2030, 1, 1)),
                          st.datetimes(dt.datetime(2000, 1, 1), dt.datetime(2030, 1, 1))),
                min_size=1, max_size=30))
def test_days_between_counts_calendar_days(spark, pairs):
    df = spark.createDataFrame(pairs, "a timestamp, b timestamp")
    got = [r[0] for r in df.select(dates.days_between("a", "b")).collect()]
    assert got == [(b.date() - a.date()).days for a, b in pairs]
