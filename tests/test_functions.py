import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.functions import bands, dates
from helpers import one_col


def test_outcome_band_edges(spark):
    diffs = [21, 20, 11, 10, 1, 0, -1, -9, -10, -19, -20, -21, None]
    got = [r[0] for r in one_col(spark, diffs).select(bands.outcome_band("x")).collect()]
    assert got == ["Blowout Win", "Comfortable Win", "Comfortable Win", "Close Win", "Close Win",
                   "Tie", "Close Loss", "Close Loss", "Comfortable Loss", "Comfortable Loss",
                   "Blowout Loss", "Blowout Loss", "Blowout Loss"]  # NULL falls to the last label


def test_performance_edges(spark):
    probs = [0.29, 0.30, 0.44, 0.45, 0.55, 0.56, 0.70, 0.71]
    rows = [(w, p) for w in (1, 0) for p in probs]
    df = spark.createDataFrame(rows, "w int, p double")
    got = [r[0] for r in df.select(bands.performance_vs_expectation("w", "p")).collect()]
    assert got[:8] == ["Major Upset", "Minor Upset", "Minor Upset"] + ["Expected Result"] * 5
    assert got[8:] == ["Expected Result"] * 5 + ["Minor Upset Loss", "Minor Upset Loss",
                                                 "Major Upset Loss"]


def test_impact_edges(spark):
    vals = [20.0, -20.0, 20.5, -20.5, 30.0, -30.0, 30.5, -30.5]
    got = [r[0] for r in one_col(spark, vals, dtype=T.DoubleType()).select(
        bands.game_impact("x")).collect()]
    assert got == ["Low Impact"] * 2 + ["Medium Impact"] * 4 + ["High Impact"] * 2


def test_win_flag_tie_and_null(spark):
    df = spark.createDataFrame([(100, 100), (None, 90), (101, 100)], "a int, b int")
    assert [r[0] for r in df.select(bands.win_flag("a", "b")).collect()] == [0, 0, 1]


def test_conference_and_bool_flag(spark):
    df = spark.createDataFrame([("BOS",), ("LAL",), ("XYZ",), (None,)], "t string")
    assert [r[0] for r in df.select(bands.conference_of("t")).collect()] == [
        "Eastern", "Western", "Historical", "Historical"]
    b = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r[0] for r in b.select(bands.bool_flag("b")).collect()] == [1, 0, 0]


def test_season_boundaries(spark):
    ds = [dt.date(2020, 9, 30), dt.date(2020, 10, 1), dt.date(2020, 12, 31), dt.date(2021, 1, 1)]
    got = [r[0] for r in one_col(spark, ds, dtype=T.DateType()).select(
        dates.season_of_date("x")).collect()]
    assert got == [2019, 2020, 2020, 2020]
    r = spark.range(1).select(dates.season_start_date(F.lit(2020)),
                              dates.season_end_date(F.lit(2020))).first()
    assert tuple(r) == (dt.date(2020, 10, 1), dt.date(2021, 6, 30))


def test_days_between_counts_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 2, 1, 0))],
                               "a timestamp, b timestamp")
    assert df.select(dates.days_between("a", "b")).first()[0] == 1


def test_years_before_clamps_leap_day(spark):
    r = spark.range(1).select(dates.years_before(F.lit(dt.date(2024, 2, 29)), 2)).first()[0]
    assert r == dt.date(2022, 2, 28)


def test_is_active(spark):
    df = spark.createDataFrame([(dt.date(2001, 7, 28),), (dt.date(2001, 7, 27),), (None,)],
                               "d date")
    got = [r[0] for r in df.select(bands.is_active("d", dt.date(2003, 7, 28))).collect()]
    assert got == [True, False, False]
