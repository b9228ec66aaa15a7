"""Season and day helpers (the reference's four date macros) as Column functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from courtside.functions.util import col_of


def season_of_date(d) -> Column:
    """Season year of a date: October or later belongs to that year, else the year before."""
    d = col_of(d)
    return F.when(F.month(d) >= 10, F.year(d)).otherwise(F.year(d) - 1).cast("int")


def season_start_date(season) -> Column:
    """October 1st of the season year."""
    return F.make_date(col_of(season), F.lit(10), F.lit(1))


def season_end_date(season) -> Column:
    """June 30th of the year after the season year."""
    return F.make_date(col_of(season) + 1, F.lit(6), F.lit(30))


def days_between(start, end) -> Column:
    """Number of day boundaries crossed from ``start`` to ``end`` (23:00 -> 01:00 is 1)."""
    return F.datediff(F.to_date(col_of(end)), F.to_date(col_of(start))).cast("bigint")


def years_before(as_of, years: int) -> Column:
    """``as_of - INTERVAL 'n years'`` as a DATE (Feb 29 clamps to Feb 28)."""
    return F.add_months(F.to_date(col_of(as_of)), -12 * years)


def years_before_day(day: dt.date, years: int) -> dt.date:
    """:func:`years_before` of a known day."""
    first = day.replace(year=day.year - years, day=1)
    return next(first.replace(day=d) for d in range(day.day, 0, -1) if _is_day(first, d))


def _is_day(month: dt.date, day: int) -> bool:
    try:
        month.replace(day=day)
    except ValueError:
        return False
    return True


def game_id_date_part(d) -> Column:
    """``REPLACE(CAST(date AS VARCHAR), '-', '')`` - the date part of a staged game id."""
    return F.replace(col_of(d).cast("string"), F.lit("-"), F.lit(""))
