from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(x) -> Column:
    """Accept a Column, a column name, or a Python date/number literal."""
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    if isinstance(x, (_dt.date, _dt.datetime, int, float)):
        return F.lit(x)
    raise TypeError(f"cannot make a Column from {x!r}")
