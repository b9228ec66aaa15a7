"""Game -> one row per side, in a single scan.

The reference writes "home perspective UNION ALL away perspective", which
scans and joins the game table twice. Exploding an array of two structs
keeps it to one scan and one pipelined Generate (no shuffle), and it makes
the OR join ``code = home OR code = away`` an equi-join on the side's code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_sides(df: DataFrame, keep: Sequence[str],
                  sides: Mapping[str, Mapping[str, Column]],
                  side_col: str | None = None) -> DataFrame:
    """Return ``keep`` columns plus one struct's fields per side.

    ``sides`` maps a side label (e.g. ``"HOME"``) to ``{output name: Column}``;
    every side must give the same names in the same order. With ``side_col``
    the label is kept as a column.
    """
    labels = list(sides)
    names = list(sides[labels[0]])
    for lab in labels[1:]:
        if list(sides[lab]) != names:
            raise ValueError("every side must define the same columns in the same order")
    structs = []
    for lab in labels:
        fields = [c.alias(n) for n, c in sides[lab].items()]
        if side_col:
            fields.append(F.lit(lab).alias(side_col))
        structs.append(F.struct(*fields))
    return df.select(*[F.col(c) for c in keep], F.inline(F.array(*structs)))


def distinct_codes(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    """``SELECT DISTINCT a UNION SELECT DISTINCT b`` as one scan + explode + distinct.

    The distinct is map-side pre-aggregated, so the shuffle carries at most
    (tasks x distinct codes) rows whatever the input size.
    """
    return (df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(out))
            .filter(F.col(out).isNotNull()).distinct())
