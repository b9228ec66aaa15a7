"""Column checks of the fact taken while it is written (`DataFrame.observe`).

Row counts, nulls of the declared not-null columns, values outside the accepted
ones and scores that contradict the outcome are counts over single rows, so
the write itself can take them: the fact needs no scan of its own for a check that
passes. A check that fails is run again as its query, which names the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from courtside.plans import checks as C

FACT = "fct_games"


def _scores_contradict() -> Column:
    w, d = F.col("win_flag"), F.col("score_diff")
    return ((w == 1) & (d <= 0)) | ((w == 0) & (d >= 0))


def fact_metrics() -> dict[str, Column]:
    """Named counts over the fact's rows."""
    out = {"rows": F.count(F.lit(1)), "scores_match_outcome": F.count_if(_scores_contradict()),
           "earliest": F.min("game_date"), "latest": F.max("game_date")}
    out |= {f"null.{c}": F.count_if(F.col(c).isNull()) for c in C.NOT_NULL[FACT]}
    out |= {f"outside.{c}": F.count_if(~F.col(c).isin(list(values)))
            for model, c, values in C.ACCEPTED if model == FACT}
    return out


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` that reports `fact_metrics` when it is written."""
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in fact_metrics().items()]), seen


def failures(counts: dict) -> dict[str, int]:
    """Violating rows of each check that the counts decide."""
    kind = lambda k: sum(v for name, v in counts.items() if name.startswith(k))
    return {"not_null": kind("null."), "accepted_values": kind("outside."),
            "scores_match_outcome": counts["scores_match_outcome"]}
