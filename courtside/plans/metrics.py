"""Declared metrics: measure + timestamp + allowed grains, dimensions and filters.

``evaluate(fct, "win_rate", "month")`` is one filter and one group-by; the
measure is the declared expression itself, so declaration and code are one
and it aggregates partially on the map side. Unknown grains, dimensions or filter
operators are rejected before any data is read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.sources.tables import write_and_read


@dataclass(frozen=True)
class MetricFilter:
    field: str
    operator: str
    value: object = None


@dataclass(frozen=True)
class MetricSpec:
    name: str
    label: str
    calculation_method: str          # derived | average | sum
    expression: str                  # as declared: a column or, if derived, aggregates
    timestamp: str
    time_grains: tuple
    dimensions: tuple
    filters: tuple = field(default_factory=tuple)

    def measure(self) -> Column:
        """The measure, from the declared expression; shares in doubles, not decimals."""
        aggregate = {"average": F.avg, "sum": F.sum}.get(self.calculation_method, lambda c: c)
        return aggregate(F.expr(self.expression.replace("100.0", "100.0D")))


# ---- fixed values: the declared metric catalogue -----------------------------
METRICS: dict[str, MetricSpec] = {
    "win_rate": MetricSpec(
        "win_rate", "Win Rate", "derived", "SUM(win_flag) * 100.0 / COUNT(*)",
        "game_date", ("month", "quarter", "year"), ("team_id", "season", "game_location"),
        (MetricFilter("score_for", "is_not_null"),)),
    "avg_point_diff": MetricSpec(
        "avg_point_diff", "Average Point Differential", "average", "score_diff",
        "game_date", ("month", "quarter", "year"),
        ("team_id", "season", "playoff")),
    "elo_change_season": MetricSpec(
        "elo_change_season", "Season ELO Change", "sum", "elo_change",
        "game_date", ("year",), ("team_id", "season")),
    "upset_rate": MetricSpec(
        "upset_rate", "Upset Rate", "derived",
        "SUM(CASE WHEN performance_vs_expectation IN ('Major Upset', 'Minor Upset') "
        "THEN 1 ELSE 0 END) * 100.0 / COUNT(*)",
        "game_date", ("month", "quarter", "year"), ("team_id", "season")),
    "home_advantage": MetricSpec(
        "home_advantage", "Home Court Advantage", "derived",
        "SUM(CASE WHEN game_location = 'HOME' THEN win_flag ELSE 0 END) * 100.0 / "
        "NULLIF(SUM(CASE WHEN game_location = 'HOME' THEN 1 ELSE 0 END), 0) - "
        "SUM(CASE WHEN game_location = 'AWAY' THEN win_flag ELSE 0 END) * 100.0 / "
        "NULLIF(SUM(CASE WHEN game_location = 'AWAY' THEN 1 ELSE 0 END), 0)",
        "game_date", ("year",), ("team_id", "season"),
        (MetricFilter("neutral", "=", 0),)),
}
# ---- end of fixed values -------------------------------------------------------

#: What each measure is merged from: sums and counts of rows, and the measure over them.
PARTS: dict[str, tuple[dict[str, str], str]] = {
    "win_rate": ({"wins": "SUM(win_flag)", "games": "COUNT(*)"}, "{wins} * 100.0 / {games}"),
    "avg_point_diff": ({"total": "SUM(score_diff)", "games": "COUNT(score_diff)"}, "CAST({total} AS DOUBLE) / {games}"),
    "elo_change_season": ({"total": "SUM(elo_change)"}, "{total}"),
    "upset_rate": ({"upsets": "SUM(CASE WHEN performance_vs_expectation IN ('Major Upset', 'Minor Upset') "
                              "THEN 1 ELSE 0 END)", "games": "COUNT(*)"}, "{upsets} * 100.0 / {games}"),
    "home_advantage": (
        {f"{at.lower()}_{part}": f"SUM(CASE WHEN game_location = '{at}' THEN {of} ELSE 0 END)"
         for at in ("HOME", "AWAY") for part, of in (("wins", "win_flag"), ("games", "1"))},
        "{home_wins} * 100.0 / NULLIF({home_games}, 0) - {away_wins} * 100.0 / NULLIF({away_games}, 0)"),
}

_OPERATORS: dict[str, Callable[[Column, object], Column]] = {
    "is_not_null": lambda c, v: c.isNotNull(),
    "is_null": lambda c, v: c.isNull(),
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    "<>": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(list(v)),
}


def filter_predicate(f: MetricFilter) -> Column:
    if f.operator not in _OPERATORS:
        raise ValueError(f"unsupported filter operator {f.operator!r}")
    return _OPERATORS[f.operator](F.col(f.field), f.value)


def _with_neutral(fct: DataFrame) -> DataFrame:
    """A fact without the neutral flag gets it from the location's label."""
    if "neutral" in fct.columns:
        return fct
    return fct.withColumn("neutral", (F.col("adjusted_game_location") == "NEUTRAL").cast("int"))


def evaluate(fct: DataFrame, name: str, grain: str, dimensions: Sequence[str] | None = None,
             extra_filters: Sequence[MetricFilter] = ()) -> DataFrame:
    """Metric ``name`` per ``grain`` period and dimension values.

    Output: period_start (DATE), the dimensions, then a column named after the metric.
    """
    spec = METRICS[name]
    if grain not in spec.time_grains:
        raise ValueError(f"{name}: grain {grain!r} not in {spec.time_grains}")
    dims = list(spec.dimensions if dimensions is None else dimensions)
    unknown = [d for d in dims if d not in spec.dimensions]
    if unknown:
        raise ValueError(f"{name}: dimensions {unknown} not declared")
    df = _with_neutral(fct)
    for f in (*spec.filters, *extra_filters):
        df = df.filter(filter_predicate(f))
    period = F.date_trunc(grain, F.col(spec.timestamp)).cast("date").alias("period_start")
    return df.groupBy(period, *dims).agg(spec.measure().alias(name))


ALL_DIMENSIONS = ("team_id", "season", "game_location", "playoff")


def daily_parts(fct: DataFrame) -> DataFrame:
    """Sums and counts of every metric by day and dimensions: one scan, as few rows as days and teams give."""
    aggregates = []
    for name, (parts, _) in PARTS.items():
        kept = F.lit(True)
        for f in METRICS[name].filters:
            kept = kept & filter_predicate(f)
        flag = f"_{name}"
        fct = _with_neutral(fct).withColumn(flag, kept)
        aggregates.append(F.count_if(F.col(flag)).alias(f"{name}__rows"))
        aggregates += [F.expr(f"{part} FILTER (WHERE {flag})").alias(f"{name}__{p}") for p, part in parts.items()]
    return fct.groupBy(F.col("game_date").cast("date").alias("day"), *ALL_DIMENSIONS).agg(*aggregates)


def evaluate_all(fct: DataFrame) -> DataFrame:
    """(metric, grain, period_start, dimensions, value): all metrics at all their grains.

    Months, quarters and years are merged from the written daily parts; dimensions that a metric lacks are null.
    """
    daily = write_and_read(daily_parts(fct), "metrics/daily").df
    out = None
    for name, (parts, measure) in PARTS.items():
        spec = METRICS[name]
        merged = {p: f"SUM({name}__{p})" for p in parts}
        value = F.expr(measure.format(**merged).replace("100.0", "100.0D")).cast("double")
        for grain in spec.time_grains:
            period = F.date_trunc(grain, "day").cast("date").alias("period_start")
            rows = daily.where(F.col(f"{name}__rows") > 0).groupBy(period, *spec.dimensions).agg(value.alias("value")).select(
                F.lit(name).alias("metric"), F.lit(grain).alias("grain"), "period_start",
                *[F.col(d) if d in spec.dimensions else F.lit(None).cast(daily.schema[d].dataType).alias(d)
                  for d in ALL_DIMENSIONS], "value")
            out = rows if out is None else out.unionByName(rows)
    return out
