"""The whole batch: latest raw snapshots -> raw tables -> marts -> checks -> exports.

One session, lazy DataFrames between stages, and a write at each layer
(raw, marts, exports) so every later stage reads committed files - a lost
executor costs a re-read, never a rebuild from the landing data.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside import schemas
from courtside.operators import quality as Q
from courtside.plans import checks as C
from courtside.plans import exports, models, observed
from courtside.plans.warehouse import dated
from courtside.sources import api_pages, snapshots
from courtside.sources.csv_tables import optional, read_aliases
from courtside.sources.fixture import DEFAULT_PARAMS, FixtureParams, alias_frame
from courtside.sources.tables import replace_table
from courtside.streaming import landing, state

log = logging.getLogger(__name__)

RAW_INPUTS = {"teams": schemas.RAW_TEAMS, "games": schemas.RAW_GAMES,
              "player_stats": schemas.RAW_PLAYER_STATS}
# Declared primary keys: a load with a NULL or repeated key aborts.
PRIMARY_KEYS = {"teams": "team_id", "games": "game_id"}
# Columns a load must have (a reader of another layout may give fewer).
EXPECTED_COLUMNS = {name: schema.fieldNames() for name, schema in RAW_INPUTS.items()}


def enforce_primary_key(df: DataFrame, key: str, table: str) -> None:
    p = Q.primary_key_profile(df, key).first()
    if p.null_keys or p.duplicate_keys:
        raise Q.QualityError(f"{table}: primary key {key} has {p.null_keys} NULL and "
                             f"{p.duplicate_keys} repeated values; load aborted")


@dataclass
class PipelineResult:
    paths: dict = field(default_factory=dict)
    row_counts: dict = field(default_factory=dict)
    checks: dict = field(default_factory=dict)
    exports: dict = field(default_factory=dict)
    profile: dict = field(default_factory=dict)         # of the load
    rejected: dict = field(default_factory=dict)        # landed pages set aside, by input
    failed_exports: dict = field(default_factory=dict)  # what stopped an export, by name


def _read_pages(spark: SparkSession, landing_dir: str, name: str, schema) -> DataFrame:
    """Landed pages; of a game, team or player season that landed more than once the latest page counts."""
    if name == "games":
        return landing.landed_games(spark, f"{landing_dir.rstrip('/')}/{name}")
    return state.landed(spark, landing_dir, name)


def _read_table(spark: SparkSession, landing_dir: str, name: str, schema) -> DataFrame:
    """The tables that the page stream ingested; teams and players come as snapshots."""
    if name == "games":
        return landing.read_ingested(spark, f"{landing_dir.rstrip('/')}/{name}")
    return snapshots.read_latest(spark, landing_dir, name, schema)


def _read_state(spark: SparkSession, landing_dir: str, name: str, schema) -> DataFrame:
    """The keyed tables that streams of all three inputs keep."""
    path = f"{landing_dir.rstrip('/')}/{name}"
    df = state.current(spark, path, name)
    if not df.inputFiles():
        raise FileNotFoundError(f"Path does not exist: no keyed table at {path}")
    return df


def load_profile(games: DataFrame, teams: DataFrame | None) -> dict:
    """Completed games without a score, the range and number of dates, and the teams."""
    day = F.to_date("date")
    no_score = F.col("home_team_score").isNull() | F.col("visitor_team_score").isNull()
    row = games.agg(F.count(F.lit(1)).alias("games"),
                    F.count_if(no_score & (F.col("status") == "Final")).alias("null_scores"),
                    F.min(day).alias("earliest"), F.max(day).alias("latest"),
                    F.countDistinct(day).alias("unique_dates")).first().asDict()
    return row | {"teams": teams.count() if teams is not None else None}


def run_pipeline(spark: SparkSession, landing_dir: str, out_dir: str,
                 params: FixtureParams = DEFAULT_PARAMS, aliases_path: str | None = None,
                 fail_on: tuple | str = "all", stamp: str | None = None,
                 enforce_keys: bool = True, layout: str = "snapshots",
                 min_rows: int = C.MIN_ROW_COUNT) -> PipelineResult:
    """Run every stage; a failing check named in ``fail_on`` (default: every
    check) aborts the run before export, as a failing data test stops the
    reference's export; ``fail_on=()`` reports only.

    ``landing_dir`` holds CSV snapshots (``games``, ``teams``,
    ``player_stats``): ``layout="snapshots"`` for snapshot folders with a
    latest pointer, ``layout="flat"`` for timestamped ``<name>_<stamp>.csv``
    files, ``layout="pages"`` for landed API JSON pages in ``<name>/``
    folders, ``layout="table"`` for a ``games`` table that the page stream
    ingested, ``layout="state"`` for keyed tables of all inputs. A missing input is skipped with a warning. The result's
    ``profile`` describes the load; tables below ``min_rows`` rows are reported.
    """
    out = out_dir.rstrip("/")
    res = PipelineResult()
    stamp = stamp or snapshots.snapshot_stamp()

    # raw layer (full refresh)
    raw = {}
    reader = {"snapshots": snapshots.read_latest, "flat": snapshots.read_latest_flat,
              "pages": _read_pages, "table": _read_table, "state": _read_state}[layout]
    for name, schema in RAW_INPUTS.items():
        df = optional(reader, spark, landing_dir, name, schema, what=name)
        if df is None:
            continue
        absent = Q.missing_columns(df, EXPECTED_COLUMNS[name])
        if absent:
            raise Q.QualityError(f"{name}: expected columns {absent} are missing; load aborted")
        if enforce_keys and name in PRIMARY_KEYS:
            enforce_primary_key(df, PRIMARY_KEYS[name], name)
        raw[name] = replace_table(df, f"{out}/raw/{name}")
        res.paths[f"raw/{name}"] = f"{out}/raw/{name}"
    if layout == "pages" and "player_stats" in raw:
        pages = api_pages.read_pages(spark, f"{landing_dir.rstrip('/')}/player_stats",
                                     schemas.PLAYER_STATS_PAGE, mode="PERMISSIVE")
        bad = replace_table(api_pages.rejected_pages(pages), f"{out}/quarantine/player_stats")
        res.rejected["player_stats"] = bad.count()
        if res.rejected["player_stats"]:
            log.warning("%d player pages are no valid pages: see %s/quarantine/player_stats",
                        res.rejected["player_stats"], out)
    if "games" not in raw:
        log.warning("no games snapshot: nothing to model")
        return res
    res.profile = load_profile(raw["games"], raw.get("teams"))
    log.info("load: %s", res.profile)
    if res.profile["null_scores"]:
        log.warning("%d completed games without scores", res.profile["null_scores"])
    elo = replace_table(models.raw_elo(raw["games"]), f"{out}/raw/elo")

    # staging (views) and marts (tables)
    aliases = (read_aliases(spark, aliases_path) if aliases_path else
               alias_frame(spark, params))
    alias_rows = aliases.count()
    resolved = models.resolve_aliases(aliases)
    stg_games = models.stg_games(elo)
    summary = models.side_summary(stg_games)
    stg_teams = models.stg_teams(summary, resolved, alias_rows, params.activity_as_of)
    now = F.current_timestamp().alias("last_updated")
    dim = replace_table(models.dim_teams(summary, resolved, alias_rows, params.activity_as_of,
                                      params.eastern, params.western)
                     .select("*", now), f"{out}/marts/dim_teams")
    facts, seen = observed.observed(models.fct_games(stg_games, resolved, alias_rows, extra=("neutral",))
                                    .select("*", now).transform(dated, "game_date", "season"))
    fct = replace_table(facts, f"{out}/marts/fct_games", partition_by=["season"])
    dim_rows = dim.count()
    counts = seen.get  # taken by the write
    res.row_counts.update(dim_teams=dim_rows, fct_games=counts["rows"])
    sound = {name for name, n in observed.failures(counts).items() if not n}
    scanned = lambda check: {} if check in sound else {"fct_games": fct}

    # tests between marts and exports; the three per-game rules share one
    # aggregate of the fact, written once
    per_game = replace_table(C.per_game_summary(fct), f"{out}/checks/per_game")
    found = {
        "not_null": C.not_null_report({"stg_games": stg_games, "stg_teams": stg_teams,
                                       "dim_teams": dim} | scanned("not_null"))
        .filter(F.col("null_count") > 0),
        "unique_game_id": Q.duplicate_keys(stg_games, "game_id"),
        "unique_team_id_dim": Q.duplicate_keys(dim, "team_id"),
        "unique_game_team_id": Q.duplicate_text_keys(fct, "game_team_id"),
        "accepted_values": C.accepted_values_report({"dim_teams": dim} | scanned("accepted_values"))
        .filter(~F.col("is_accepted")),
        "relationships_team": Q.relationship_orphans(fct, "team_id", dim, "team_id", dim_rows),
        "relationships_opponent": Q.relationship_orphans(fct, "opponent_id", dim, "team_id",
                                                         dim_rows),
        "games_have_two_teams": C.two_teams_violations(per_game),
        "elo_changes_sum_to_zero": C.zero_sum_violations(per_game),
        "one_winner_per_game": C.one_winner_violations(per_game),
        "scores_match_outcome": (spark.createDataFrame([], fct.schema) if "scores_match_outcome" in sound
                                 else C.scores_match_outcome(fct)),
    }
    for name, violations in found.items():
        n = violations.count()
        res.checks[name] = n
        if n and (fail_on == "all" or name in fail_on):
            Q.assert_empty(name, violations)
    # informational: seed codes listed more than once (resolved to one row each)
    # informational: codes that share an id (dim_teams has one row an id), small tables
    res.checks["unique_team_id_stg (report only)"] = Q.duplicate_keys(stg_teams, "team_id").count()
    res.checks["min_rows (report only)"] = sum(
        n < min_rows for n in (res.profile["games"], res.row_counts["fct_games"]))
    res.checks["alias_duplicates (report only)"] = models.alias_duplicates(aliases).count()

    # exports: timestamped CSV + latest pointer, then the summary
    export_dir = f"{out}/exports"
    reports = {
        "team_win_rates": lambda: exports.team_win_rates(fct, dim, dim_rows),
        "elo_trends": lambda: exports.elo_trends(fct, dim, params.as_of, dim_rows, dates=exports.season_dates(fct)),
        "point_diff_by_season": lambda: exports.point_diff_by_season(fct, dim, dim_rows),
    }
    for name, make in reports.items():
        try:
            df = make()
            snapshots.write_snapshot(df, export_dir, name, stamp)
            res.exports[name] = snapshots.read_latest(spark, export_dir, name, df.schema).count()
        except Exception as e:  # noqa: BLE001  (one failing export is reported; the others go on)
            log.error("export %s failed: %s", name, e)
            res.failed_exports[name] = str(e)
    summary = {
        "export_timestamp": dt.datetime.now(dt.timezone.utc).isoformat(),
        "warehouse_type": "Spark",
        "database_path": out,
        "exports": [{"table": t, "row_count": n} for t, n in res.row_counts.items()],
    }
    # a JSON array of records, as a table of one record
    (spark.range(0, 1, 1, 1).select(F.lit(json.dumps([summary])).alias("value"))
     .write.mode("overwrite").text(f"{export_dir}/export_summary"))
    res.paths["exports"] = export_dir
    return res


def load_marts(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame, int]:
    """The marts a pipeline run wrote: (fct_games, dim_teams, dim row count)."""
    out = out_dir.rstrip("/")
    fct = spark.read.parquet(f"{out}/marts/fct_games")
    dim = spark.read.parquet(f"{out}/marts/dim_teams")
    return fct, dim, dim.count()


def report(spark: SparkSession, out_dir: str, name: str, as_of=None, grain: str | None = None,
           params: FixtureParams = DEFAULT_PARAMS, teams: Sequence[str] | None = None,
           seasons: Sequence[int] | None = None, conference: str = "All") -> DataFrame:
    """A named report over a pipeline's marts: an export, a dashboard aggregate or a metric.

    Teams (by name), seasons and a conference restrict every report alike; an empty or
    missing list keeps all.
    """
    from courtside.plans import dashboard as D
    from courtside.plans import metrics as M
    fct, dim, n = load_marts(spark, out_dir)
    dim = D.in_list(dim if conference == "All" else dim.filter(F.col("conference") == conference), "team_name", teams)
    fct = D.in_list(fct, "season", seasons)
    if teams or conference != "All":
        fct = fct.join(dim.select("team_id"), "team_id", "left_semi")
    games = lambda: D.games_filtered(fct, dim, n)
    rates = lambda: D.win_rates(games())
    named = {
        "team_win_rates": lambda: exports.team_win_rates(fct, dim, n),
        "elo_trends": lambda: exports.elo_trends(fct, dim, as_of or params.as_of, n),
        "point_diff_by_season": lambda: exports.point_diff_by_season(fct, dim, n),
        "teams_by_conference": lambda: D.teams_by_conference(dim),
        "conference_list": lambda: D.conference_list(dim),
        "default_teams": lambda: D.default_teams(dim),
        "season_list": lambda: D.season_list(games()),
        "games": lambda: games().orderBy(F.desc_nulls_last("game_date"), "team_name"),
        "win_rates": rates,
        "best_season": lambda: D.best_season(rates()),
        "summary": lambda: D.rates_summary(rates()),
        "rating_series": lambda: D.rating_series(
            D.games_filtered(fct, dim, n, extra=(D.ROW_KEY,)), fct.count()),
        "season_rating_change": lambda: D.season_rating_change(games()),
        "season_rating_pivot": lambda: D.season_rating_pivot(
            D.season_rating_change(games()), sorted(s for s, _ in exports.season_dates(fct) if s is not None)),
        "location_stats": lambda: D.location_stats(games()),
        "point_diff_stats": lambda: D.point_diff_stats(games()),
        "box_stats": lambda: D.box_stats(games()),
        "home_advantage": lambda: D.home_advantage_pivot(D.location_stats(games())),
    }
    if name in named:
        return named[name]()
    if name in M.METRICS:
        return M.evaluate(fct, name, grain or M.METRICS[name].time_grains[0])
    raise KeyError(f"unknown report {name!r}; known: {sorted(named) + sorted(M.METRICS)}")
