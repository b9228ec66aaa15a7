"""Wires sources to models and holds the written tables of one input folder.

Three things are written once per session to the shared checkpoint folder
and read back: the loaded game rows (the orders-customer join, the only
full shuffle of the input, runs once; ``raw.games`` and ``raw.elo`` are
projections of it), the resolved alias seed, and the two marts
(``dim_teams``, ``fct_games`` partitioned by season and bucketed by game), which are tables as in
the reference. Staging models stay lazy (views). Reports therefore read
Parquet with pushdown and pruning instead of re-deriving the marts, a lost
executor costs a re-read rather than a rebuild, and the dimension's row
count - needed before broadcasting it - is a footer read.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.plans import exports, models
from courtside.session import app_id
from courtside.sources import fixture
from courtside.sources.fixture import DEFAULT_PARAMS, FixtureParams
from courtside.sources.tables import WrittenTable, write_and_read, write_bucketed

RATED, PLACEHOLDER = "rated", "placeholder"
LOAD_YEAR = "load_year"  # partitions the loaded games by the year of their date


#: Bytes of orders for each bucket of the fact (a bucket is a task of the per-game rules, and
#: each season folder has a file a bucket).
BUCKET_BYTES = 4 << 30
LEAST_BUCKETS = 4


def dated(df: DataFrame, day: str, *by: str) -> DataFrame:
    """``df`` as it is written: days in order, so that the statistics of row groups and pages
    prune a date window. With ``by``, a file also holds few months of a value of ``by`` (AQE
    sizes the files); without, rows stay where they are and nothing is shuffled."""
    if by:
        df = df.withColumn("_month", F.trunc(day, "month")).hint("rebalance", *by, "_month")
    return df.sortWithinPartitions(*by, day).drop("_month")


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, profile: str = RATED,
                 params: FixtureParams = DEFAULT_PARAMS):
        if profile not in (RATED, PLACEHOLDER):
            raise ValueError(f"unknown rating profile {profile!r}")
        self.spark, self.sf_dir, self.profile, self.params = spark, sf_dir, profile, params
        self._written: dict[str, WrittenTable] = {}
        self._alias_rows: int | None = None
        self._lock = threading.RLock()

    # ---- sources ------------------------------------------------------------
    def source(self, name: str) -> DataFrame:
        return fixture.read_table(self.spark, self.sf_dir, name)

    def landed_games(self) -> DataFrame:
        """The joined game rows, loaded once (full refresh) and read as a table.

        Both raw tables are projections of it, so the orders-customer join -
        the only full shuffle of the input - runs once per load.
        """
        return self.table("landed_games")

    def raw_games(self, start=None, end=None) -> DataFrame:
        """``raw.games`` over the loaded rows; of a window of dates, only its years' folders."""
        landed = self.landed_games()
        if start is not None:
            landed = landed.filter(F.col(LOAD_YEAR).between(start.year, end.year))
        games = fixture.raw_games_from(landed)
        return games if start is None else games.filter(F.col("date").between(F.lit(start), F.lit(end)))

    def raw_elo(self) -> DataFrame:
        """``raw.elo`` for this warehouse's rating profile."""
        return self.derive_raw_elo()

    def derive_raw_elo(self) -> DataFrame:
        """The ``raw.elo`` derivation (lazy, no join)."""
        if self.profile == RATED:
            return fixture.rated_elo_from(self.landed_games())
        return models.raw_elo(self.raw_games())

    def aliases(self) -> DataFrame:
        return fixture.alias_frame(self.spark, self.params)

    def resolved_aliases(self) -> DataFrame:
        """One alias row per code, resolved once and read as a (tiny) table."""
        return self.table("aliases")

    @property
    def alias_rows(self) -> int:
        # Resolving never adds rows, so the seed's size bounds the lookup's.
        if self._alias_rows is None:
            self._alias_rows = self.aliases().count()
        return self._alias_rows

    # ---- models (lazy) --------------------------------------------------------
    def stg_games(self) -> DataFrame:
        return models.stg_games(self.raw_elo())

    def side_summary(self) -> DataFrame:
        return models.side_summary(self.stg_games())

    def stg_teams(self) -> DataFrame:
        return models.stg_teams(self.side_summary(), self.resolved_aliases(), self.alias_rows,
                                self.params.activity_as_of)

    def team_activity(self) -> DataFrame:
        return models.team_activity(self.side_summary(), self.resolved_aliases(),
                                    self.alias_rows)

    def team_performance(self) -> DataFrame:
        return models.team_performance(self.side_summary(), self.resolved_aliases(),
                                       self.alias_rows)

    def dim_teams(self) -> DataFrame:
        return models.dim_teams(self.side_summary(), self.resolved_aliases(), self.alias_rows,
                                self.params.activity_as_of, self.params.eastern,
                                self.params.western)

    def dim_teams_as_written(self) -> DataFrame:
        return models.dim_teams_as_written(self.stg_teams(), self.team_performance(),
                                           self.params.eastern, self.params.western)

    def fct_games(self) -> DataFrame:
        return models.fct_games(self.stg_games(), self.resolved_aliases(), self.alias_rows)

    def season_dates(self) -> list[tuple]:
        """(season, last date) of the written fact's partitions."""
        return self.once("season_dates", lambda: exports.season_dates(self.table("fct_games")))

    # ---- tables (written once per session) ---------------------------------------
    def _write(self, name: str) -> WrittenTable:
        with self._lock:
            if name not in self._written:
                if name == "landed_games" and self.profile != RATED:
                    # one raw load per input folder, whatever the rating profile
                    self._written[name] = warehouse_for(self.spark, self.sf_dir)._write(name)
                elif name == "landed_games":
                    self._written[name] = write_and_read(
                        dated(fixture.base_games(self.spark, self.sf_dir).withColumn(
                            LOAD_YEAR, F.year("o_orderdate")), "o_orderdate", LOAD_YEAR),
                        f"raw/{name}", partition_by=[LOAD_YEAR])
                elif name == "aliases":
                    self._written[name] = write_and_read(
                        models.resolve_aliases(self.aliases()).coalesce(1), "seeds/aliases")
                elif name == "fct_games":
                    # a folder a season, in it a file a bucket of games with its days in
                    # order: a season filter prunes folders, a date window row groups, and
                    # whatever groups by game needs no exchange
                    facts = models.fct_games(self.stg_games(), self.resolved_aliases(), self.alias_rows,
                                             extra=("neutral",))
                    self._written[name] = write_bucketed(
                        facts, f"marts/{name}", ["season"], "game_id", self._buckets(), "game_date")
                elif name == "dim_teams":
                    self._written[name] = write_and_read(self.dim_teams(), f"marts/{name}")
                else:
                    raise KeyError(name)
            return self._written[name]

    def _buckets(self) -> int:
        size = sum(n for path, n, _ in input_listing(self.spark, self.sf_dir) if "/orders.parquet" in path)
        return max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))

    def table(self, name: str) -> DataFrame:
        return self._write(name).df

    def rows(self, name: str) -> int:
        return self._write(name).rows

    def once(self, key: str, make):
        """Run ``make()`` once per warehouse (written landing data, exports)."""
        with self._lock:
            if not hasattr(self, "_once"):
                self._once = {}
            if key not in self._once:
                self._once[key] = make()
            return self._once[key]

    def refresh(self) -> None:
        """Forget written tables and cached lookups (after the inputs changed)."""
        with self._lock:
            self._written.clear()
            self._alias_rows = None
            for attr in ("_once",):
                if hasattr(self, attr):
                    delattr(self, attr)

    def build(self) -> dict[str, int]:
        """Load the raw rows and write both marts; returns mart row counts."""
        self.table("landed_games")
        return {n: self.rows(n) for n in ("dim_teams", "fct_games")}


#: Tables that the queries of the catalogue read.
SOURCES = ("orders", "customer", "lineitem", "nation", "region")


def input_listing(spark: SparkSession, sf_dir: str) -> tuple:
    """(path, bytes, modification time) of all files the queries read, at any depth."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    found = []
    for table in SOURCES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{table}.parquet")
        store = path.getFileSystem(conf)
        files = store.listFiles(path, True) if store.exists(path) else None
        while files is not None and files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


_CACHE: dict[tuple, Warehouse] = {}
_CACHE_LOCK = threading.Lock()


def warehouse_for(spark: SparkSession, sf_dir: str, profile: str = RATED) -> Warehouse:
    """The session's warehouse for an input folder (marts are written once, and again when
    the input files change)."""
    key = (app_id(spark), sf_dir.rstrip("/"), profile, input_listing(spark, sf_dir))
    with _CACHE_LOCK:
        if key not in _CACHE:
            _CACHE[key] = Warehouse(spark, sf_dir, profile)
        return _CACHE[key]
