"""Command line: ``python -m courtside <command>`` (or via spark-submit).

  pipeline  LANDING OUT     latest CSV snapshots -> raw -> marts -> checks -> exports
  ingest    PAGES TABLE CKPT  landed API pages -> raw games table (stream, availableNow);
                            --current games|teams|player_stats: the latest landing of each key
  report    NAME OUT        an export, dashboard aggregate or metric over a run's marts
  bench     [SF_DIR]         the benchmark (same as bench.py)

The session comes from the environment (spark-submit / spark-defaults); only
when no master is configured is a local session started.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from pyspark import SparkConf
    if SparkConf().contains("spark.master"):
        spark = SparkSession.builder.appName("courtside").getOrCreate()
        from courtside.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(spark)
        return spark
    from courtside.session import local_session
    return local_session()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="courtside")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("pipeline")
    p.add_argument("landing")
    p.add_argument("out")
    p.add_argument("--aliases", default=None, help="alias seed CSV")
    p.add_argument("--layout", choices=("snapshots", "flat", "pages", "table", "state"), default="snapshots",
                   help="snapshot folders with a pointer, or timestamped <name>_<stamp>.csv files")
    p.add_argument("--report-only", action="store_true",
                   help="report failing checks instead of stopping before export")
    i = sub.add_parser("ingest")
    i.add_argument("pages")
    i.add_argument("table")
    i.add_argument("checkpoint")
    i.add_argument("--current", choices=("games", "teams", "player_stats"), default=None,
                   help="keep the latest landing of each key of this input, not every landing of games")
    r = sub.add_parser("report")
    r.add_argument("name", help="export, dashboard aggregate or metric name")
    r.add_argument("out", help="a pipeline output folder")
    r.add_argument("--grain", default=None, help="metric time grain")
    r.add_argument("--as-of", default=None, help="'today' for date windows (YYYY-MM-DD)")
    r.add_argument("--teams", nargs="*", default=None, help="team names to keep")
    r.add_argument("--seasons", nargs="*", type=int, default=None, help="seasons to keep")
    r.add_argument("--conference", default="All")
    r.add_argument("--rows", type=int, default=20, help="rows to print")
    b = sub.add_parser("bench")
    b.add_argument("sf_dir", nargs="?", default=None)
    args = ap.parse_args(argv)

    if args.cmd == "bench":
        import os
        if args.sf_dir:
            os.environ["BENCH_SF_DIR"] = args.sf_dir
        import bench
        bench.main()
        return 0

    spark = _session()
    if args.cmd == "pipeline":
        from courtside.plans.pipeline import run_pipeline
        res = run_pipeline(spark, args.landing, args.out, aliases_path=args.aliases,
                           fail_on=() if args.report_only else "all", layout=args.layout)
        print(json.dumps({"row_counts": res.row_counts, "checks": res.checks, "exports": res.exports,
                          "failed_exports": res.failed_exports, "rejected": res.rejected,
                          "profile": res.profile, "paths": res.paths}, default=str))
        return 1 if res.failed_exports else 0
    elif args.cmd == "report":
        from courtside.plans.pipeline import report
        import datetime as dt
        as_of = dt.date.fromisoformat(args.as_of) if args.as_of else None
        report(spark, args.out, args.name, as_of=as_of, grain=args.grain, teams=args.teams,
               seasons=args.seasons, conference=args.conference).show(args.rows, truncate=False)
    elif args.cmd == "ingest":
        from courtside.streaming.landing import ingest_game_pages
        from courtside.streaming.state import ingest_current
        q = (ingest_current(spark, args.pages, args.table, args.checkpoint, args.current) if args.current else
             ingest_game_pages(spark, args.pages, args.table, args.checkpoint))
        q.awaitTermination()
        print(json.dumps({"batches": len(q.recentProgress)}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
