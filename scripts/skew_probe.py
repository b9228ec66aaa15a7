"""Measure a hot key: a third of all orders on one customer, joined by shuffle.

usage: python scripts/skew_probe.py [sf_dir]

Runs the orders-customer game derivation twice with a forced sort-merge
join - AQE skew splitting off, then on - and prints, from Spark's event log
(written to a fresh scratch folder), the task count and the longest and
median task time of the join stage. The skewed orders are derived by Spark
from the given table (every third order moved to customer 1); nothing is
written except the event log.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def run(sf_dir: str, skew_join: bool) -> dict:
    from courtside.session import local_session
    from courtside.sources.fixture import games_from_orders, read_table

    log_dir = tempfile.mkdtemp(prefix="courtside-skewprobe-")
    spark = local_session(8, 64, app_name="skew-probe", extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
        "spark.eventLog.compress": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": str(skew_join).lower(),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        # keep the 64 join partitions as they are, so the hot one shows
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    })
    orders = read_table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1).cast("long"))
        .otherwise(F.col("o_custkey")))
    games = games_from_orders(orders, read_table(spark, sf_dir, "customer"))
    q = games.groupBy("hk").agg(F.count(F.lit(1)).alias("n"), F.sum("home_score").alias("s"))
    t = time.perf_counter()
    q.collect()  # 25 rows; runs this query's own (adaptive) plan
    wall = time.perf_counter() - t
    plan = q._jdf.queryExecution().executedPlan().toString()
    spark.stop()

    # per stage: task durations; the join stage is the one whose tasks read the
    # most shuffle records (it reads both sides)
    stages: dict[int, list] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True):
        for line in open(path):
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerTaskEnd":
                info = ev["Task Info"]
                read = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                stages.setdefault(ev["Stage ID"], []).append(
                    (info["Finish Time"] - info["Launch Time"],
                     read.get("Total Records Read", 0)))
    sid = max(stages, key=lambda s: sum(r for _, r in stages[s]))
    times = [d for d, _ in stages[sid]]
    recs = [r for _, r in stages[sid]]
    return {"skew_join": skew_join, "wall_s": round(wall, 2), "join_tasks": len(times),
            "max_task_ms": max(times), "median_task_ms": statistics.median(times),
            "max_task_records": max(recs), "median_task_records": statistics.median(recs),
            "split": "skew=true" in plan}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    for flag in (False, True):
        print(json.dumps(run(sf_dir, flag)), flush=True)


if __name__ == "__main__":
    main()
