"""Session construction and the shared folder for materialised tables.

Library functions never build a session themselves: they take DataFrames.
This module is for entry points (bench, tests, pipeline CLI) and for the
one thing every job needs from the session, the shared checkpoint folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: UTC so DATE/TIMESTAMP casts match the
# inputs' ISO "Z" times, ANSI so bad casts fail instead of turning NULL,
# AQE so shuffle partition counts, join strategies and skewed partitions
# are re-planned from runtime sizes.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "courtside", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benchmarks (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    conf = dict(CORE_CONF)
    conf["spark.driver.memory"] = "8g"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", None) or ""
    return master.startswith("local")


def app_id(spark: SparkSession) -> str:
    """The application id (works for classic and Connect sessions)."""
    return spark.conf.get("spark.app.id", None) or spark.sparkContext.applicationId


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the session names.

    The cluster's ``spark.checkpoint.dir`` (or one set on the context) wins.
    Only a local session without one gets a fresh temporary folder; on a
    cluster a machine-local folder would not survive losing that machine,
    so an unset folder is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect: no context on the client)
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
        configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
            return sc.getCheckpointDir() or configured
    elif configured:
        return configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) that every executor can reach")
    local = tempfile.mkdtemp(prefix="courtside-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local)
        return sc.getCheckpointDir()
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    app = app_id(spark)
    leaf = "/".join(p.strip("/") for p in parts if p)
    return f"{base}/courtside/{app}/{leaf}-{uuid.uuid4().hex[:8]}"
