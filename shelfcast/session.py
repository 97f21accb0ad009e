"""Spark session and shared-storage helpers.

Every library call works on whatever session it is given; this module only
builds one for tests and the benchmark, and finds the shared folder that the
cluster names in ``spark.checkpoint.dir`` for materialised tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on for results: dates stay in UTC.  The rest
# are the usual adaptive-execution switches (runtime broadcast conversion by
# measured size, skew-join splitting, partition coalescing).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "shelfcast", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (a cluster brings its own)."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = os.environ.get("SHELFCAST_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for materialised tables: the cluster's checkpoint dir.

    The setting is read from the session.  Only a local-mode session without
    one (tests) gets a fresh temporary folder; on a cluster a missing setting
    is an error, because a machine-local folder would not survive the loss of
    that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before materialising tables")
    path = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
    sc.setCheckpointDir(path)
    return path


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never-used table location under the shared folder."""
    return f"{shared_dir(spark)}/shelfcast/{name}-{uuid.uuid4().hex[:12]}"
