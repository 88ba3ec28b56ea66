"""Session helpers: building a session for tests/bench and finding the shared folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "semjoin",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the local bench. On a cluster, callers bring their own."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = (SparkSession.builder
         .master(master or f"local[{cpus}]")
         .appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The folder comes from ``spark.checkpoint.dir`` (or one already set on the
    context). Only a local-mode session without one gets a folder of our own,
    as in tests; a cluster session without one is a configuration error, since
    a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/GCS) on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="semjoin-ckpt-"))
    return sc.getCheckpointDir()


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh folder under the shared checkpoint folder, for written tables and stream state."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    leaf = list(parts) + ([uuid.uuid4().hex] if unique else [])
    return "/".join([root, "semjoin"] + leaf)
