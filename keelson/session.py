"""Session helpers: configuration that every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # remove checkpoint files of ordered scans / dense keys once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # session windows: merge sessions inside each map partition before the shuffle
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app: str = "keelson",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, rocksdb_state: bool = False) -> SparkSession:
    """Session with UTC time zone and AQE on.

    On a cluster ``master`` stays None (taken from spark-submit); shuffle
    partitions default to AQE's coalescing of Spark's default, and only
    tests / local benches pin a number.  ``rocksdb_state`` keeps streaming
    state (dedupe keys, open windows) in RocksDB with changelog
    checkpointing instead of executor heap: the choice for large state.
    It applies to queries started from a fresh checkpoint.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**(ROCKSDB_STATE if rocksdb_state else {}), **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Conversions between timestamp_ntz and timestamp assume UTC."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; we only set our own
    when it is unset, and only in local mode; on a cluster that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="keelson-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/keelson/{name}-{uuid.uuid4().hex[:12]}"


def local_path(p: str) -> str:
    """Strip a ``file:`` scheme so Python-side helpers can use the path."""
    return p[5:] if p.startswith("file:") else p


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's shuffle partition count; the default parallelism when
    the setting is not a number."""
    v = spark.conf.get("spark.sql.shuffle.partitions", None)
    try:
        return max(int(v), 1)
    except (TypeError, ValueError):
        return spark.sparkContext.defaultParallelism
