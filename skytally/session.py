"""Session settings the package relies on, and where its working tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

REQUIRED_CONF = {
    # event time is UTC throughout; TIMESTAMP_NTZ inputs are read as UTC wall time
    "spark.sql.session.timeZone": "UTC",
    # one state row per key and live window: keep it off the JVM heap
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # every micro-batch commits its changes durably; full snapshots follow every 300 seconds
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.maintenanceInterval": "300s",
    # counting the rows of the store costs a read before every write; off, progress reports 0 rows
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


_work_base: str | None = None


def apply_conf(spark: SparkSession, count_state: bool = False) -> SparkSession:
    """Set what the package relies on; ``count_state`` makes progress report how many rows the state holds."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    if count_state:
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "true")
    return spark


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g", checkpoint_dir: str | None = None
) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skytally")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_work_folder(folder: str) -> None:
    """Name the folder for working tables of sessions without ``spark.checkpoint.dir``."""
    global _work_base
    _work_base = folder


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for checkpoints and intermediate tables.

    Lives under ``spark.checkpoint.dir``, which on a cluster names shared storage, or, where that is
    unset, under the folder the caller named with :func:`use_work_folder`.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _work_base
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
