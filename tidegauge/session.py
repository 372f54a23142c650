"""Session settings, shared folders, and the options a streaming query freezes at its start."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TASKS_PER_CORE = 4


def get_session(app: str = "tidegauge", **conf: str) -> SparkSession:
    """A session with the settings the library counts on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return fit(builder.getOrCreate())


def fit(spark: SparkSession) -> SparkSession:
    """Settings of a session, whoever made it.

    Dates of partitions and texts of timestamps follow the session's zone, so it is fixed to UTC.
    A shuffle starts with several partitions per core of the cluster, and adaptive execution joins
    those that turn out small: a fixed number made for small data would leave each of thousands of
    cores idle or out of memory.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    cores = spark.sparkContext.defaultParallelism
    wanted = max(int(spark.conf.get("spark.sql.shuffle.partitions")), TASKS_PER_CORE * cores)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return spark


def require_utc(spark: SparkSession) -> None:
    """Date folders written in one zone and read in another would hold other days."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone has to be UTC, not {zone}")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the cluster's shared `spark.checkpoint.dir`.

    Only a local master may fall back to the machine's own temporary folder: on a cluster another
    machine could not read it, and its content would be lost with the executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/tidegauge-{label}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"tidegauge-{label}-")


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is such a file or folder, on any file system Spark knows. Reading a path that is
    not there would tell as well, by an error that Spark logs with all its frames."""
    files, at = _file_system(spark, path)
    return files.exists(at)


def children(spark: SparkSession, path: str) -> list[str]:
    """Paths of what is in a folder; none if it is not there."""
    files, at = _file_system(spark, path)
    return [child.getPath().toString() for child in files.listStatus(at)] if files.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    """A file, or a folder with all in it; one that is gone already is fine."""
    files, at = _file_system(spark, path)
    files.delete(at, True)


@contextmanager
def stream_options(
    spark: SparkSession, shuffle_partitions: int | None = None, rocksdb: bool = True
) -> Iterator[None]:
    """Options in force while a streaming query starts; the session's own values come back after.

    A query keeps the number of state partitions and the state store it started with, for the life
    of its checkpoint. RocksDB keeps state on the executor's disk and uploads changes only, so the
    number of open (window, indicator) pairs is not bound by the heap.
    """
    wanted = {}
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if rocksdb:
        wanted["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
        wanted["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
