"""Session settings and the shared folder that jobs write intermediate data to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOT: dict[str, str] = {}
_SCRATCH: dict[str, list[str]] = {}


def build_session(
    app_name: str = "tidemark",
    master: str | None = None,
    initial_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the settings the operators count on.

    Times are UTC, AQE is on, and shuffles are hash-partitioned by size: Spark
    coalesces small partitions and splits skewed ones at run time, but never adds
    any. ``initial_partitions`` is the number a shuffle starts with; give about
    one for every 100 MB of the largest shuffle. Streams keep their state in
    RocksDB, outside the heap.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if initial_partitions is not None:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", initial_partitions
        )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may go without the setting; it gets a temporary
    folder. On a cluster a machine-local folder would be lost with its executor,
    so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app_id = context.applicationId
    if app_id not in _LOCAL_ROOT:
        _LOCAL_ROOT[app_id] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_ROOT[app_id]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` write to the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path under the shared folder."""
    path = os.path.join(shared_root(spark), f"{label}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_database(spark: SparkSession, label: str) -> str:
    """A new database whose managed tables live in the shared folder."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder of any file system Spark reaches; none if it is absent."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = jvm.org.apache.hadoop.fs.Path(f"{path}/*")
    listed = found.getFileSystem(conf).globStatus(found) or []
    return [s.getPath().getName() for s in listed if s.isDirectory()]


def cleanup(spark: SparkSession) -> None:
    """Drop the scratch data of the session so far; results that read it are void."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
