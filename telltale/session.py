"""Session settings and the shared folder that holds intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_dirs: dict[str, str] = {}


def build_session(app: str = "telltale", **settings: str) -> SparkSession:
    """A session with the settings the jobs rely on.

    Timestamps are formatted and parsed in UTC, so no window label occurs twice
    on the day a local clock is set back. The jobs' own streams keep no state; that of
    others in this session is kept in RocksDB, off the heap. Everything else keeps Spark's defaults (adaptive execution with
    skew-join handling and partition coalescing is one).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="telltale-")
    return _local_dirs[app]


def run_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
