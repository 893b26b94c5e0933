"""Session settings and the shared working folder.

Jobs take the caller's session. ``shared_dir`` resolves where intermediate
tables, streaming checkpoints and model artifacts go: the folder the cluster
names in ``spark.checkpoint.dir``. Only a local-mode session without that
setting (a test) gets a fresh temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job expects; AQE re-plans shuffles at run time (partition
# coalescing, skew splitting), the session zone pins event-time windows.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Size post-shuffle partitions by bytes (advisory 64 MB), not by core count:
    # small aggregates collapse to a few partitions (the MLP's per-iteration tree
    # aggregate then runs one stage instead of three), large ones stay split.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # HotSpot does not JIT methods over 8000 bytes of bytecode; wide rows (31
    # raw columns, 9 decimal magnitudes, 11 averages) generate larger fused
    # methods, which would then run interpreted. Above this size Spark splits
    # the stage into separately compiled operators instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Streaming window state off the JVM heap: the open (user, activity,
    # window) groups of a large fleet do not fit comfortably on-heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Commit a changelog per micro-batch instead of snapshotting the whole state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Local runs only: the test tables and staged files are a few MB, below the
# 4 MB per-file open cost that keeps Spark from splitting them, so one file
# would be one task. Cluster inputs are large files; the default fits there.
LOCAL_CONF = {
    "spark.sql.files.openCostInBytes": str(512 * 1024),
    "spark.driver.memory": "16g",
}

_LOCAL_FALLBACK: dict[str, str] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A local session for tests and the benchmark (the library never creates one)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("kinesia")
    settings = {**DEFAULT_CONF, **LOCAL_CONF}
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update({k: str(v) for k, v in conf.items()})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """The SQL settings above on a given session, but for those that the user has set."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


# Of DEFAULT_CONF, what the time and memory of a job over many readings hang on.
JOB_KEYS = (
    "spark.sql.codegen.hugeMethodLimit",
    "spark.sql.streaming.stateStore.providerClass",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
)


@contextmanager
def job_settings(spark: SparkSession) -> Iterator[None]:
    """``JOB_KEYS`` while a job runs on the caller's session, but for those that are set; then as before.

    Streaming queries keep the settings they start with.
    """
    unset = [k for k in JOB_KEYS if spark.conf.get(k, None) is None]
    for k in unset:
        spark.conf.set(k, DEFAULT_CONF[k])
    try:
        yield
    finally:
        for k in unset:
            spark.conf.unset(k)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``.

    Unset is an error on a cluster: a machine-local folder would vanish with the
    executor. In local mode a temporary folder is made once per session and
    registered as the checkpoint folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
    key = sc.applicationId
    if key not in _LOCAL_FALLBACK:
        _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="kinesia-")
        sc.setCheckpointDir(_LOCAL_FALLBACK[key])
    return _LOCAL_FALLBACK[key]


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared root for one run of ``purpose``."""
    return f"{checkpoint_root(spark)}/kinesia/{purpose}/{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable: point the context at the shared root."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(f"{checkpoint_root(spark)}/kinesia/rdd-checkpoints")
