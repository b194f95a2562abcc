"""Session construction and the shared work folder.

Library code never invents machine-local folders: anything a job writes
(tables, landing files, stream checkpoints) lives under the folder the cluster
names in ``spark.checkpoint.dir``.  Only when that is unset (local tests) do we
create one ourselves (local masters only; on a cluster an unset root is an error).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def get_spark(app: str = "tributary", master: str | None = None,
              shuffle_partitions: int | None = None, driver_memory: str | None = None
              ) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Streaming state (minute windows) off the JVM heap, checkpointed
        # incrementally; the provider ships with Spark.
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def session_key(spark: SparkSession) -> str:
    """Identity of the running application (for per-session memoization)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        return str(id(spark))


def work_root(spark: SparkSession) -> str:
    """Shared folder for tables and stream state.

    Order: ``spark.checkpoint.dir`` from the session, then the SparkContext
    checkpoint dir, else (tests only) a fresh temp folder that is also
    installed as the checkpoint dir.
    """
    try:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001
        conf_dir = None
    if conf_dir:
        return conf_dir.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no context to ask or to set
        sc = None
    if sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
        if conf_dir:
            return conf_dir.rstrip("/")
        if sc.getCheckpointDir():
            return sc.getCheckpointDir().rstrip("/")
    key = session_key(spark)
    if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if key not in _LOCAL_ROOTS:
        root = tempfile.mkdtemp(prefix="tributary-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir()
        _LOCAL_ROOTS[key] = root.rstrip("/")
    return _LOCAL_ROOTS[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never-reused folder under the work root (one per run)."""
    return f"{work_root(spark)}/tributary/{name}-{uuid.uuid4().hex[:12]}"
