"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job relies on.  Timestamps are parsed as TIMESTAMP_NTZ, so the
# session zone does not change any result; UTC is pinned anyway for output.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Added for cluster runs (the CLI job): coalesce towards the advisory size
# rather than keeping every core busy with tiny partitions; 256 MiB shuffle
# partitions fit executor memory.  Locally they would collapse small data
# into one partition, so tests and the bench keep the defaults.
CLUSTER_CONF = {
    **JOB_CONF,
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def shuffle_partitions_for(input_bytes: int, partition_bytes: int = 256 << 20) -> int:
    """Initial shuffle partitions for a job reading ``input_bytes``: enough
    that no shuffle partition exceeds ~``partition_bytes`` even if a shuffle
    carries all input; AQE coalesces the small ones afterwards."""
    return max(8, -(-input_bytes // partition_bytes))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "policylens") -> SparkSession:
    """A local[N] session for tests and the bench (no UI, no extra servers)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names a folder that driver and executors share and
    is used as is.  Where it is unset, a local session (tests) gets a fresh
    folder; on any other master that would be a different disk on every
    machine, so it is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the server's setting applies
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="policylens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def workers_import_this(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it (a
    path that executors have too, or a local session); harmless if installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex}"
