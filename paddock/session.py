"""Session construction and the shared working folder.

Jobs never write to a machine-local folder on a cluster: scratch tables,
checkpoints and versioned outputs live below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local tests) do
we pick a temporary folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every paddock job wants; sizes are left to the deployment.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "paddock",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  event_log_dir: str | None = None) -> SparkSession:
    """Session with paddock's defaults; ``event_log_dir`` records stage/task timings there
    (read them from the log — the web UI stays off)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if event_log_dir:
        if "://" not in event_log_dir:          # a local folder must exist; remote ones are created
            os.makedirs(event_log_dir, exist_ok=True)
        conf["spark.eventLog.enabled"] = "true"
        conf["spark.eventLog.dir"] = event_log_dir
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster (``spark.checkpoint.dir``)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        # Unset in local runs only: choose our own once per session.
        root = tempfile.mkdtemp(prefix="paddock-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    root = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/paddock/{name}-{uuid.uuid4().hex}"


MB = 1 << 20


def size_for_input(spark: SparkSession, input_bytes: int, partition_bytes: int = 128 * MB,
                   most: int = 20_000) -> int:
    """Size shuffles and scan splits for the data about to be processed.

    Initial shuffle partitions ~ input / 128 MB, at least twice the cores and at most ``most`` (each map
    task reports a size per partition to the driver); AQE then coalesces the ones that turn out small.  Scan
    splits of 256 MB keep task counts manageable.  What the deployment has set itself is left alone.
    """
    cores = spark.sparkContext.defaultParallelism
    n = min(most, max(2 * cores, -(-int(input_bytes) // partition_bytes)))
    given = spark.sparkContext.getConf()
    for key, value in {"spark.sql.shuffle.partitions": n, "spark.sql.adaptive.advisoryPartitionSizeInBytes": partition_bytes,
                       "spark.sql.files.maxPartitionBytes": 2 * partition_bytes}.items():
        if not given.contains(key):
            spark.conf.set(key, str(value))
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
