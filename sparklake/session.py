"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "sparklake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, shuffle_bytes: int | None = None) -> SparkSession:
    """Session used by tests and the benchmark.

    On a cluster the caller's own session is used instead; nothing in the
    library depends on these settings except that AQE is expected to be on.
    ``shuffle_bytes`` sizes the partitions for a job that shuffles that much.
    """
    if shuffle_bytes:
        extra = {**scale_settings(shuffle_bytes), **(extra or {})}
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    master = master or f"local[{cpus}]"
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 2 * cpus))
         .config("spark.driver.memory", os.environ.get("SPARKLAKE_DRIVER_MEMORY", "8g"))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in (extra or {}).items():  # runtime settings also apply to a reused session
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only in local mode, where
    one machine is the whole cluster, an unset folder is replaced by a private one.
    """
    sc = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="sparklake-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/sparklake/{name}/{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete all folders that ``scratch_path`` has named: to be called when no result that
    is read lazily from them is needed any more."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/sparklake")
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def scale_settings(shuffle_bytes: int, *, partition_bytes: int = 256 << 20,
                   min_partitions: int = 200) -> dict:
    """SQL settings for a job that shuffles about ``shuffle_bytes``.

    Shuffle partitions are sized so one partition is ~``partition_bytes``
    (AQE coalesces small ones and splits skewed ones at run time).  The range
    operators in ``operators.ordered`` take their range count from the same
    setting, so their ranges stay as small.  ``build_session(shuffle_bytes=...)``
    applies them; on the session of a cluster job::

        for k, v in scale_settings(40 * 2**40).items():
            spark.conf.set(k, v)
    """
    n = max(min_partitions, -(-shuffle_bytes // partition_bytes))
    size = f"{partition_bytes >> 20}m"
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }
