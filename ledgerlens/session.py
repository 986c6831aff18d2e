"""Session helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "ledgerlens", cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, AQE on, UTC)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no stack walk for every expression
         .config("spark.sql.session.timeZone", "UTC"))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, *, local_fallback: bool = False) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster it must be set (a shared file system). Only a local-mode session
    (tests, the benchmark) may ask for a fresh local folder when it is unset; it
    is then also registered with the session so that ``DataFrame.checkpoint()``
    uses it.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if path:
        return path
    if not local_fallback or not spark.sparkContext.master.startswith("local"):
        # A machine-local folder is never used on a cluster: executors could not share it.
        raise RuntimeError(f"{CHECKPOINT_CONF} is not set; point it at a shared folder")
    path = tempfile.mkdtemp(prefix="ledgerlens-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def subdir(base: str, *parts: str) -> str:
    return os.path.join(base, *parts)


def scale_conf(input_bytes: int, total_cores: int, *, target_partition_bytes: int = 256 * 1024 * 1024,
               shrink_after_scan: float = 0.25) -> dict[str, str]:
    """Session settings for a cluster run over ``input_bytes`` of scoped input.

    Shuffle partitions are sized so one partition holds about
    ``target_partition_bytes`` of what reaches the first shuffle (the scoped,
    pruned, pre-aggregated rows, estimated as ``shrink_after_scan`` of the
    input), rounded up to whole waves of the cluster's cores; AQE coalesces
    downwards at runtime and splits skewed join partitions. Scans split files
    at 256 MB. Apply with ``for k, v in scale_conf(...).items(): spark.conf.set(k, v)``.
    """
    shuffled = max(1, int(input_bytes * shrink_after_scan))
    parts = max(total_cores, -(-shuffled // target_partition_bytes))
    parts = -(-parts // total_cores) * total_cores
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }
