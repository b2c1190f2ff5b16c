"""SparkSession bootstrap.

On a cluster the session already exists and carries its own configuration; this helper
only fills in settings that are unset, so cluster values (shuffle partitions, checkpoint
directory, ...) always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Applied only where the session has no value yet.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parquet timestamps from the fixtures are timestamp_ntz; keep them as written.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "visitlens") -> SparkSession:
    """Return the active session, creating a local one (tests, bench) if none exists."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_defaults(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
        builder = (builder
                   .config("spark.ui.enabled", "false")
                   .config("spark.ui.showConsoleProgress", "false")
                   # call-site capture costs several py4j round trips per API call
                   .config("spark.python.sql.dataFrameDebugging.enabled", "false")
                   .config("spark.driver.memory", os.environ.get("VISITLENS_DRIVER_MEMORY", "8g"))
                   .config("spark.sql.shuffle.partitions",
                           str(shuffle_partitions or cpus)))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_defaults(spark)
    return spark


def ensure_defaults(spark: SparkSession) -> None:
    for key, value in _DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must already be set to shared storage. Only in local mode (tests)
    is a scratch folder created and registered when the setting is missing.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="visitlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cluster_settings(input_bytes: int, executor_cores: int, executors: int,
                     target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle / scan sizing for a cluster run over ``input_bytes`` of parquet.

    * scan splits of ``target_partition_bytes`` (one task reads ~256 MB of parquet);
    * initial shuffle partitions so that the largest shuffle (about the input size,
      before map-side partial aggregation shrinks it) gives ~``target`` bytes per
      partition, at least two waves of tasks, at most 200,000 to keep the map-status table
      manageable (so above 50 TB partitions grow: 0.5 GB each at 100 TB); AQE then coalesces small partitions toward the same advisory size and
      splits skewed ones (a partition 5x the median and above 1 GB).

    Example: 100 TB on 1000 executors x 8 cores gives 200,000 shuffle partitions
    (capped), 256 MB scan splits.
    """
    slots = max(1, executor_cores * executors)
    by_size = -(-input_bytes // target_partition_bytes)
    partitions = int(min(max(by_size, 2 * slots), 200_000))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        # runtime broadcast only for sides measured below 64 MB
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    for key, value in settings.items():
        spark.conf.set(key, value)
