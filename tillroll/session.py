"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Defaults for a local run; on a cluster these come from the submit configuration.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when Spark estimates the split costs one more shuffle:
    # the star join's other side comes from joins of its own, and Spark then declines.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "12g",
    # Remove checkpoint files (range-partitioned intermediates) once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


MAX_SHUFFLE_PARTITIONS = 65536


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Suggested settings for a cluster run over ``input_bytes`` of fact data.

    Shuffle partitions start at about one per ``target_partition_bytes`` of input, at least
    3x the cores (several tasks per core) and at most ``MAX_SHUFFLE_PARTITIONS``. The cap
    keeps the map x reduce block count manageable. The questions shuffle partial
    aggregates, not raw rows, except for a star join with a dimension too large to
    broadcast; such a join then runs with ~1-2 GB partitions that spill. AQE
    coalesces small partitions to the advisory size and splits skewed join partitions,
    so a key holding a third of the rows does not become one task. Files are split at
    the same size on read.
    """
    initial = min(MAX_SHUFFLE_PARTITIONS, max(3 * cores, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        # Static broadcasts only for small estimated sides; dimensions are additionally
        # counted by RetailModel before a broadcast hint is given.
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tillroll", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(LOCAL_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is left untouched. Only when it
    is unset (local tests) a fresh scratch folder is created and registered.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS...); "
                               "a machine-local folder cannot hold checkpoints on a cluster")
        current = tempfile.mkdtemp(prefix="tillroll-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current
