"""SparkSession construction and the shared scratch location.

Everything that must survive an executor loss (stream checkpoints, staged
tables, lineage cuts) goes under ``spark.checkpoint.dir``: on a cluster that
is a shared file system named by the deployment.  We only choose a folder
ourselves when the session has none (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this engine wants, cluster or local.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # No broadcast from planner estimates (compressed file sizes are not a
    # bound): AQE broadcasts a side only once its real shuffle size is known.
    # Dimension joins broadcast explicitly behind a row-count check.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Partition columns are overwritten per partition, never table-wide.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # The stream's exact dedup keeps unbounded state: keep it off-heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Fixed value: the supervisor's time zone.
SUPERVISOR_ZONE = "Asia/Kuala_Lumpur"


def build_session(master: str | None = None, app: str = "lakepipe",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None, time_zone: str = SUPERVISOR_ZONE) -> SparkSession:
    """Build (or fetch) a session with the engine's settings.

    ``master`` is only for local runs; on a cluster the submitter sets it.
    ``time_zone``: the zone that days and deadlines are counted in.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in (ENGINE_CONF | {"spark.sql.session.timeZone": time_zone}).items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="lakepipe-ckpt-")      # local sessions and tests
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/lakepipe-{name}-{uuid.uuid4().hex[:12]}"


MAX_SHUFFLE_PARTITIONS = 32_768


def sizing_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Partition sizing for a given input volume and cluster.

    Scan splits target ~128 MB so a task's share fits in executor memory with
    room to spill.  Shuffle partitions cover the input at that size, but not
    more than MAX_SHUFFLE_PARTITIONS, as every map task reports a size for each
    of them: beyond that they grow larger (AQE coalesces the small ones, and
    operators shuffle columns, not whole inputs).  E.g. 100 TB on 8,000 cores:
    512 MB splits, 32,768 shuffle partitions.
    """
    if input_bytes // target_partition_bytes > 8 * MAX_SHUFFLE_PARTITIONS:
        target_partition_bytes *= 4
    parts = min(MAX_SHUFFLE_PARTITIONS, max(3 * total_cores, -(-input_bytes // target_partition_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
