"""Session helpers: building a local session and finding the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours wants; a cluster may override them at submit time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, memory: str = "8g") -> SparkSession:
    """A local[N] session for tests and the bench; on a cluster use the submitted session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("claimlake")
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cores)
    conf["spark.driver.memory"] = memory
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    conf["spark.sql.warehouse.dir"] = os.path.join(tempfile.gettempdir(), f"claimlake-wh-{uuid.uuid4().hex[:8]}")
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    A cluster names it in ``spark.checkpoint.dir`` (or via ``setCheckpointDir``);
    we only invent one on a ``local[n]`` session, as in tests; any other raises.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = os.path.join(tempfile.gettempdir(), f"claimlake-ckpt-{uuid.uuid4().hex[:8]}")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what follows, and lost executors, start from the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_conf(input_bytes: int, target_partition_bytes: int = 256 << 20, max_partitions: int = 400_000) -> dict:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of input.

    AQE coalesces small shuffle partitions but cannot split a too-large one
    (except skewed join partitions), so the initial shuffle width is sized for
    the input (~``target_partition_bytes`` per partition, e.g. ~400 000 for
    100 TB) and AQE merges down to the advisory size at run time.  Scan splits
    match the same target; the skew-join thresholds are tied to it so a hot key
    that reaches a third of a join side is split.
    """
    n = max(200, min(max_partitions, input_bytes // target_partition_bytes + 1))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }
