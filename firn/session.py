"""Session helpers: the settings every plan in this package assumes."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on.  Time columns are TIMESTAMP_NTZ and the
# helpers avoid zone-dependent functions, but UTC keeps casts predictable.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "firn", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; a cluster passes its own."""
    b = SparkSession.builder.master(master).appName(app_name)
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", "12g").config("spark.ui.showConsoleProgress", "false")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables: the one the context has,
    else the cluster's ``spark.checkpoint.dir``.  Only a local session without either (tests)
    gets a folder of its own; on a cluster that is an error, as executors could not see each other's files."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="firn-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def scale_conf(input_bytes: int, shuffle_fraction: float = 0.3,
               target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster session sized from the bytes a job reads.

    The initial shuffle partition count aims at ~256 MB per reducer for
    the expected shuffle volume (``shuffle_fraction`` of the input after
    pruning and map-side aggregation); AQE coalesces small partitions and
    splits skewed ones at runtime, so the count is an upper bound.  E.g.
    100 TB read, 30 % shuffled -> 122,880 initial partitions.  There is no upper limit: a
    larger input gets more reducers, not larger ones.
    """
    import math
    n = max(200, math.ceil(input_bytes * shuffle_fraction / target_partition_bytes))
    mb = target_partition_bytes >> 20
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{mb}m",
        "spark.sql.files.maxPartitionBytes": f"{mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        # streaming state (T01-T03) off the JVM heap, checkpointed incrementally
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
