"""Session settings the operators are designed for."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution is what splits hot join keys: a shuffle partition far above the
# median is cut by map output, so one key holding a third of the fact rows is joined by
# many tasks. Forced, it does so also where the rows after the join would have stayed in
# place, at the price of one more shuffle, and only when a partition is in fact skewed.
# Broadcasts stay behind autoBroadcastJoinThreshold, which Spark checks against file
# statistics and again against real shuffle sizes.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
# Folders of one column's values that a task writes side by side, without a sort by them.
OPEN_FOLDERS = {"spark.sql.maxConcurrentOutputFileWriters": "32"}
CHECKPOINT_DIR = "spark.checkpoint.dir"
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def tune(spark: SparkSession) -> SparkSession:
    """Turn on the handling of skew, and writes without a sort, in a session built elsewhere."""
    for name, value in (SKEW_SETTINGS | OPEN_FOLDERS).items():
        spark.conf.set(name, value)
    return spark


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Set the shuffle partitions for this much input; never below what is set.

    Partitions start small enough for an executor's memory, and adaptive execution joins
    those that turn out small. Returns the number set.
    """
    wanted = -(-input_bytes // SHUFFLE_PARTITION_BYTES)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


def bytes_under(spark: SparkSession, *paths: str) -> int:
    """Stored bytes of files and folders in whichever store; 0 for what is not there."""
    total = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        store = place.getFileSystem(spark._jsc.hadoopConfiguration())
        if store.exists(place):
            total += store.getContentSummary(place).getLength()
    return total


def one_row(spark: SparkSession) -> DataFrame:
    """A single row in a single task, to hang literals on."""
    return spark.range(0, 1, 1, 1)


def local_session(
    app: str, cpus: int | str = 8, partitions: int | None = None, scratch: str | None = None
) -> SparkSession:
    """Local session for tests and the benchmark; `scratch` where no folder is set yet."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SHOPSTAR_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
    )
    for name, value in SKEW_SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    if scratch and not spark.sparkContext.getConf().get(CHECKPOINT_DIR):
        spark.conf.set(CHECKPOINT_DIR, scratch)
    spark.sparkContext.setLogLevel("ERROR")
    return spark
