"""Session settings for large runs. The caller owns the session and applies them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

MIB = 1024 * 1024
PARTITION_BYTES = 128 * MIB

# The largest dimension handed to every executor; anything larger is shuffled.
BROADCAST_LIMIT_BYTES = 64 * MIB


def session_settings(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Adaptive execution on, and enough first shuffle partitions for the data.

    ``shuffle_bytes`` is what the widest shuffle writes, about the bytes of the
    columns a job reads. Adaptive execution merges small partitions afterwards,
    so a high first number costs little and a low one spills.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
    }


# What every job's own session gets. Time stamps in messages are in UTC whatever the machine says, and tables
# cut by a flag are written with a file open for each of its values instead of sorted.
BASE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def input_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Bytes of the files below some paths, from their listing; paths may hold patterns and need not exist."""
    total = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        total += sum(files.getContentSummary(found.getPath()).getLength() for found in files.globStatus(place) or [])
    return total
