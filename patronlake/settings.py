"""Session settings that go with the size of the data. The library never changes a session."""

from __future__ import annotations

MIB = 1024**2
PARTITION_BYTES = 256 * MIB
# The driver keeps the sizes of every map task's part of every partition. Beyond this many partitions they
# grow in size, as do the splits that are read, so that the blocks of a shuffle stay near 2^31 at 100 TB.
MAX_PARTITIONS = 32_768
MAX_SPLIT = 1536 * MIB


def session_settings(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a session whose largest shuffle moves ``shuffled_bytes``.

    Shuffles start with partitions of about 128 MiB, at least two per core and at most
    MAX_PARTITIONS, and adaptive execution joins small ones up to 256 MiB. Partitions beyond four
    times the median are split in joins.
    """
    partitions = min(MAX_PARTITIONS, max(2 * cores, -(-shuffled_bytes // (PARTITION_BYTES // 2))))
    split = min(MAX_SPLIT, max(PARTITION_BYTES, -(-shuffled_bytes // (2 * MAX_PARTITIONS))))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * PARTITION_BYTES),
        # Lets a month's order ids thin out the items before these are shuffled to meet them.
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.parquet.compression.codec": "snappy",
        # Event ids of the deduplicating stream live outside the heap.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
