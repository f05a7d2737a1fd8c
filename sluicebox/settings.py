"""Session settings for cluster runs. The library never changes a session; callers apply these themselves."""

from __future__ import annotations

PARTITION_BYTES = 256 * 1024**2


def cluster_settings(shuffle_bytes: int, cores: int, shared_folder: str) -> dict[str, str]:
    """Settings for a run whose largest shuffle moves about ``shuffle_bytes``.

    Shuffles start with partitions of about 256 MB (at least two per core); adaptive execution
    merges small ones and splits the partition of a hot join key. ``shared_folder`` must be reachable by
    every executor: stages and checkpoints go there, so that a lost executor costs no long recomputation.
    """
    partitions = max(-(-shuffle_bytes // PARTITION_BYTES), 2 * cores)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.checkpoint.dir": shared_folder,
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
