"""Session settings sized from the input volume.

Partitions are sized to a target number of bytes so that a task's share of a
scan or shuffle fits executor memory without spilling; AQE then coalesces
small post-shuffle partitions and splits skewed ones at run time.
"""

from __future__ import annotations

import math

TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def recommended_conf(input_bytes: int, cores: int,
                     target_partition_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Settings for a job reading ``input_bytes`` on ``cores`` task slots.

    ``spark.sql.shuffle.partitions`` is the input volume over the target
    partition size (the census derivation shuffles about its whole input),
    at least two waves of tasks and without an upper bound, so that a partition
    keeps its target size at any volume; AQE coalesces it down for the small
    post-aggregation shuffles.
    """
    parts = math.ceil(max(input_bytes, 1) / target_partition_bytes)
    parts = max(parts, 2 * cores)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def apply(builder, input_bytes: int, cores: int, **kw):
    """``SparkSession.Builder`` with ``recommended_conf`` applied."""
    for k, v in recommended_conf(input_bytes, cores, **kw).items():
        builder = builder.config(k, v)
    return builder
