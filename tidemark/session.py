"""Session settings the jobs are written for."""

from __future__ import annotations

# Bytes of shuffled data one task should handle.
TASK_BYTES = 256 * 1024 * 1024


def settings(cores: int, shuffle_bytes: int | None = None) -> dict[str, str]:
    """Spark settings for a cluster (or machine) with this many cores.

    ``shuffle_bytes`` is the largest shuffle expected. Shuffle partitions are
    sized so that a task's share fits its memory; adaptive execution merges the
    small ones and splits those a hot key makes large, also where that costs
    another shuffle.
    """
    partitions = cores if shuffle_bytes is None else max(cores, -(-shuffle_bytes // TASK_BYTES))
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
