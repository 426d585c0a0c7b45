"""Relational sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.changes import changes


def jdbc_options(
    url: str,
    table: str,
    key: str,
    key_range: tuple[int, int],
    partitions: int,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options for a read that splits on the key.

    Keys outside ``key_range`` are still read: the range only places the splits.
    """
    low, high = key_range
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
        "preferTimestampNTZ": "true",
        **extra,
    }


def read_changes(
    spark: SparkSession, options: dict[str, str], start: datetime, end: datetime, changed_at: str = "updated_at"
) -> DataFrame:
    """The rows of a relational table changed in (start, end]; the database evaluates the window."""
    return changes(spark.read.format("jdbc").options(**options).load(), start, end, changed_at)
