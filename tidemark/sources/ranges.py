"""Keyed tables split by key range: an upsert rewrites only the ranges its rows fall in.

A snapshot upsert rewrites the whole table, which suits small tables and needs
no more than Parquet. Where keys grow with time, a batch touches few ranges of
a large table, and the rest stays as it is.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.operators.upsert import upsert
from tidemark.sources.shared import delete_folder, exists, filesystem, is_complete, materialize
from tidemark.spec import TableSpec

RANGE = "key_range"
SPAN = "_span-"
MOST_INTERVALS = 1000
LISTING_TASKS = 100
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_KEPT_LISTINGS = "spark.sql.hive.filesourcePartitionFileCacheSize"


def _key_range(key: str, span: int) -> Column:
    return F.call_function("div", F.col(key), F.lit(span))


def _schema(table: TableSpec) -> StructType:
    return StructType([*table.schema.fields, StructField(RANGE, LongType())])


def _known_span(spark: SparkSession, path: str) -> int | None:
    """The span a table was made with; the table's folder holds it in the name of a marker."""
    files, pattern = filesystem(spark, f"{path}/{SPAN}*")
    found = files.globStatus(pattern) or []
    return int(found[0].getPath().getName().removeprefix(SPAN)) if found else None


def _staged(path: str) -> str:
    return f"{path}.staged"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, int]):
    """The session with other settings for a while."""
    before = {key: spark.conf.get(key) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _listed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows below a path with very many folders.

    By default each folder is listed by a task of its own, and every listing is kept
    after its table is gone: with thousands of ranges the driver has no memory for that.
    """
    tasks = min(LISTING_TASKS, int(spark.conf.get(_LISTING)))
    with _settings(spark, {_LISTING: tasks, _KEPT_LISTINGS: 0}):
        return spark.read.schema(schema).parquet(path)


def _publish(spark: SparkSession, path: str) -> None:
    """Move the staged ranges into the table, leaving all others alone.

    Moving is atomic for no more than one range, so a range is in the table or still
    staged: a run that died in between is completed by the next one.
    """
    files, folder = filesystem(spark, _staged(path))
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    for found in files.listStatus(folder):
        staged = found.getPath()
        if not (name := staged.getName()).startswith(f"{RANGE}="):
            continue
        here = hadoop_path(path, name)
        files.delete(here, True)
        if not files.rename(staged, here):
            raise OSError(f"{staged} was not moved to {here}")
    delete_folder(spark, _staged(path))


def _finish_pending(spark: SparkSession, path: str) -> None:
    if is_complete(spark, _staged(path)):
        _publish(spark, path)


def _stored(spark: SparkSession, path: str, table: TableSpec) -> DataFrame:
    """The whole table with its ranges. Ranges a merge is about to replace are read as it staged them.

    The staged ones are listed first: a range that is moved meanwhile is then never missed.
    """
    schema = _schema(table)
    staged = _listed(spark, _staged(path), schema) if is_complete(spark, _staged(path)) else None
    published = _listed(spark, path, schema) if exists(spark, path) else spark.createDataFrame([], schema)
    if staged is None:
        return published
    others = published.join(staged.select(RANGE).distinct(), RANGE, "left_anti")
    return others.select(*schema.names).unionByName(staged)


def read_ranges(spark: SparkSession, path: str, table: TableSpec) -> DataFrame:
    """The whole table; empty when it does not exist yet. Complete also while a merge publishes its ranges."""
    return _stored(spark, path, table).drop(RANGE)


def _any(conditions: Sequence[Column]) -> Column:
    """Whether one of the conditions holds, as a balanced tree: a chain of a thousand overflows the planner's stack."""
    if len(conditions) == 1:
        return conditions[0]
    middle = len(conditions) // 2
    return _any(conditions[:middle]) | _any(conditions[middle:])


def _joined(intervals: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The intervals of whole numbers, sorted, with those that follow on one another as one."""
    joined: list[tuple[int, int]] = []
    for first, last in sorted(intervals):
        if joined and first == joined[-1][1] + 1:
            first = joined.pop()[0]
        joined.append((first, last))
    return joined


def _touching(target: DataFrame, source: DataFrame) -> DataFrame:
    """The rows of the target in the ranges of the source.

    A bounded number of intervals that hold all those ranges prunes the folders, as
    literals; the ranges themselves are a join.
    """
    ranges = source.select(RANGE).distinct()
    low, high = ranges.agg(F.min(RANGE), F.max(RANGE)).first()
    width = (high - low) // MOST_INTERVALS + 1
    part = F.call_function("div", F.col(RANGE) - low, F.lit(width))
    found = ranges.groupBy(part).agg(F.min(RANGE).alias("first"), F.max(RANGE).alias("last")).collect()
    inside = _any([F.col(RANGE).between(*interval) for interval in _joined((r["first"], r["last"]) for r in found)])
    return target.filter(inside).join(ranges, RANGE, "left_semi").select(*target.columns)


def merge_ranges(
    source: DataFrame, path: str, table: TableSpec, span: int, newer_by: str | None = None
) -> None:
    """Upsert the rows into a table whose ranges hold ``span`` keys each.

    The source is stored first: its ranges decide which partitions of the
    target are read at all. A table keeps the span of its
    first merge; another one is refused, since a key would lie in two ranges.
    """
    spark = source.sparkSession
    known = _known_span(spark, path)
    if known not in (None, span):
        raise ValueError(f"{path} has ranges of {known} keys, not {span}")
    _finish_pending(spark, path)
    ranged = table.conform(source).withColumn(RANGE, _key_range(table.key, span))
    stored = materialize(ranged, f"{table.name}-source")
    if stored.isEmpty():
        return
    target = spark.createDataFrame([], _schema(table))
    if exists(spark, path):
        target = _touching(_listed(spark, path, _schema(table)), stored)
    files, marker = filesystem(spark, f"{path}/{SPAN}{span}")
    files.mkdirs(marker)
    merged = upsert(target, stored, table.key, newer_by, nullable_key=False)
    # Rebalancing gives each range few files, and splits a range too large for one task.
    merged.hint("rebalance", RANGE).write.mode("overwrite").partitionBy(RANGE).parquet(_staged(path))
    _publish(spark, path)
