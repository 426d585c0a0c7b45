"""Keyed upsert: matched rows are replaced whole, new rows are added, nothing is deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def free_name(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name = f"_{name}"
    return name


def _once_per_key(source: DataFrame, key: str) -> DataFrame:
    """Fail the job when the source holds a key twice, as a MERGE would.

    Row numbers stream through the sorted partition, so nothing is buffered,
    and the shuffle on the key is the one the join needs anyway.
    """
    copy = free_name(source, "copy")
    number = F.row_number().over(Window.partitionBy(key).orderBy(key))
    message = F.concat(F.lit(f"upsert source has a repeated {key}: "), F.col(key).cast("string"))
    checked = F.assert_true(F.col(key).isNull() | (F.col(copy) == 1), message)
    return source.withColumn(copy, number).filter(checked.isNull()).drop(copy)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str,
    newer_by: str | None = None,
    check_unique: bool = True,
    nullable_key: bool = True,
) -> DataFrame:
    """The target after merging ``source`` into it by ``key``.

    One full outer join, which reads and shuffles each side once. Null keys match
    nothing: such rows of both sides pass by the join, however many there are.
    Tables whose rules exclude null keys can set ``nullable_key=False`` and save
    that second look at the rows. With ``newer_by``, a target row that is newer
    than its source row is kept, which makes replayed batches harmless. Set
    ``check_unique=False`` only for a source already reduced to one row per key.
    """
    if set(target.columns) != set(source.columns):
        raise ValueError(f"upsert columns differ: {target.columns} vs {source.columns}")
    source = source.select(*target.columns)
    if nullable_key:
        keyless = F.col(key).isNull()
        passing = target.filter(keyless).unionByName(source.filter(keyless))
        keyed = upsert(target.filter(~keyless), source.filter(~keyless), key, newer_by, check_unique, False)
        return keyed.unionByName(passing)
    if check_unique:
        source = _once_per_key(source, key)
    offered = free_name(source, "offered")
    old, new = target.alias("old"), source.withColumn(offered, F.lit(True)).alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer")
    replaced = F.col(f"new.{offered}").isNotNull()
    if newer_by is not None:
        replaced &= ~F.coalesce(F.col(f"old.{newer_by}") > F.col(f"new.{newer_by}"), F.lit(False))
    return joined.select(
        *[F.when(replaced, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in target.columns]
    )


def key_tally(source: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """``key, offered``: how often the source offers each key of either side.

    Null keys match nothing and are never offered. Nothing but keys is read and shuffled.
    """
    once = F.when(F.col(key).isNotNull(), 1).otherwise(0)
    keys = source.select(F.col(key).alias("key"), once.alias("offered"))
    if target is not None:
        keys = keys.unionByName(target.select(F.col(key).alias("key"), F.lit(0).alias("offered")))
    return keys.groupBy("key").agg(F.sum("offered").alias("offered"))


def merge_into(source: DataFrame, table: str, key: str, newer_by: str | None = None) -> None:
    """The same upsert as a MERGE on a catalog table whose format supports it (Delta, Iceberg)."""
    outdated = None if newer_by is None else F.col(f"{table}.{newer_by}") > F.col(f"source.{newer_by}")
    merge = source.alias("source").mergeInto(table, F.col(f"{table}.{key}") == F.col(f"source.{key}"))
    matched = merge.whenMatched() if outdated is None else merge.whenMatched(~F.coalesce(outdated, F.lit(False)))
    matched.updateAll().whenNotMatched().insertAll().merge()
