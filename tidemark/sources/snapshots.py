"""Keyed tables on plain Parquet: every write is a new folder, the newest complete one is current."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.fingerprints import bucket_of, compared_buckets, within
from tidemark.operators.upsert import free_name, key_tally, upsert
from tidemark.sources.shared import COMPRESSED, delete_folder, filesystem, new_folder
from tidemark.spec import TableSpec

MISSING = -1
_UNFINISHED = COMPRESSED | {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def versions(spark: SparkSession, path: str) -> list[int]:
    """Version numbers of the complete snapshots, oldest first."""
    files, pattern = filesystem(spark, f"{path}/version=*/_SUCCESS")
    markers = files.globStatus(pattern) or []
    return sorted(int(m.getPath().getParent().getName().split("=")[1]) for m in markers)


def current_version(spark: SparkSession, path: str) -> int:
    found = versions(spark, path)
    return found[-1] if found else MISSING


def read_snapshot(spark: SparkSession, path: str, table: TableSpec, version: int | None = None) -> DataFrame:
    """One version of a table, the current one by default; empty when there is none."""
    version = current_version(spark, path) if version is None else version
    if version == MISSING:
        return spark.createDataFrame([], table.schema)
    return spark.read.schema(table.schema).parquet(f"{path}/version={version:06d}")


def write_snapshot(df: DataFrame, path: str) -> int:
    """Store the rows as the next version and return its number.

    A folder a failed write left behind has no success marker: it is never
    read, and the next write with its number replaces it.
    """
    version = current_version(df.sparkSession, path) + 1
    df.write.mode("overwrite").options(**COMPRESSED).parquet(f"{path}/version={version:06d}")
    return version


def expire_snapshots(spark: SparkSession, path: str, keep: int) -> list[int]:
    """Delete all but the newest versions, and what failed writes before them left; the deleted versions.

    Readers of a deleted version fail, so keep as many as readers may be behind.
    """
    if keep < 1:
        raise ValueError("keep the current version at least")
    kept = versions(spark, path)[-keep:]
    files, pattern = filesystem(spark, f"{path}/version=*")
    expired = []
    for folder in files.globStatus(pattern) or []:
        version = int(folder.getPath().getName().split("=")[1])
        if kept and version < kept[0]:
            files.delete(folder.getPath(), True)
            expired.append(version)
    return sorted(expired)


def merge_snapshot(
    source: DataFrame, path: str, table: TableSpec, newer_by: str | None = None
) -> int:
    """Upsert the rows into the table; the first write creates it.

    Rows that replace whatever they meet are written as they come, and keys alone
    decide which rows of the version before stay beside them. Only then the new
    version is complete. With ``newer_by`` rows meet in a join.
    """
    spark = source.sparkSession
    source = table.conform(source)
    current = current_version(spark, path)
    target = read_snapshot(spark, path, table, current)
    if newer_by is not None:
        return write_snapshot(upsert(target, source, table.key, newer_by, nullable_key=False), path)
    folder, keys = f"{path}/version={current + 1:06d}", new_folder(spark, f"{table.name}-keys")
    source.write.mode("overwrite").options(**_UNFINISHED).parquet(folder)
    _add_staying(spark.read.schema(table.schema).parquet(folder), target, table.key, folder, keys)
    delete_folder(spark, keys)
    return current + 1


def _other_buckets(offered: DataFrame, target: DataFrame, key: str) -> list[DataFrame]:
    """The keys of both sides in buckets that are not the same; null keys, which match nothing, are in one of these."""
    bucket = F.when(F.col(key).isNull(), -1).otherwise(bucket_of(key))
    buckets = compared_buckets(offered.select(key), target.select(key), bucket)
    other = buckets.filter("NOT same OR bucket < 0").select("bucket")
    if other.isEmpty():
        return [df.select(key).limit(0) for df in (offered, target)]
    return [within(df.select(key), bucket, other) for df in (offered, target)]


def _add_staying(offered: DataFrame, target: DataFrame, key: str, folder: str, keys: str) -> None:
    """Complete a version that holds the offered rows by the rows of the target whose keys are not offered.

    Few offered keys are held against the target itself. Where they are many, few
    rows stay: keys are compared with keys, and those that stay are looked up. The
    same pass over the keys finds one that is offered twice. Buckets of keys with the
    same fingerprint on both sides hold the same keys, once each as the target does.
    """
    spark = offered.sparkSession
    held = target.count()
    few = 2 * offered.count() < held
    sides = [offered, None if few else target]
    if held and not few:
        sides = _other_buckets(*sides, key)
    key_tally(*sides, key).filter("offered <> 1").write.parquet(keys)
    odd = spark.read.parquet(keys)
    repeated = odd.filter("offered > 1").first()
    if repeated is not None:
        raise ValueError(f"upsert source has a repeated {key}: {repeated['key']}")
    if few:
        staying = target.join(offered.select(key), key, "left_anti")
    else:
        name = free_name(target, "staying")
        staying = target.join(odd.select(F.col("key").alias(name)), F.col(key).eqNullSafe(F.col(name)), "left_semi")
    if few or not odd.isEmpty():
        staying.select(*offered.columns).write.mode("append").options(**COMPRESSED).parquet(folder)
    else:
        files, marker = filesystem(spark, f"{folder}/_SUCCESS")
        files.create(marker).close()


def snapshot_state(spark: SparkSession, path: str, table: TableSpec) -> DataFrame:
    """Rows and version of a table; 0 rows and version -1 when it does not exist."""
    version = current_version(spark, path)
    counted = read_snapshot(spark, path, table, version).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.lit(table.name).alias("table_name"), "row_count", F.lit(version).alias("version"))
