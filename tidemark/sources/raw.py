"""The raw layer: append-only Parquet batches under year / month / day folders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.shared import COMPRESSED, exists
from tidemark.spec import TableSpec

PARTITIONS = "year STRING, month STRING, day STRING, batch STRING"
PARTITION_COLUMNS = ["year", "month", "day", "batch"]


def batch_label(batch_end: datetime) -> str:
    return f"{batch_end:%Y%m%d_%H%M%S}"


def batch_path(root: str, table: str, batch_end: datetime) -> str:
    """Folder of one batch; month and day keep their leading zero."""
    return f"{root}/{table}/{batch_end:year=%Y/month=%m/day=%d}/batch={batch_label(batch_end)}"


def write_batch(df: DataFrame, root: str, table: str, batch_end: datetime) -> str:
    """Append the rows as they are to the folder of their batch.

    The partition values belong to the batch, not to the rows, so the rows go
    straight to their folder without being sorted by partition.
    """
    path = batch_path(root, table, batch_end)
    df.write.mode("append").options(**COMPRESSED).parquet(path)
    return path


def raw_exists(spark: SparkSession, root: str, table: TableSpec) -> bool:
    """Whether any batch of the table has landed."""
    return exists(spark, f"{root}/{table.name}")


def read_raw(
    spark: SparkSession,
    root: str,
    table: TableSpec | str,
    with_partitions: bool = False,
    merge_schema: bool = False,
    after: str | None = None,
) -> DataFrame:
    """All batches of a table, columns matched by name.

    With a ``TableSpec`` the contract is the read schema: nothing is inferred,
    columns a batch lacks are null. With a name the schema is inferred;
    ``merge_schema`` unites the columns of all batches. Partition columns are
    strings. ``after`` keeps the batches with a later label and reads no others.
    """
    name = table if isinstance(table, str) else table.name
    reader = spark.read.option("basePath", f"{root}/{name}")
    if isinstance(table, TableSpec):
        reader = reader.schema(StructType(table.schema.fields + StructType.fromDDL(PARTITIONS).fields))
    else:
        reader = reader.option("mergeSchema", str(merge_schema).lower())
    df = reader.parquet(f"{root}/{name}")
    if not isinstance(table, TableSpec):
        df = df.withColumns({**_padded(df), "batch": F.col("batch").cast("string")})
    if after is not None:
        df = df.filter(F.col("batch") > after)
    return df if with_partitions else df.drop(*PARTITION_COLUMNS)


def _padded(df: DataFrame) -> dict:
    """Partition columns that were inferred as numbers, as the strings in the folder names."""
    return {c: F.lpad(F.col(c).cast("string"), w, "0") for c, w in {"year": 4, "month": 2, "day": 2}.items()}


def union_batches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Batches one below the other by column name; a column a batch lacks is null."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Number of Parquet files and their total bytes below a path.

    Lists the files as binary without their content, so nothing is opened and
    files without rows are counted too.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    return files.agg(
        F.count("path").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
    )


def batch_inventory(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Files with rows, rows and bytes of each batch of a table, from the files' metadata; no column is read."""
    rows = spark.read.option("basePath", f"{root}/{table}").schema(PARTITIONS).parquet(f"{root}/{table}")
    per_file = rows.groupBy("batch", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.any_value("_metadata.file_size").alias("bytes")
    )
    return per_file.groupBy("batch").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")
    )
