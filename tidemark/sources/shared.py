"""The folder all executors share, and tables stored there to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Raw batches, checked rows and snapshots: smaller files for the same time.
COMPRESSED = {"compression": "zstd"}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Where neither is set, a local session gets a temporary folder of its own; on
    a cluster that would not be visible to the executors, so it is an error.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def filesystem(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as its type."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder finished."""
    files, marker = filesystem(spark, f"{path}/_SUCCESS")
    return files.exists(marker)


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = filesystem(spark, path)
    return files.exists(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    files, folder = filesystem(spark, path)
    files.delete(folder, True)


def is_empty(spark: SparkSession, path: str) -> bool:
    files, folder = filesystem(spark, path)
    return not len(files.listStatus(folder))


def delete_empty(spark: SparkSession, path: str, root: str) -> None:
    """Delete a folder, and those above it up to the root that are left empty."""
    delete_folder(spark, path)
    while (path := path.rsplit("/", 1)[0]) != root:
        if not is_empty(spark, path):
            return
        delete_folder(spark, path)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Store the rows in the shared folder and read them back.

    Unlike a cache this survives lost executors, and later passes read only the
    columns they need.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_once(df: DataFrame, path: str) -> DataFrame:
    """Store the rows at a path unless an earlier, unfinished run did so, and read them back."""
    spark = df.sparkSession
    if not is_complete(spark, path):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
