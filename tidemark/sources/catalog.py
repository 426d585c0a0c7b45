"""Catalog tables: schemas, external raw tables, typed tables, bucketed layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.spec import TableSpec


def use_schema(spark: SparkSession, schema: str, catalog: str | None = None, location: str | None = None) -> None:
    """Make a schema current, creating it if absent; its tables lie at the location, the warehouse by default."""
    if catalog is not None:
        spark.catalog.setCurrentCatalog(catalog)
    place = "" if location is None else f" LOCATION '{location}'"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`{place}")
    spark.catalog.setCurrentDatabase(schema)


def register_parquet(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Register Parquet files as an external table with the partitions found there, unless the name is taken."""
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` USING PARQUET OPTIONS (path '{path}')")
        if any(column.isPartition for column in spark.catalog.listColumns(name)):
            spark.catalog.recoverPartitions(name)
    return spark.table(name)


def create_typed(spark: SparkSession, name: str, table: TableSpec, comment: str = "", provider: str = "parquet") -> None:
    """Create an empty table with the contract's types and a NOT NULL key, unless it exists."""
    columns = [
        f"`{f.name}` {f.dataType.simpleString()}" + (" NOT NULL" if f.name == table.key else "")
        for f in table.schema
    ]
    text = comment.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` ({', '.join(columns)}) USING {provider} COMMENT '{text}'")


def create_as(df: DataFrame, name: str) -> bool:
    """Create a table from the rows, unless it exists; tells whether it was created."""
    if df.sparkSession.catalog.tableExists(name):
        return False
    df.write.saveAsTable(name)
    return True


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Replace a table, bucketed and sorted by ``key``.

    Tables bucketed alike on their join key join and aggregate on it without a
    shuffle: orders and order items on ``order_id``, for example. Rows are
    moved to their bucket first, so each bucket is one file.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)
