"""Retail source tables derived from the TPC-H-like test tables.

The derivation plants the faults the rules look for: missing e-mails, an
unknown tier, negative amounts, an unknown status, zero quantities, several
rows per item key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_schemas: dict[str, StructType] = {}


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One test table; its schema is read from the file footer once per process."""
    path = f"{folder}/{table}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _regions(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = load(spark, folder, "nation"), load(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")


def _day(offset: Column) -> Column:
    return F.date_add(F.lit("1995-01-01").cast("date"), offset.cast("int")).cast("timestamp_ntz")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    tier = (
        F.when(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"), "standard")
        .when(F.col("c_mktsegment") == "MACHINERY", "premium")
        .when(F.col("c_mktsegment") == "HOUSEHOLD", "enterprise")
        .otherwise("trial")
    )
    joined = load(spark, folder, "customer").join(
        _regions(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.select(
        key.alias("customer_id"),
        F.when(key % 53 != 0, F.concat(F.lit("  "), F.upper("c_name"), F.lit("@Example.com "))).alias("email"),
        F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("name"),
        F.col("r_name").alias("region"),
        tier.alias("tier"),
        _day(key % 120).alias("created_at"),
        _day(key % 120 + key % 60).alias("updated_at"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    priority = F.substring("o_orderpriority", 1, 1)
    status = (
        F.when(key % 97 == 0, "bad_status")
        .when(priority == "1", "pending")
        .when(priority == "2", "confirmed")
        .when(priority == "3", "shipped")
        .when(priority == "4", "delivered")
        .otherwise("cancelled")
    )
    amount = F.when(key % 101 == 0, -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    homes = (
        load(spark, folder, "customer")
        .join(_regions(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "r_name")
    )
    return (
        load(spark, folder, "orders")
        .join(homes, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key.alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            status.alias("status"),
            amount.cast("decimal(12,2)").alias("total_amount"),
            F.col("r_name").alias("region"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
        )
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    quantity = F.when(F.col("l_suppkey") % 41 == 0, 0).otherwise(F.col("l_quantity"))
    return load(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        quantity.cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("updated_at"),
    )


SOURCES = {"orders": orders, "customers": customers, "order_items": order_items}


def sources(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """The named source tables, all of them by default."""
    return {name: SOURCES[name](spark, folder) for name in names or SOURCES}
