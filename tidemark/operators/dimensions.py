"""Dimension builders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions import calendar_columns, clean_email, clean_name, moment, product_category, product_label


def load_time(run_ts: datetime | None) -> Column:
    """The load timestamp of a run, without time zone; the current time by default."""
    return F.current_timestamp().cast("timestamp_ntz") if run_ts is None else moment(run_ts)


def dim_customer(customers: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Current state of each customer (SCD type 1); the natural key serves as surrogate."""
    return customers.select(
        F.col("customer_id").alias("customer_key"),
        "customer_id",
        clean_name(F.col("name")).alias("name"),
        clean_email(F.col("email")).alias("email"),
        "region",
        "tier",
        F.lit(True).alias("is_current"),
        F.col("created_at").alias("effective_from"),
        load_time(run_ts).alias("dw_inserted_at"),
    )


def dim_product(
    spark: SparkSession,
    first_id: int = spec.PRODUCT_ID_FIRST,
    last_id: int = spec.PRODUCT_ID_LAST,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Products generated from an id range, since there is no product source."""
    product, partitions = F.col("id"), 1 + (last_id - first_id) // 1_000_000
    return spark.range(first_id, last_id + 1, numPartitions=partitions).select(
        product.alias("product_key"),
        product.alias("product_id"),
        product_category(product).alias("category"),
        product_label(product).alias("product_name"),
        F.lit(True).alias("is_active"),
        load_time(run_ts).alias("dw_inserted_at"),
    )


def calendar(bounds: DataFrame, iso_weekday: bool = False) -> DataFrame:
    """One row per day between ``first_day`` and ``last_day`` of a one-row frame."""
    days = bounds.filter(F.col("first_day").isNotNull() & F.col("last_day").isNotNull()).select(
        F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("day")
    )
    parts = calendar_columns(F.col("day"), iso_weekday)
    return days.select(*[part.cast(spec.DIM_DATE.schema[name].dataType).alias(name) for name, part in parts.items()])


def dim_date(
    spark: SparkSession,
    start: str = spec.CALENDAR_START,
    end: str = spec.CALENDAR_END,
    iso_weekday: bool = False,
) -> DataFrame:
    """Calendar between two dates, both included."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day")
    )
    return calendar(bounds, iso_weekday)


def date_span(df: DataFrame, column: str) -> DataFrame:
    """First and last day of a column, widened to whole years, as input for ``calendar``."""
    lowest, highest = F.min(column), F.max(column)
    return df.agg(
        F.make_date(F.year(lowest), F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(F.year(highest), F.lit(12), F.lit(31)).alias("last_day"),
    )
