"""Fact builders: surrogate keys, unknown members, derived measures."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions import as_cents, date_key, expose_money, from_cents
from tidemark.operators.dimensions import load_time


def or_unknown(key: str) -> Column:
    return F.coalesce(F.col(key), F.lit(spec.UNKNOWN_KEY).cast("bigint"))


def item_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("order_id").agg(F.count(F.lit(1)).alias("item_count"))


def resolve_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the surrogate key of their customer, the unknown member where there is none.

    The customer dimension grows with the business, so no broadcast is forced:
    adaptive execution broadcasts it while it is small and splits a hot
    customer's orders when it is not.
    """
    keys = customers.select("customer_id", "customer_key")
    return orders.join(keys, "customer_id", "left").withColumn("customer_key", or_unknown("customer_key"))


def fact_orders(
    orders: DataFrame, items: DataFrame, customers: DataFrame, run_ts: datetime | None = None
) -> DataFrame:
    """One row per order with customer key, date key and the number of its items.

    The item counts are joined first: orders that come from a deduplication or
    a bucketed table already lie by ``order_id``, so only the customer join
    moves them.
    """
    counted = orders.join(item_counts(items), "order_id", "left")
    return resolve_customer(counted, customers).select(
        F.col("order_id").alias("order_key"),
        "order_id",
        "customer_key",
        date_key(F.col("created_at")).alias("date_key"),
        "status",
        "total_amount",
        F.coalesce("item_count", F.lit(0)).cast("bigint").alias("item_count"),
        "region",
        "created_at",
        "updated_at",
        load_time(run_ts).alias("dw_inserted_at"),
    )


def fact_order_items(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    run_ts: datetime | None = None,
) -> DataFrame:
    """One row per order line with customer, product and date keys and the line total.

    The customer is resolved on the orders, before they meet the items: there
    are fewer orders than lines, so the large side is shuffled once, on the
    order. Products are a few hundred rows by default; their known size lets
    the planner broadcast them, and a far larger range would be shuffled.
    """
    order_customer = resolve_customer(orders.select("order_id", "customer_id"), customers)
    product_keys = products.select("product_id", "product_key")
    joined = items.join(order_customer.select("order_id", "customer_key"), "order_id", "left").join(
        product_keys, "product_id", "left"
    )
    line_cents = as_cents(F.col("unit_price")) * F.col("quantity")
    return joined.select(
        F.col("item_id").alias("item_key"),
        "item_id",
        "order_id",
        or_unknown("customer_key").alias("customer_key"),
        or_unknown("product_key").alias("product_key"),
        date_key(F.col("created_at")).alias("date_key"),
        "quantity",
        "unit_price",
        from_cents(line_cents).alias("line_total"),
        "created_at",
        load_time(run_ts).alias("dw_inserted_at"),
    )


def unresolved_counts(fact: DataFrame, fact_name: str, keys: list[str]) -> DataFrame:
    """Rows per surrogate key that point at the unknown member, in one pass over the fact."""
    counted = fact.agg(*[F.count(F.when(F.col(k) == spec.UNKNOWN_KEY, 1)).alias(k) for k in keys])
    rows = F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(k).alias("unresolved")) for k in keys])
    return counted.select(F.lit(fact_name).alias("fact"), F.inline(rows))


def by_calendar(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Orders, items and revenue per month.

    Facts are summed to one row per day before the calendar is joined.
    """
    daily = orders.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("item_count").alias("items"),
        F.sum(as_cents(F.col("total_amount"))).alias("cents"),
    )
    monthly = (
        daily.join(dates, "date_key")
        .groupBy("year", "quarter", "month_number", "month_name")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("items").alias("items"),
            F.sum(F.when(F.col("is_weekend"), F.col("orders")).otherwise(0)).alias("weekend_orders"),
            from_cents(F.sum("cents")).alias("revenue"),
        )
    )
    return expose_money(monthly)
