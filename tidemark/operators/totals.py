"""Order totals per customer, kept up by what changed in the facts.

Counts and sums are taken back by subtraction. A first or last date can only be
taken back where other orders take its place, so it is looked up again in the
facts, for the customers alone who lost theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_cents


def customer_totals(orders: DataFrame) -> DataFrame:
    """First and last order, number, cents and items of the orders of each customer key.

    Aggregated before any shuffle, so a hot key (the unknown member in particular)
    is one row per task.
    """
    return orders.groupBy("customer_key").agg(
        F.min("created_at").alias("first_order_date"),
        F.max("created_at").alias("last_order_date"),
        F.count("order_key").alias("total_orders"),
        F.sum(as_cents(F.col("total_amount"))).alias("cents"),
        F.sum("item_count").alias("total_items"),
    )


def whole_totals(totals: DataFrame, held: DataFrame) -> DataFrame:
    """The totals, and a total of 0 for every customer who was held and has no orders now."""
    gone = held.select("customer_key").join(totals, "customer_key", "left_anti")
    return totals.unionByName(gone.withColumns({c: F.lit(0) for c in ("total_orders", "cents", "total_items")}), allowMissingColumns=True)


def totals_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """What replacing the fact rows ``before`` by the rows ``after`` does to each customer's totals.

    The dates of the rows taken away and of those put in stay apart.
    """
    needed = ["customer_key", "order_key", "created_at", "total_amount", "item_count"]
    signed = after.select(*needed, F.lit(1).alias("_sign")).unionByName(before.select(*needed, F.lit(-1).alias("_sign")))
    sign, added, removed = F.col("_sign"), F.col("_sign") == 1, F.col("_sign") == -1
    return signed.groupBy("customer_key").agg(
        F.sum(F.when(F.col("order_key").isNotNull(), sign).otherwise(0)).alias("orders_change"),
        F.sum(sign * as_cents(F.col("total_amount"))).alias("cents_change"),
        F.sum(sign * F.col("item_count")).alias("items_change"),
        F.min(F.when(added, F.col("created_at"))).alias("added_first"),
        F.max(F.when(added, F.col("created_at"))).alias("added_last"),
        F.min(F.when(removed, F.col("created_at"))).alias("removed_first"),
        F.max(F.when(removed, F.col("created_at"))).alias("removed_last"),
    )


def _lost(stored: Column, removed: Column, added: Column, reaches: Column) -> Column:
    """Whether the row that held the date is gone and no new row takes its place."""
    gone = removed.isNotNull() & (stored.isNull() | (removed == stored))
    return gone & (added.isNull() | ~F.coalesce(reaches, F.lit(False)))


def apply_delta(stored: DataFrame, delta: DataFrame, orders: DataFrame) -> DataFrame:
    """The new totals of the customers of the delta; ``orders`` are the facts after the change.

    A customer without orders left has a total of 0 and no dates.
    """
    old = stored.select("customer_key", "first_order_date", "last_order_date", "total_orders", "cents", "total_items")
    joined = delta.join(old, "customer_key", "left").withColumns(
        {
            name: F.coalesce(name, F.lit(0)) + F.coalesce(change, F.lit(0))
            for name, change in (("total_orders", "orders_change"), ("cents", "cents_change"), ("total_items", "items_change"))
        }
    )
    first, last = F.col("first_order_date"), F.col("last_order_date")
    lost = _lost(first, F.col("removed_first"), F.col("added_first"), F.col("added_first") <= first)
    lost |= _lost(last, F.col("removed_last"), F.col("added_last"), F.col("added_last") >= last)
    marked = joined.withColumn("lost", lost & (F.col("total_orders") > 0))
    dates = orders.join(marked.filter("lost").select("customer_key"), "customer_key", "left_semi").groupBy("customer_key")
    found = dates.agg(F.min("created_at").alias("found_first"), F.max("created_at").alias("found_last"))
    some = F.col("total_orders") > 0
    return marked.join(found, "customer_key", "left").select(
        "customer_key",
        F.when(some, F.when(F.col("lost"), F.col("found_first")).otherwise(F.least(first, "added_first"))).alias("first_order_date"),
        F.when(some, F.when(F.col("lost"), F.col("found_last")).otherwise(F.greatest(last, "added_last"))).alias("last_order_date"),
        "total_orders",
        "cents",
        "total_items",
    )
