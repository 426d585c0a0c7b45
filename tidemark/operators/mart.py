"""Customer profile, scores, segments and the reports over them."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions import churn_band, from_cents, mean_cents, rfm_code, rfm_segment, share_tenths
from tidemark.operators.dimensions import load_time
from tidemark.operators.ranking import RFM_MEASURES, PICK_ROWS, percentile_scores, tile_scores
from tidemark.operators.totals import customer_totals
from tidemark.sources.shared import materialize

CUSTOMER_ATTRIBUTES = ["customer_id", "name", "email", "region", "tier"]


def profile_of_totals(
    totals: DataFrame, customers: DataFrame, as_of: date, keep_unknown: bool = False
) -> DataFrame:
    """The order history of customers whose totals are known; customers without orders are left out.

    The unknown member is dropped, or kept with null attributes.
    """
    held = totals.filter("total_orders > 0")
    if not keep_unknown:
        held = held.filter(F.col("customer_key") != spec.UNKNOWN_KEY)
    attributes = customers.select("customer_key", *CUSTOMER_ATTRIBUTES)
    joined = held.join(attributes, "customer_key", "left" if keep_unknown else "inner")
    return joined.select(
        "customer_key",
        *CUSTOMER_ATTRIBUTES,
        "first_order_date",
        "last_order_date",
        F.datediff(F.lit(as_of), "last_order_date").alias("recency_days"),
        "total_orders",
        from_cents(F.col("cents")).alias("total_spent"),
        from_cents(mean_cents(F.col("cents"), F.col("total_orders"))).alias("avg_order_value"),
        "total_items",
    )


def customer_profile(
    orders: DataFrame, customers: DataFrame, as_of: date, keep_unknown: bool = False
) -> DataFrame:
    """Order history per customer, one row per customer with an order.

    The facts are aggregated by surrogate key first and only then meet the
    customer attributes, which are never grouped on.
    """
    return profile_of_totals(customer_totals(orders), customers, as_of, keep_unknown)


def score_profile(profile: DataFrame, method: str = "tiles", pick_rows: int = PICK_ROWS) -> DataFrame:
    """The profile with ``r_score``, ``f_score`` and ``m_score``.

    ``tiles`` cuts five equal groups, ``percentile`` rounds the percentile rank.
    The profile is stored once, because finding the cut rows reads it more than once.
    """
    scorers = {"tiles": tile_scores, "percentile": percentile_scores}
    stored = materialize(profile, "customer_profile")
    return scorers[method](stored, "customer_key", RFM_MEASURES, stored.count(), pick_rows=pick_rows)


def mart_of_profile(
    profile: DataFrame, run_ts: datetime | None = None, method: str = "tiles", pick_rows: int = PICK_ROWS
) -> DataFrame:
    """The flat customer mart: profile, scores, segment and churn band."""
    return spec.MART.conform(
        score_profile(profile, method, pick_rows).withColumns(
            {
                "rfm_score": rfm_code(),
                "rfm_segment": rfm_segment(),
                "churn_risk": churn_band(F.col("recency_days")),
                "pipeline_updated_at": load_time(run_ts),
            }
        )
    )


def build_mart(
    orders: DataFrame,
    customers: DataFrame,
    as_of: date,
    run_ts: datetime | None = None,
    method: str = "tiles",
    keep_unknown: bool = False,
    pick_rows: int = PICK_ROWS,
) -> DataFrame:
    """The mart of the facts and the customers."""
    return mart_of_profile(customer_profile(orders, customers, as_of, keep_unknown), run_ts, method, pick_rows)


def mart_metrics(mart: DataFrame) -> DataFrame:
    """Validation figures of the mart, one row per metric, from one pass."""
    days, n = F.sum("recency_days"), F.count(F.lit(1))
    counted = mart.agg(
        n.alias("customers"),
        F.when(n > 0, share_tenths(days, n, scale=1)).alias("recency"),
        F.count(F.when(F.col("churn_risk") == "HIGH", 1)).alias("high"),
        F.count(F.when(F.col("rfm_segment") == "Champions", 1)).alias("champions"),
    )
    labels = {
        "Total customers": "customers",
        "Avg recency days": "recency",
        "HIGH churn risk count": "high",
        "Champions count": "champions",
    }
    rows = [
        F.struct(F.lit(label).alias("metric"), F.col(c).cast("double").alias("value"))
        for label, c in labels.items()
    ]
    return counted.select(F.inline(F.array(*rows)))


def distribution(mart: DataFrame, label: str, width: int = spec.HISTOGRAM_WIDTH) -> DataFrame:
    """Customers per label, their share in percent and as a text bar, largest first.

    The total is a window over the grouped rows, of which there are at most
    as many as labels.
    """
    per_label = mart.groupBy(label).agg(F.count(F.lit(1)).alias("customers"))
    total = F.sum("customers").over(Window.partitionBy())
    n = F.col("customers")
    return (
        per_label.withColumn("total", total)
        .select(
            label,
            "customers",
            share_tenths(n, F.col("total")).alias("pct"),
            F.repeat(F.lit("#"), F.call_function("div", n * width, F.col("total")).cast("int")).alias("bar"),
        )
        .orderBy(F.desc("customers"), label)
    )
