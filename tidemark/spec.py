"""Table contracts: key, columns, validation rules, and the fixed values they use."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Fixed values ---------------------------------------------------------------

ORDER_STATUSES = ["pending", "confirmed", "shipped", "delivered", "cancelled"]
CUSTOMER_TIERS = ["standard", "premium", "enterprise"]

OVERLAP_MINUTES = 15
UNKNOWN_KEY = -1
SCORE_BANDS = 5
HISTOGRAM_WIDTH = 30

CALENDAR_START = "2024-01-01"
CALENDAR_END = "2027-12-31"

PRODUCT_ID_FIRST = 1
PRODUCT_ID_LAST = 200

# (highest product id of the range, category, product label); the last row is open-ended
PRODUCT_RANGES = [
    (50, "Electronics", "Electronic Product"),
    (100, "Clothing", "Clothing Item"),
    (150, "Home & Kitchen", "Kitchen Product"),
    (None, "Books & Media", "Book or Media"),
]

# segment: condition on the three scores; the first that holds names the customer
RFM_SEGMENTS = {
    "Champions": "r_score >= 4 AND f_score >= 4",
    "New Customers": "r_score >= 4 AND f_score <= 2",
    "Potential Loyalists": "r_score >= 3 AND f_score >= 3 AND m_score >= 3",
    "Loyal Customers": "f_score >= 4",
    "At Risk": "r_score <= 2 AND f_score >= 3",
    "Cannot Lose Them": "r_score <= 2 AND f_score <= 2 AND m_score >= 3",
    "Lost": "r_score <= 2",
}
RFM_SEGMENT_OTHERWISE = "Hibernating"

# churn band: more than this many days since the last order
CHURN_BANDS = {"HIGH": 90, "MEDIUM": 30}
CHURN_OTHERWISE = "LOW"

# Table contracts ------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """One keyed table: its DDL, the key, and the ordered rules a row must pass.

    Rules map a name to a SQL condition; a condition that is false or null
    rejects the row.
    """

    name: str
    key: str
    ddl: str
    rules: dict[str, str] = field(default_factory=dict)
    changed_at: str = "updated_at"

    @cached_property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def conform(self, df: DataFrame) -> DataFrame:
        """Select the contract's columns in order, cast to the contract's types."""
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])


def _one_of(column: str, values: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


ORDERS = TableSpec(
    name="orders",
    key="order_id",
    ddl="order_id BIGINT, customer_id BIGINT, status STRING, total_amount DECIMAL(12,2), "
    "region STRING, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
    rules={
        "key_present": "order_id IS NOT NULL",
        "amount_positive": "total_amount > 0",
        "status_known": _one_of("status", ORDER_STATUSES),
    },
)

CUSTOMERS = TableSpec(
    name="customers",
    key="customer_id",
    ddl="customer_id BIGINT, email STRING, name STRING, region STRING, tier STRING, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
    rules={
        "key_present": "customer_id IS NOT NULL",
        "email_present": "email IS NOT NULL",
        "tier_known": _one_of("tier", CUSTOMER_TIERS),
    },
)

ORDER_ITEMS = TableSpec(
    name="order_items",
    key="item_id",
    ddl="item_id BIGINT, order_id BIGINT, product_id BIGINT, quantity INT, "
    "unit_price DECIMAL(12,2), created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ",
    rules={
        "key_present": "item_id IS NOT NULL",
        "quantity_positive": "quantity > 0",
        "price_positive": "unit_price > 0",
    },
)

SOURCE_TABLES = {t.name: t for t in (ORDERS, CUSTOMERS, ORDER_ITEMS)}

DIM_CUSTOMER = TableSpec(
    name="dim_customer",
    key="customer_key",
    ddl="customer_key BIGINT, customer_id BIGINT, name STRING, email STRING, region STRING, "
    "tier STRING, is_current BOOLEAN, effective_from TIMESTAMP_NTZ, dw_inserted_at TIMESTAMP_NTZ",
    changed_at="dw_inserted_at",
)

DIM_PRODUCT = TableSpec(
    name="dim_product",
    key="product_key",
    ddl="product_key BIGINT, product_id BIGINT, category STRING, product_name STRING, "
    "is_active BOOLEAN, dw_inserted_at TIMESTAMP_NTZ",
    changed_at="dw_inserted_at",
)

DIM_DATE = TableSpec(
    name="dim_date",
    key="date_key",
    ddl="date_key INT, full_date DATE, day_of_month INT, day_of_week INT, day_name STRING, "
    "week_of_year INT, month_number INT, month_name STRING, quarter INT, year INT, "
    "is_weekend BOOLEAN, is_weekday BOOLEAN",
    changed_at="full_date",
)

FACT_ORDERS = TableSpec(
    name="fact_orders",
    key="order_key",
    ddl="order_key BIGINT, order_id BIGINT, customer_key BIGINT, date_key INT, status STRING, "
    "total_amount DECIMAL(12,2), item_count BIGINT, region STRING, created_at TIMESTAMP_NTZ, "
    "updated_at TIMESTAMP_NTZ, dw_inserted_at TIMESTAMP_NTZ",
)

FACT_ORDER_ITEMS = TableSpec(
    name="fact_order_items",
    key="item_key",
    ddl="item_key BIGINT, item_id BIGINT, order_id BIGINT, customer_key BIGINT, "
    "product_key BIGINT, date_key INT, quantity INT, unit_price DECIMAL(12,2), "
    "line_total DECIMAL(18,2), created_at TIMESTAMP_NTZ, dw_inserted_at TIMESTAMP_NTZ",
    changed_at="dw_inserted_at",
)

MART = TableSpec(
    name="customer_mart",
    key="customer_key",
    ddl="customer_key BIGINT, customer_id BIGINT, name STRING, email STRING, region STRING, "
    "tier STRING, first_order_date TIMESTAMP_NTZ, last_order_date TIMESTAMP_NTZ, "
    "recency_days INT, total_orders BIGINT, total_spent DECIMAL(18,2), "
    "avg_order_value DECIMAL(18,2), total_items BIGINT, r_score INT, f_score INT, m_score INT, "
    "rfm_score STRING, rfm_segment STRING, churn_risk STRING, pipeline_updated_at TIMESTAMP_NTZ",
    changed_at="pipeline_updated_at",
)

# Kept beside the facts, so that a batch changes only the totals of its customers.
CUSTOMER_TOTALS = TableSpec(
    name="customer_totals",
    key="customer_key",
    ddl="customer_key BIGINT, first_order_date TIMESTAMP_NTZ, last_order_date TIMESTAMP_NTZ, "
    "total_orders BIGINT, cents BIGINT, total_items BIGINT",
    changed_at="last_order_date",
)

# Gold tables that are merged by key on each run; the mart is replaced whole.
GOLD_TABLES = {t.name: t for t in (DIM_CUSTOMER, DIM_PRODUCT, DIM_DATE, FACT_ORDERS, FACT_ORDER_ITEMS)}

CONTROL = TableSpec(
    name="control",
    key="pipeline_name",
    ddl="pipeline_name STRING, last_watermark TIMESTAMP_NTZ, last_run_at TIMESTAMP_NTZ, status STRING",
    changed_at="last_run_at",
)
