"""Column expressions shared by the operators; everything stays on the JVM side."""

from tidemark.functions.calendar import calendar_columns, date_key, moment
from tidemark.functions.labels import churn_band, product_category, product_label, rfm_code, rfm_segment
from tidemark.functions.numbers import as_cents, expose_money, from_cents, mean_cents, share_tenths, to_double
from tidemark.functions.text import clean_email, clean_name

__all__ = [
    "as_cents",
    "calendar_columns",
    "churn_band",
    "clean_email",
    "clean_name",
    "date_key",
    "expose_money",
    "from_cents",
    "mean_cents",
    "moment",
    "product_category",
    "product_label",
    "rfm_code",
    "rfm_segment",
    "share_tenths",
    "to_double",
]
