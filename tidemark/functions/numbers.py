"""Exact money arithmetic.

Sums and means run on whole cents held in BIGINT: this keeps aggregation
buffers fixed-width and codegen-friendly, and the half-up mean is exact.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def as_cents(amount: Column) -> Column:
    return (amount * 100).cast("bigint")


def from_cents(cents: Column) -> Column:
    """Cents as a decimal of 18 digits, the most that are compared as a single long."""
    return (cents.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def _half_up(top: Column, bottom: Column) -> Column:
    """top / bottom to the nearest whole number, halves up; both are positive whole numbers."""
    return F.call_function("div", top * 2 + bottom, bottom * 2)


def mean_cents(cents: Column, n: Column) -> Column:
    """Mean of positive cents, rounded half up."""
    return _half_up(cents, n)


def share_tenths(part: Column, total: Column, scale: int = 100) -> Column:
    """``scale * part / total`` to one decimal, rounded half up on whole tenths."""
    return _half_up(part * (10 * scale), total) / F.lit(10.0)


def to_double(amount: Column) -> Column:
    return amount.cast("double")


def expose_money(df: DataFrame) -> DataFrame:
    """Decimal columns as DOUBLE, for readers that expect floating-point money."""
    return df.select(
        *[
            to_double(F.col(f.name)).alias(f.name) if isinstance(f.dataType, DecimalType) else F.col(f.name)
            for f in df.schema
        ]
    )
