"""Calendar expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(at: datetime, column_type: str = "timestamp_ntz") -> Column:
    """A naive timestamp as a literal.

    It goes through its text form: a datetime literal would first be read in
    the driver's local time zone.
    """
    return F.lit(at.isoformat(sep=" ")).cast(column_type)


def date_key(ts: Column) -> Column:
    """The day of a timestamp or date as an integer yyyymmdd."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def calendar_columns(day: Column, iso_weekday: bool = False) -> dict[str, Column]:
    """The attributes of one calendar day; weekdays count from Sunday = 1, or ISO Monday = 1."""
    weekend = F.dayofweek(day).isin(1, 7)
    return {
        "date_key": date_key(day),
        "full_date": day,
        "day_of_month": F.dayofmonth(day),
        "day_of_week": F.weekday(day) + 1 if iso_weekday else F.dayofweek(day),
        "day_name": F.date_format(day, "EEEE"),
        "week_of_year": F.weekofyear(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "is_weekend": weekend,
        "is_weekday": ~weekend,
    }
