"""Attribute clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(name: Column) -> Column:
    return F.trim(name)


def clean_email(email: Column) -> Column:
    return F.lower(F.trim(email))
