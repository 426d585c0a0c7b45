"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _key_columns(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def latest_by_key(df: DataFrame, key: str | Sequence[str], changed_at: str = "updated_at") -> DataFrame:
    """Keep one row per key: row number 1 by ``changed_at`` descending, nulls last.

    Equal timestamps are settled by all remaining columns in order, descending,
    so the result does not depend on the order the rows arrive in.

    That row is the greatest struct (changed_at, remaining columns...) of its
    key. As an aggregate it is reduced to one row per key and map task before
    the shuffle, which makes a hot key harmless, and rows are sorted by the key
    alone, which is cheaper than a window's sort by key and all columns.
    """
    keys = _key_columns(key)
    ordering = [changed_at] + [c for c in df.columns if c not in keys and c != changed_at]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*ordering)).alias("_newest"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_newest.{c}") for c in df.columns])


def duplicate_counts(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows in, rows kept and rows removed by keeping one row per key."""
    per_key = df.groupBy(*_key_columns(key)).agg(F.count(F.lit(1)).alias("n"))
    total, kept = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return per_key.agg(
        total.alias("rows_in"), kept.alias("rows_kept"), (total - kept).alias("rows_removed")
    )
