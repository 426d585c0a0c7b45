"""Comparing tables by key range: sums of row hashes first, rows only where these differ.

A range's fingerprint is its number of rows and the sums of two hashes of each
row, in halves so that they cannot overflow. Sums do not depend on the order of
the rows, and unlike a bitwise combination they tell how often a row is repeated.
Only ranges and sums are shuffled, never rows. Where ranges are many, a bounded number
of buckets is compared first: ranges in buckets that are the same need only be counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.upsert import free_name
from tidemark.sources.shared import materialize

RANGE_KEYS = 1_000_000
BUCKETS = 4096
_SUMS = ["rows", "a_low", "a_high", "b_low", "b_high"]


def row_hash(columns: Sequence[str], seed: int = 1) -> Column:
    """A 64-bit hash of a row; which of its columns are null is hashed with the values."""
    return F.xxhash64(F.lit(seed), *columns, F.array(*[F.col(c).isNull() for c in columns]))


def _row_hashes(df: DataFrame, ignore: Sequence[str]) -> list[Column]:
    columns = sorted(c for c in df.columns if c not in ignore)
    return [row_hash(columns, seed) for seed in (1, 2)]


def key_range(key: str, span: int) -> Column:
    """The range of a whole-number key; rows without a key are in none."""
    return F.call_function("div", F.col(key).cast("long"), F.lit(span))


def bucket_of(*columns: str | Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BUCKETS)).cast("int")


def _fingerprints(df: DataFrame, part: Column, name: str, ignore: Sequence[str]) -> DataFrame:
    a, b = _row_hashes(df, ignore)
    hashed = df.select(part.alias(name), a.alias("a"), b.alias("b"))
    low = F.lit((1 << 32) - 1).cast("long")
    return hashed.groupBy(name).agg(
        F.count(F.lit(1)).alias("rows"),
        *[
            F.sum(half).alias(f"{hash_}_{half_name}")
            for hash_ in ("a", "b")
            for half_name, half in (("low", F.col(hash_).bitwiseAND(low)), ("high", F.shiftright(hash_, 32).cast("long")))
        ],
    )


def range_fingerprints(df: DataFrame, key: str, span: int = RANGE_KEYS, ignore: Sequence[str] = ()) -> DataFrame:
    """``key_range`` with the number of its rows and the sums of their hashes."""
    return _fingerprints(df, key_range(key, span), "key_range", ignore)


def _compared(one: DataFrame, other: DataFrame, name: str) -> DataFrame:
    """The fingerprints of two tables side by side: rows in both and whether they are the same."""
    joined = one.alias("one").join(other.alias("other"), F.col(f"one.{name}").eqNullSafe(F.col(f"other.{name}")), "full_outer")
    same = F.lit(True)
    for column in _SUMS:
        same &= F.col(f"one.{column}").eqNullSafe(F.col(f"other.{column}"))
    return joined.select(
        F.coalesce(f"one.{name}", f"other.{name}").alias(name),
        F.coalesce("one.rows", F.lit(0)).alias("first_rows"),
        F.coalesce("other.rows", F.lit(0)).alias("second_rows"),
        same.alias("same"),
    )


def compared_buckets(first: DataFrame, second: DataFrame, bucket: Column, ignore: Sequence[str] = ()) -> DataFrame:
    """``bucket, first_rows, second_rows, same`` of each bucket, stored; a bounded number of rows."""
    prints = [_fingerprints(df, bucket, "bucket", ignore) for df in (first, second)]
    return materialize(_compared(*prints, "bucket"), "buckets")


def within(df: DataFrame, bucket: Column, buckets: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows in the buckets given, or with ``left_anti`` the others."""
    name = free_name(df, "bucket")
    return df.join(buckets.select(F.col("bucket").alias(name)), bucket == F.col(name), how)


def differing_ranges(
    first: DataFrame, second: DataFrame, key: str, span: int = RANGE_KEYS, ignore: Sequence[str] = ()
) -> DataFrame:
    """Every range of either table: its rows in both and whether the fingerprints are the same.

    Ranges in buckets that are the same have their rows counted on one side; the
    others are compared one by one.
    """
    part = key_range(key, span)
    differing = compared_buckets(first, second, bucket_of(part), ignore).filter(~F.col("same")).select("bucket")
    if differing.isEmpty():
        return _same_ranges(first.select(part.alias("key_range")))
    same = _same_ranges(within(first.select(part.alias("key_range")), bucket_of("key_range"), differing, "left_anti"))
    inside = [within(df, bucket_of(part), differing) for df in (first, second)]
    one, other = (range_fingerprints(df, key, span, ignore) for df in inside)
    return same.unionByName(_compared(one, other, "key_range"))


def _same_ranges(ranged: DataFrame) -> DataFrame:
    counted = ranged.groupBy("key_range").agg(F.count(F.lit(1)).alias("first_rows"))
    return counted.select("key_range", "first_rows", F.col("first_rows").alias("second_rows"), F.lit(True).alias("same"))


def differing_keys(
    first: DataFrame,
    second: DataFrame,
    key: str,
    span: int = RANGE_KEYS,
    ignore: Sequence[str] = (),
    ranges: DataFrame | None = None,
) -> DataFrame:
    """``key, first_rows, second_rows, difference`` of the keys whose rows differ.

    Only rows of ``ranges`` that are not the same are looked at, as key and hashes.
    A key is ``lost``, ``new``, ``repeated`` (the same row, not equally often) or
    ``changed``. Keys that are null count as one.
    """
    if ranges is None:
        ranges = differing_ranges(first, second, key, span, ignore)
    wanted = ranges.filter(~F.col("same")).select(F.col("key_range").alias("wanted"))

    def hashed(df: DataFrame, side: int) -> DataFrame:
        a, b = _row_hashes(df, ignore)
        rows = df.select(F.col(key).alias("key"), a.alias("a"), b.alias("b"), key_range(key, span).alias("key_range"))
        inside = rows.join(wanted, F.col("key_range").eqNullSafe(F.col("wanted")), "left_semi")
        return inside.select("key", "a", "b", F.lit(side).alias("side"))

    both = hashed(first, 0).unionByName(hashed(second, 1))
    held = both.groupBy("key", "a", "b").agg(
        F.sum(F.when(F.col("side") == 0, 1).otherwise(0)).alias("n0"), F.sum("side").alias("n1")
    )
    per_key = held.groupBy("key").agg(
        F.sum("n0").alias("first_rows"),
        F.sum("n1").alias("second_rows"),
        F.count(F.when(F.col("n0") != F.col("n1"), 1)).alias("uneven"),
        F.count(F.when((F.col("n0") == 0) | (F.col("n1") == 0), 1)).alias("one_sided"),
    )
    difference = (
        F.when(F.col("second_rows") == 0, "lost")
        .when(F.col("first_rows") == 0, "new")
        .when(F.col("one_sided") == 0, "repeated")
        .otherwise("changed")
    )
    found = per_key.filter("uneven > 0").withColumn("difference", difference)
    return found.select(F.col("key").alias(key), "first_rows", "second_rows", "difference")
