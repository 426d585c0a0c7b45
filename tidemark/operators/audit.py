"""Counts and comparisons that prove what a run did."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tidemark.functions import share_tenths
from tidemark.operators.fingerprints import bucket_of, compared_buckets, row_hash, within


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def with_total(counts: DataFrame, label: str = "table_name", value: str = "row_count") -> DataFrame:
    """Labelled counts plus a row ``total``."""
    total = counts.agg(F.coalesce(F.sum(value), F.lit(0)).alias(value))
    return counts.unionByName(total.select(F.lit("total").alias(label), value))


def figures(counts: DataFrame, names: Sequence[str]) -> DataFrame:
    """Labelled counts as one row with a column per label, 0 where a label is missing."""
    return counts.agg(
        *[
            F.coalesce(F.sum(F.when(F.col("table_name") == n, F.col("row_count"))), F.lit(0)).alias(n)
            for n in names
        ]
    )


def highest_key(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.max(key).alias(key))


def change_bounds(tables: Iterable[DataFrame], changed_at: str) -> tuple[datetime, datetime]:
    """The first and the last change of all the tables; one row reaches the driver."""
    times = reduce(DataFrame.unionByName, [df.select(F.col(changed_at).cast("timestamp").alias("at")) for df in tables])
    return tuple(times.agg(F.min("at"), F.max("at")).first())


def reduction(counts: DataFrame) -> DataFrame:
    """``source_rows`` and ``window_rows`` with the share the window left out and the verdict."""
    left_out = F.col("source_rows") - F.col("window_rows")
    return counts.withColumns(
        {
            "reduction_pct": F.when(F.col("source_rows") > 0, share_tenths(left_out, F.col("source_rows"))),
            "incremental": F.col("window_rows") < F.col("source_rows"),
        }
    )


def extract_reduction(source: DataFrame, window: DataFrame) -> DataFrame:
    """How much smaller an incremental window is than its source, judged on rows."""
    names = ["source_rows", "window_rows"]
    return reduction(figures(row_counts({"source_rows": source, "window_rows": window}), names))


def differing_rows(left: DataFrame, right: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Distinct rows that the two tables do not hold equally often, with the surplus of each side.

    Rows are counted before the shuffle, so repeated rows cost nothing, and one
    grouping answers both directions.
    """
    columns = [c for c in left.columns if c not in ignore]
    both = left.select(*columns, F.lit(1).alias("_side")).unionByName(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    return both.groupBy(*columns).agg(F.sum("_side").alias("surplus")).filter(F.col("surplus") != 0)


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: the rows of both tables and how many differ.

    Rows fall into a bounded number of buckets by their hash. Buckets with the same
    fingerprint hold the same rows; the rows of the others are compared themselves.
    """
    buckets = compared_buckets(left, right, bucket := bucket_of(row_hash(left.columns, seed=3)))
    unequal = buckets.filter(~F.col("same")).select("bucket")
    held = buckets.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("first_rows", "second_rows")])
    if unequal.isEmpty():
        return held.withColumn("rows_differing", F.lit(0).cast("long"))
    return held.join(_surplus(*[within(df, bucket, unequal) for df in (left, right)]))


def _surplus(left: DataFrame, right: DataFrame) -> DataFrame:
    return differing_rows(left, right).agg(F.coalesce(F.sum(F.abs("surplus")), F.lit(0)).alias("rows_differing"))


def compare(
    first: Mapping[str, DataFrame], second: Mapping[str, DataFrame], ignore: Sequence[str] = ()
) -> DataFrame:
    """Per table: rows of both runs, rows that differ, and whether the runs are identical.

    A hash does not tell where values within values are null, so tables with nested
    columns are compared row by row.
    """
    names = ["first_rows", "second_rows", "rows_differing"]
    report = []
    for table in first:
        columns = [c for c in first[table].columns if c not in ignore]
        left, right = first[table].select(*columns), second[table].select(*columns)
        if columns and all(isinstance(f.dataType, AtomicType) for f in (*left.schema, *right.schema)):
            found = _differing(left, right)
        else:
            counts = row_counts({"first_rows": left, "second_rows": right})
            found = figures(counts, names[:2]).join(_surplus(left, right))
        report.append(
            found.select(F.lit(table).alias("table_name"), *names)
            .withColumn("identical", F.col("rows_differing") == 0)
        )
    return reduce(DataFrame.unionByName, report)
