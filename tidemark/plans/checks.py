"""Jobs that prove a lakehouse is incremental, idempotent and free of bad rows."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions import moment
from tidemark.operators.audit import compare, figures, highest_key, reduction, row_counts
from tidemark.operators.fingerprints import RANGE_KEYS, differing_ranges
from tidemark.operators.quality import leaked, rejected
from tidemark.plans import jobs, layers
from tidemark.plans.jobs import Lakehouse
from tidemark.sources.raw import read_raw, write_batch
from tidemark.sources.shared import materialize

LOAD_TIMES = ["dw_inserted_at", "pipeline_updated_at"]

# The injected orders. Offset from the highest order id, customer,
# status, amount, region, and whether the row is bad.
INJECTED = [
    (1, 1, "confirmed", "-99.00", "North", True),
    (2, 2, "bad_status", "100.00", "East", True),
    (3, 3, "confirmed", "150.00", "West", False),
]


def incremental(
    spark: SparkSession, house: Lakehouse, sources: Mapping[str, DataFrame], pipeline: str, batch_end: datetime
) -> DataFrame:
    """Run one extraction and set what it read against the sources, per table, judged on rows."""
    rows = jobs.extract(spark, house, sources, pipeline, batch_end).rows
    landed = spark.createDataFrame(list(rows.items()), "table_name string, window_rows long")
    held = row_counts(sources).withColumnRenamed("row_count", "source_rows")
    return reduction(held.join(landed, "table_name"))


def idempotency(spark: SparkSession, house: Lakehouse, as_of: date, run_ts: datetime | None = None) -> DataFrame:
    """Run raw to mart twice and compare every trusted table, star table and the mart, load times aside."""

    def stored() -> dict[str, DataFrame]:
        return jobs.silver_tables(spark, house) | jobs.gold_tables(spark, house) | jobs.results(spark, house)

    jobs.transform(spark, house, as_of, run_ts)
    first = stored()
    jobs.transform(spark, house, as_of, run_ts)
    return compare(first, stored(), ignore=LOAD_TIMES)


def idempotency_by_range(
    spark: SparkSession, house: Lakehouse, as_of: date, run_ts: datetime | None = None, span: int = RANGE_KEYS
) -> DataFrame:
    """Run raw to mart twice and compare the tables by the fingerprints of their key ranges, load times aside."""
    tables = spec.SOURCE_TABLES | spec.GOLD_TABLES | {spec.MART.name: spec.MART}

    def stored() -> dict[str, DataFrame]:
        return jobs.silver_tables(spark, house) | jobs.gold_tables(spark, house) | jobs.results(spark, house)

    jobs.transform(spark, house, as_of, run_ts)
    first = stored()
    jobs.transform(spark, house, as_of, run_ts)
    report = []
    for name, second in stored().items():
        found = differing_ranges(first[name], second, tables[name].key, span, LOAD_TIMES)
        counted = found.agg(
            F.coalesce(F.sum("first_rows"), F.lit(0)).alias("first_rows"),
            F.coalesce(F.sum("second_rows"), F.lit(0)).alias("second_rows"),
            F.count(F.lit(1)).alias("ranges"),
            F.count(F.when(~F.col("same"), 1)).alias("ranges_differing"),
        )
        report.append(counted.select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, report).withColumn("identical", F.col("ranges_differing") == 0)


def injected_orders(orders: DataFrame, at: datetime) -> DataFrame:
    """Two bad orders and one good one, numbered after the highest order id."""
    rows = F.array(
        *[
            F.struct(
                (F.col("order_id") + offset).alias("order_id"),
                F.lit(customer).cast("bigint").alias("customer_id"),
                F.lit(status).alias("status"),
                F.lit(amount).cast("decimal(12,2)").alias("total_amount"),
                F.lit(region).alias("region"),
                moment(at).alias("created_at"),
                moment(at).alias("updated_at"),
                F.lit(bad).alias("bad"),
            )
            for offset, customer, status, amount, region, bad in INJECTED
        ]
    )
    return highest_key(orders, "order_id").select(F.inline(rows))


def quality_gate(spark: SparkSession, house: Lakehouse, at: datetime) -> DataFrame:
    """Whether the pipeline stops injected bad orders and lets the good one pass.

    The house's raw orders are made trusted, the injected ones land as the batch
    ``at``, which is later than all others, and only that batch is merged. What is
    judged is the trusted table as it is stored.
    """
    orders, table = read_raw(spark, house.raw, spec.ORDERS), spec.ORDERS
    injected = materialize(injected_orders(orders, at), "injected")
    latest = read_raw(spark, house.raw, table, with_partitions=True).agg(F.max("batch")).first()[0]

    def stored() -> DataFrame:
        return jobs.read_table(spark, house, house.silver(table.name), table)

    jobs.update_silver(spark, house)
    before = materialize(row_counts({"rows_before": stored()}), "rows-before")
    write_batch(injected.drop("bad"), house.raw, table.name, at)
    jobs.update_silver(spark, house, after=latest)
    # Three injected rows against the whole table: one pass tells them apart.
    tally = stored().join(injected.select("order_id", "bad"), "order_id", "left").agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.count(F.when(F.col("bad"), 1)).alias("bad_leaked"),
        F.count(F.when(~F.col("bad"), 1)).alias("good_passed"),
    )
    after_names = ["rows_after", "bad_leaked", "good_passed"]
    summary = figures(before.unionByName(tally.unpivot([], after_names, "table_name", "row_count")), ["rows_before", *after_names])
    added = F.col("rows_after") - F.col("rows_before")
    return summary.withColumn("passed", (F.col("bad_leaked") == 0) & (added == 1))


def leak_report(raw: layers.Tables) -> DataFrame:
    """Per table: keys with a rejected row, and how many rejected rows the trusted table holds.

    A key may have rejected and valid rows, so rows are compared, not keys.
    """
    report = []
    for name, rows in raw.items():
        table = spec.SOURCE_TABLES[name]
        bad = rejected(table.conform(rows), table.rules)
        bad_keys = bad.filter(F.col(table.key).isNotNull()).select(table.key).distinct()
        counts = row_counts({"bad_keys": bad_keys, "leaked": leaked(layers.trusted(rows, table), bad)})
        found = figures(counts, ["bad_keys", "leaked"])
        report.append(found.select(F.lit(name).alias("table_name"), "bad_keys", "leaked"))
    return reduce(DataFrame.unionByName, report)
