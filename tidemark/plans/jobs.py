"""Jobs over a lakehouse folder: extract to raw, raw to trusted, trusted to star schema, star schema to mart."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions import moment
from tidemark.operators.changes import advance_watermark, changes, read_watermark, window_start
from tidemark.operators.dedup import latest_by_key
from tidemark.operators.dimensions import dim_customer, dim_date, dim_product
from tidemark.operators.facts import fact_order_items, fact_orders
from tidemark.operators.mart import mart_of_profile, profile_of_totals
from tidemark.operators.totals import customer_totals, whole_totals
from tidemark.operators.upsert import merge_into
from tidemark.sources.checked import passed, read_checked, store_checked, stored_drop_counts
from tidemark.sources.footers import footer_count
from tidemark.sources.ranges import merge_ranges, read_ranges
from tidemark.sources.raw import batch_path, raw_exists, read_raw, write_batch
from tidemark.sources.shared import delete_empty, delete_folder, exists, is_empty
from tidemark.sources.snapshots import current_version, expire_snapshots, merge_snapshot, read_snapshot, write_snapshot
from tidemark.spec import TableSpec


@dataclass(frozen=True)
class Lakehouse:
    """Where the layers of one lakehouse live, on any file system Spark can reach.

    Tables are stored as snapshots. A large table whose keys grow with time is
    better listed in ``key_spans`` with the number of keys per range; merging
    then rewrites only the ranges a batch touches. ``merge_tables`` names the
    catalog tables of those kept in a format that supports MERGE.
    """

    root: str
    key_spans: Mapping[str, int] = field(default_factory=dict)
    merge_tables: Mapping[str, str] = field(default_factory=dict)

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def control(self) -> str:
        return f"{self.root}/control"

    def progress(self, table: str) -> str:
        return f"{self.root}/progress/{table}"

    def checked(self, table: str, batch: str) -> str:
        return f"{self.root}/checked/{table}/{batch}"

    def increment(self, batch: str) -> str:
        return f"{self.root}/increments/{batch}"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"


def merge_table(
    source: DataFrame, house: Lakehouse, path: str, table: TableSpec, newer_by: str | None = None
) -> None:
    """Upsert the rows into a stored table: by MERGE, by range or as a new snapshot."""
    if table.name in house.merge_tables:
        merge_into(table.conform(source), house.merge_tables[table.name], table.key, newer_by)
    elif table.name in house.key_spans:
        merge_ranges(source, path, table, house.key_spans[table.name], newer_by)
    else:
        merge_snapshot(source, path, table, newer_by)


def read_table(spark: SparkSession, house: Lakehouse, path: str, table: TableSpec) -> DataFrame:
    if table.name in house.merge_tables:
        return spark.table(house.merge_tables[table.name])
    if table.name in house.key_spans:
        return read_ranges(spark, path, table)
    return read_snapshot(spark, path, table)


@dataclass(frozen=True)
class Extraction:
    """What one extract run read: its window and the rows landed per table."""

    start: datetime
    end: datetime
    rows: dict[str, int]

    @property
    def total(self) -> int:
        return sum(self.rows.values())


def start_pipeline(spark: SparkSession, house: Lakehouse, pipeline: str, watermark: datetime) -> None:
    """Give a pipeline its first watermark; also resets it for a backfill."""
    row = spark.createDataFrame([(pipeline, watermark, None, "new")], spec.CONTROL.schema)
    merge_snapshot(row, house.control, spec.CONTROL)


def extract(
    spark: SparkSession,
    house: Lakehouse,
    sources: Mapping[str, DataFrame],
    pipeline: str,
    batch_end: datetime,
    overlap_minutes: int = spec.OVERLAP_MINUTES,
    table_prefix: str = "",
) -> Extraction:
    """Land each table's changes since the watermark, then advance the watermark.

    One window, ending at ``batch_end``, serves all tables. The source is read
    once: what the write left in the footers tells how many rows there were, and a
    batch without any is taken away again. ``table_prefix`` is what the source's table names start
    with and the raw layer's do not. The watermark moves only after every write returned: if
    one fails, the error goes up, the next run reads the same window again, and
    the rows landed twice are resolved by the trusted layer.
    """
    control = read_snapshot(spark, house.control, spec.CONTROL)
    start = window_start(read_watermark(control, pipeline), overlap_minutes)
    rows = {}
    for source_name, source in sources.items():
        name = source_name.removeprefix(table_prefix)
        path = batch_path(house.raw, name, batch_end)
        before = footer_count(spark, path)
        write_batch(changes(source, start, batch_end), house.raw, name, batch_end)
        rows[name] = footer_count(spark, path) - before
        if not before and not rows[name]:
            delete_empty(spark, path, house.raw)
    moved = spark.range(1).select(
        F.lit(pipeline).alias("pipeline_name"),
        moment(batch_end).alias("last_watermark"),
        F.current_timestamp().cast("timestamp_ntz").alias("last_run_at"),
    )
    write_snapshot(advance_watermark(control, moved), house.control)
    return Extraction(start, batch_end, rows)


EVERYTHING = "all"


def check_raw(
    spark: SparkSession,
    house: Lakehouse,
    table: TableSpec,
    after: str | None = None,
    dedup_first: bool = False,
    batch: str = EVERYTHING,
    again: bool = True,
) -> DataFrame:
    """The raw rows of a table, each stored under the first rule it breaks; raw is read once."""
    rows = table.conform(read_raw(spark, house.raw, table, after=after))
    if dedup_first:
        rows = latest_by_key(rows, table.key, table.changed_at)
    return store_checked(rows, house.checked(table.name, batch), table, again)


def update_silver(
    spark: SparkSession, house: Lakehouse, after: str | None = None, dedup_first: bool = False
) -> dict[str, dict[str, int]]:
    """Merge the raw layer into the trusted tables; rows dropped per table and rule.

    With ``after``, a batch label, only later batches are read: the others'
    folders are pruned. Such a run may see rows older than the trusted ones, so
    newer trusted rows are kept. The trusted rows, the rejects (``checked``) and
    the counts all come from the rows as they were stored by label.
    """
    dropped = {}
    for name, table in spec.SOURCE_TABLES.items():
        if not raw_exists(spark, house.raw, table):
            continue
        checked = check_raw(spark, house, table, after, dedup_first)
        valid = passed(checked)
        if not dedup_first:
            valid = latest_by_key(valid, table.key, table.changed_at)
        merge_table(valid, house, house.silver(name), table, None if after is None else table.changed_at)
        dropped[name] = {r["rule"]: r["dropped"] for r in stored_drop_counts(checked, table).collect()}
    return dropped


def rejected_rows(spark: SparkSession, house: Lakehouse, table: TableSpec, batch: str = EVERYTHING) -> DataFrame:
    """The stored rows of a check that broke a rule, with its name."""
    return read_checked(spark, house.checked(table.name, batch), table).filter("broken_rule <> 'passed'")


def silver_tables(spark: SparkSession, house: Lakehouse) -> dict[str, DataFrame]:
    return {n: read_table(spark, house, house.silver(n), t) for n, t in spec.SOURCE_TABLES.items()}


def gold_tables(spark: SparkSession, house: Lakehouse, *names: str) -> dict[str, DataFrame]:
    """The named tables of the star schema, all of them by default; no other table's files are listed."""
    return {n: read_table(spark, house, house.gold(n), spec.GOLD_TABLES[n]) for n in names or spec.GOLD_TABLES}


def update_customers(
    spark: SparkSession, house: Lakehouse, customers: DataFrame, run_ts: datetime | None = None
) -> None:
    merge_table(dim_customer(customers, run_ts), house, house.gold("dim_customer"), spec.DIM_CUSTOMER)


def update_dimensions(
    spark: SparkSession, house: Lakehouse, customers: DataFrame, run_ts: datetime | None = None
) -> None:
    """Merge the customers and the generated products and days into their dimensions."""
    update_customers(spark, house, customers, run_ts)
    generated = {"dim_product": dim_product(spark, run_ts=run_ts), "dim_date": dim_date(spark)}
    for name, rows in generated.items():
        merge_table(rows, house, house.gold(name), spec.GOLD_TABLES[name])


def build_facts(
    orders: DataFrame, items: DataFrame, dimensions: Mapping[str, DataFrame], run_ts: datetime | None = None
) -> dict[str, DataFrame]:
    customers, products = dimensions["dim_customer"], dimensions["dim_product"]
    return {
        "fact_orders": fact_orders(orders, items, customers, run_ts),
        "fact_order_items": fact_order_items(items, orders, customers, products, run_ts),
    }


def update_gold(spark: SparkSession, house: Lakehouse, run_ts: datetime | None = None) -> None:
    """Merge dimensions, then facts, which are built on the stored dimensions, and total the orders of each customer."""
    tables = silver_tables(spark, house)
    update_dimensions(spark, house, tables["customers"], run_ts)
    dimensions = gold_tables(spark, house, "dim_customer", "dim_product")
    facts = build_facts(tables["orders"], tables["order_items"], dimensions, run_ts)
    for name, fact in facts.items():
        merge_table(fact, house, house.gold(name), spec.GOLD_TABLES[name])
    stored = read_table(spark, house, house.gold("fact_orders"), spec.FACT_ORDERS)
    path, table = house.gold(spec.CUSTOMER_TOTALS.name), spec.CUSTOMER_TOTALS
    held = read_table(spark, house, path, table)
    merge_table(whole_totals(customer_totals(stored), held), house, path, table)


def rebuild_mart(
    spark: SparkSession, house: Lakehouse, as_of: date, run_ts: datetime | None = None, method: str = "tiles"
) -> int:
    """Replace the mart with a new complete snapshot; its version."""
    totals = read_table(spark, house, house.gold(spec.CUSTOMER_TOTALS.name), spec.CUSTOMER_TOTALS)
    customers = read_table(spark, house, house.gold("dim_customer"), spec.DIM_CUSTOMER)
    mart = mart_of_profile(profile_of_totals(totals, customers, as_of), run_ts, method)
    return write_snapshot(mart, house.gold(spec.MART.name))


def result_tables() -> dict[str, TableSpec]:
    """The tables a run is judged by."""
    return {t.name: t for t in (spec.DIM_CUSTOMER, spec.FACT_ORDERS, spec.MART)}


def results(spark: SparkSession, house: Lakehouse) -> dict[str, DataFrame]:
    return {name: read_table(spark, house, house.gold(name), table) for name, table in result_tables().items()}


def result_versions(spark: SparkSession, house: Lakehouse) -> dict[str, int]:
    return {name: current_version(spark, house.gold(name)) for name in result_tables()}


def transform(spark: SparkSession, house: Lakehouse, as_of: date, run_ts: datetime | None = None) -> None:
    """Raw to mart, from everything in the raw layer."""
    update_silver(spark, house)
    update_gold(spark, house, run_ts)
    rebuild_mart(spark, house, as_of, run_ts)


def retire(spark: SparkSession, house: Lakehouse, keep: int = 2) -> dict[str, list[int]]:
    """Delete old versions of all snapshot tables and the checked rows of finished batches; the versions deleted."""
    paths = {n: house.silver(n) for n in spec.SOURCE_TABLES}
    paths |= {n: house.gold(n) for n in (*spec.GOLD_TABLES, spec.CUSTOMER_TOTALS.name, spec.MART.name)}
    paths[spec.CONTROL.name] = house.control
    stored = {n: p for n, p in paths.items() if n not in house.key_spans and n not in house.merge_tables}
    expired = {name: expire_snapshots(spark, path, keep) for name, path in stored.items()}
    if not exists(spark, f"{house.root}/increments") or is_empty(spark, f"{house.root}/increments"):
        delete_folder(spark, f"{house.root}/checked")
    return expired


def run(
    spark: SparkSession,
    house: Lakehouse,
    sources: Mapping[str, DataFrame],
    pipeline: str,
    batch_end: datetime,
    as_of: date,
    run_ts: datetime | None = None,
) -> tuple[Extraction, float]:
    """Source to mart; what was extracted and the seconds it all took.

    The first run transforms everything, later ones what their batch touches.
    """
    from tidemark.plans.increments import transform_new  # which is made of the jobs here

    began = time.monotonic()
    extraction = extract(spark, house, sources, pipeline, batch_end)
    transform_new(spark, house, pipeline, batch_end, as_of, run_ts)
    return extraction, round(time.monotonic() - began, 1)
