"""Extraction, watermark, full runs, checks and the stream, on stored lakehouses."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.operators.audit import compare, differing_rows, extract_reduction, row_counts, with_total
from tidemark.operators.changes import UnknownPipeline, changes, read_watermark, window_start
from tidemark.operators.dimensions import dim_customer, dim_product
from tidemark.operators.facts import fact_order_items, fact_orders
from tidemark.operators.mart import customer_profile, distribution, mart_metrics
from tidemark.plans import checks, jobs
from tidemark.plans.jobs import Lakehouse, read_table
from tidemark.plans.layers import trusted
from tidemark.sources import retail
from tidemark.sources.raw import read_raw, write_batch
from tidemark.sources.snapshots import read_snapshot
from tidemark.streaming.pickup import pick_up

AS_OF = date(2001, 8, 2)
AS_OF_TIME = datetime(2001, 8, 2)
RUN_TS = datetime(2001, 8, 2, 6)


def watermark(spark, house, pipeline="retail"):
    return read_watermark(read_snapshot(spark, house.control, spec.CONTROL), pipeline)


def test_window_is_half_open(spark):
    times = [datetime(2024, 1, 1, 0, m) for m in (0, 1, 2, 3)]
    df = spark.createDataFrame([(t,) for t in times], "updated_at timestamp_ntz")
    found = [r[0].minute for r in changes(df, times[0], times[2]).orderBy("updated_at").collect()]
    assert found == [1, 2]
    assert window_start(datetime(2024, 1, 1, 0, 5)) == datetime(2023, 12, 31, 23, 50)


def test_unknown_pipeline(spark, folder):
    house = Lakehouse(folder)
    jobs.start_pipeline(spark, house, "retail", datetime(2024, 1, 1))
    with pytest.raises(UnknownPipeline):
        watermark(spark, house, "other")


def test_extract_moves_the_watermark_and_overlaps(spark, folder, small):
    house = Lakehouse(folder)
    tables = retail.sources(spark, small)
    jobs.start_pipeline(spark, house, "retail", datetime(1994, 1, 1))
    jobs.start_pipeline(spark, house, "other", datetime(1994, 1, 1))
    first = jobs.extract(spark, house, tables, "retail", datetime(1998, 1, 1))
    assert first.rows["orders"] == changes(tables["orders"], first.start, first.end).count()
    assert first.total == sum(first.rows.values())
    assert watermark(spark, house) == datetime(1998, 1, 1)
    assert watermark(spark, house, "other") == datetime(1994, 1, 1)
    second = jobs.extract(spark, house, tables, "retail", datetime(2002, 1, 1))
    assert second.start == datetime(1997, 12, 31, 23, 45)
    assert second.rows["customers"] == 0  # nothing changed since: no folder is written
    assert read_raw(spark, house.raw, spec.CUSTOMERS, with_partitions=True).select("batch").distinct().count() == 1
    state = read_snapshot(spark, house.control, spec.CONTROL).filter("pipeline_name = 'retail'").first()
    assert state["status"] == "success"
    assert state["last_run_at"] is not None


def test_only_changes_are_extracted(spark, folder, small):
    house = Lakehouse(folder)
    tables = retail.sources(spark, small)
    jobs.start_pipeline(spark, house, "retail", datetime(2001, 1, 1))
    report = {r["table_name"]: r for r in checks.incremental(spark, house, tables, "retail", AS_OF_TIME).collect()}
    orders = tables["orders"]
    assert report["orders"]["source_rows"] == orders.count()
    assert report["orders"]["window_rows"] == orders.filter("updated_at > '2000-12-31 23:45:00'").count()
    assert 0 < report["orders"]["reduction_pct"] < 100
    assert (report["customers"]["window_rows"], report["customers"]["reduction_pct"]) == (0, 100.0)
    assert all(r["incremental"] for r in report.values())
    assert watermark(spark, house) == AS_OF_TIME


def test_source_prefix_is_dropped(spark, folder, small):
    house = Lakehouse(folder)
    jobs.start_pipeline(spark, house, "retail", datetime(1994, 1, 1))
    orders = retail.orders(spark, small)
    landed = jobs.extract(spark, house, {"shop_orders": orders}, "retail", AS_OF_TIME, table_prefix="shop_")
    assert landed.rows == {"orders": orders.count()}
    assert read_raw(spark, house.raw, spec.ORDERS).count() == orders.count()


def test_a_failing_table_leaves_the_watermark(spark, folder, small):
    house = Lakehouse(folder)
    tables = retail.sources(spark, small)
    jobs.start_pipeline(spark, house, "retail", datetime(1994, 1, 1))
    broken = tables | {"customers": tables["customers"].withColumn("tier", F.raise_error(F.lit("source is gone")))}
    with pytest.raises(Exception, match="source is gone"):
        jobs.extract(spark, house, broken, "retail", datetime(2002, 1, 1))
    assert watermark(spark, house) == datetime(1994, 1, 1)
    jobs.extract(spark, house, tables, "retail", datetime(2002, 1, 2))
    landed = read_raw(spark, house.raw, spec.ORDERS)
    assert landed.count() == 2 * tables["orders"].count()  # the first table's batch landed twice
    jobs.update_silver(spark, house)
    once = Lakehouse(folder + "/clean")
    jobs.start_pipeline(spark, once, "retail", datetime(1994, 1, 1))
    jobs.extract(spark, once, tables, "retail", datetime(2002, 1, 1))
    jobs.update_silver(spark, once)
    report = compare(jobs.silver_tables(spark, house), jobs.silver_tables(spark, once))
    assert all(r["identical"] for r in report.collect())


def late_batch(tables):
    """Orders that changed status after the first batch, with their new change time."""
    changed = tables["orders"].filter("order_id % 10 = 0").withColumn("status", F.lit("delivered"))
    return changed.withColumn("updated_at", F.lit("2002-06-01").cast("timestamp_ntz"))


def test_run_again_with_late_changes(spark, folder, small):
    """Snapshots, key ranges and batch-pruned updates give the same tables."""
    plain = Lakehouse(f"{folder}/plain")
    split = Lakehouse(f"{folder}/split", {"orders": 500, "order_items": 5000, "fact_orders": 500})
    tables = retail.sources(spark, small)
    extraction, seconds = None, None
    for house in (plain, split):
        jobs.start_pipeline(spark, house, "retail", datetime(1994, 1, 1))
        extraction, seconds = jobs.run(spark, house, tables, "retail", datetime(2002, 1, 1), AS_OF, RUN_TS)
    assert seconds > 0
    assert extraction.rows["order_items"] == tables["order_items"].count()
    for house in (plain, split):
        late = tables | {"orders": tables["orders"].unionByName(late_batch(tables))}
        jobs.extract(spark, house, late, "retail", datetime(2002, 7, 1))
    dropped = jobs.update_silver(spark, plain)
    assert dropped["customers"]["email_present"] == retail.customers(spark, small).filter("email IS NULL").count()
    jobs.update_silver(spark, split, after="20020101_000000")
    for house in (plain, split):
        jobs.update_gold(spark, house, RUN_TS)
        jobs.rebuild_mart(spark, house, AS_OF, RUN_TS)
    for tables_of in (jobs.silver_tables, jobs.gold_tables):
        report = compare(tables_of(spark, plain), tables_of(spark, split)).collect()
        assert all(r["identical"] and r["first_rows"] > 0 for r in report), report
    statuses = jobs.gold_tables(spark, plain)["fact_orders"].filter("order_id % 10 = 0")
    assert {r[0] for r in statuses.select("status").distinct().collect()} == {"delivered"}
    assert jobs.result_versions(spark, plain)[spec.MART.name] == 1


def test_idempotent(spark, folder, small):
    house = Lakehouse(folder)
    jobs.start_pipeline(spark, house, "retail", datetime(1994, 1, 1))
    jobs.extract(spark, house, retail.sources(spark, small), "retail", datetime(2002, 1, 1))
    # Load times differ between the runs and are left out.
    report = checks.idempotency(spark, house, AS_OF).collect()
    assert all(r["identical"] and r["first_rows"] == r["second_rows"] > 0 for r in report)


def test_quality_gate(spark, folder, small):
    house = Lakehouse(folder)
    write_batch(retail.orders(spark, small), house.raw, "orders", datetime(2001, 1, 1))
    gate = checks.quality_gate(spark, house, RUN_TS).first()
    assert (gate["rows_after"] - gate["rows_before"], gate["bad_leaked"], gate["good_passed"]) == (1, 0, 1)
    assert gate["passed"]


@pytest.mark.parametrize("key_spans", [{}, {"orders": 400}])
def test_stream_keeps_up_and_ignores_older_rows(spark, folder, small, key_spans):
    tables, house = retail.sources(spark, small), Lakehouse(folder, key_spans)

    def drain():
        pick_up(spark, house, spec.ORDERS, files_per_batch=1).awaitTermination()
        return read_table(spark, house, house.silver("orders"), spec.ORDERS)

    write_batch(late_batch(tables), house.raw, "orders", datetime(2002, 7, 1))
    assert drain().filter("status <> 'delivered'").isEmpty()
    write_batch(tables["orders"], house.raw, "orders", datetime(2002, 7, 2))  # older versions arrive late
    merged = drain()
    both = tables["orders"].unionByName(late_batch(tables))
    assert differing_rows(merged, trusted(both, spec.ORDERS)).isEmpty()
    before = merged.count()
    assert drain().count() == before  # nothing new: nothing to do


def facts(spark):
    """Two customers, one of them unknown, four orders, one without items."""
    at = datetime(2024, 3, 2, 10)
    customers = spark.createDataFrame([(1, "a@b", "Ann", "North", "premium", at, at)], spec.CUSTOMERS.schema)
    order_rows = [(10, 1, "pending", 10.0), (11, 1, "shipped", 0.05), (12, 9, "shipped", 7.0), (13, None, "pending", 1.0)]
    orders = spec.ORDERS.conform(
        spark.createDataFrame(
            [(o, c, s, a, "North", at, at) for o, c, s, a in order_rows],
            spec.ORDERS.ddl.replace("DECIMAL(12,2)", "DOUBLE"),
        )
    )
    item_rows = [(100, 10, 5, 2, 1.15), (101, 10, 999, 1, 3.0), (102, 12, 7, 3, 0.1), (103, 77, 8, 1, 1.0)]
    items = spec.ORDER_ITEMS.conform(
        spark.createDataFrame(
            [(*row, at, at) for row in item_rows], spec.ORDER_ITEMS.ddl.replace("DECIMAL(12,2)", "DOUBLE")
        )
    )
    return orders, items, dim_customer(customers, at)


def test_facts_use_the_unknown_member(spark):
    orders, items, customers = facts(spark)
    rows = {r["order_key"]: r for r in fact_orders(orders, items, customers).collect()}
    assert {k: (r["customer_key"], r["item_count"]) for k, r in rows.items()} == {
        10: (1, 2), 11: (1, 0), 12: (-1, 1), 13: (-1, 0),
    }
    assert rows[10]["date_key"] == 20240302
    lines = {r["item_key"]: r for r in fact_order_items(items, orders, customers, dim_product(spark)).collect()}
    assert {k: (r["customer_key"], r["product_key"], str(r["line_total"])) for k, r in lines.items()} == {
        100: (1, 5, "2.30"), 101: (1, -1, "3.00"), 102: (-1, 7, "0.30"), 103: (-1, 8, "1.00"),
    }


def test_profile_rounds_halves_up_and_can_keep_the_unknown(spark):
    orders, items, customers = facts(spark)
    fact = fact_orders(orders, items, customers)
    known = customer_profile(fact, customers, date(2024, 3, 12)).collect()
    assert [(r["customer_key"], str(r["total_spent"]), str(r["avg_order_value"]), r["recency_days"]) for r in known] == [
        (1, "10.05", "5.03", 10)
    ]
    both = {r["customer_key"]: r for r in customer_profile(fact, customers, date(2024, 3, 12), True).collect()}
    assert both[-1]["name"] is None
    assert both[-1]["total_orders"] == 2


def test_reports(spark):
    mart = spark.createDataFrame(
        [("Champions", "LOW", 3)] * 2 + [("Lost", "HIGH", 95)], "rfm_segment string, churn_risk string, recency_days int"
    )
    assert [tuple(r) for r in distribution(mart, "rfm_segment").collect()] == [
        ("Champions", 2, 66.7, "#" * 20), ("Lost", 1, 33.3, "#" * 10),
    ]
    assert {r["metric"]: r["value"] for r in mart_metrics(mart).collect()} == {
        "Total customers": 3.0, "Avg recency days": 33.7, "HIGH churn risk count": 1.0, "Champions count": 2.0,
    }
    assert {r["metric"]: r["value"] for r in mart_metrics(mart.filter("false")).collect()}["Avg recency days"] is None


def test_audits(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, v string")
    surplus = {r["k"]: r["surplus"] for r in differing_rows(left, right).collect()}
    assert surplus == {1: 1, 3: -1}
    report = compare({"t": left}, {"t": right}).first()
    assert (report["first_rows"], report["second_rows"], report["rows_differing"], report["identical"]) == (3, 3, 2, False)
    assert {r[0]: r[1] for r in with_total(row_counts({"l": left, "r": right.limit(1)})).collect()} == {
        "l": 3, "r": 1, "total": 4,
    }
    reduced = extract_reduction(spark.range(21094), spark.range(272)).first()
    assert (reduced["reduction_pct"], reduced["incremental"]) == (98.7, True)
    assert extract_reduction(spark.range(0), spark.range(0)).first()["reduction_pct"] is None
