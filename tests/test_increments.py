"""Batches carried through the layers: the same tables as from scratch, nothing else rewritten, and runs that died."""

from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.operators.audit import differing_rows
from tidemark.operators.propagate import touched_items, touched_orders
from tidemark.operators.totals import apply_delta, customer_totals, totals_delta
from tidemark.plans import increments, jobs
from tidemark.plans.jobs import Lakehouse
from tidemark.plans.layers import trusted
from tidemark.sources import retail
from tidemark.sources.raw import read_raw, write_batch
from tidemark.sources.shared import exists

AS_OF = date(2001, 8, 2)
RUN_TS = datetime(2001, 8, 2, 6)
FIRST, SECOND = datetime(2002, 1, 1), datetime(2002, 7, 1)
SPANS = {"orders": 500, "order_items": 5000, "fact_orders": 500, "fact_order_items": 5000}


def first_run(spark, folder, tables):
    house = Lakehouse(folder, SPANS)
    for name, rows in tables.items():
        write_batch(rows, house.raw, name, FIRST)
    increments.transform_new(spark, house, "retail", FIRST, AS_OF, RUN_TS)
    return house


def land_changes(house, tables):
    """Orders below 500 in a new status, one of them moved to another customer, and an item moved to another order."""
    at = F.lit("2002-06-01").cast("timestamp_ntz")
    orders = tables["orders"].filter("order_id < 500 AND order_id % 7 = 0").withColumns(
        {"status": F.lit("delivered"), "updated_at": at, "customer_id": F.col("customer_id") % 10 + 1}
    )
    items = tables["order_items"].filter("item_id < 1000 AND quantity > 0").orderBy("item_id").limit(1)
    items = items.withColumns({"order_id": F.lit(450).cast("long"), "updated_at": at})
    for name, rows in (("orders", orders), ("order_items", items)):
        write_batch(rows, house.raw, name, SECOND)


def files(house, layer, name):
    found = {}
    for file in Path(house.root, layer, name).glob("key_range=*/*.parquet"):
        found.setdefault(int(file.parent.name.split("=")[1]), set()).add(file.name)
    return found


def assert_as_from_scratch(spark, house):
    """Facts and totals are those of the whole raw layer."""
    stored = jobs.gold_tables(spark, house)
    silver = {name: trusted(read_raw(spark, house.raw, table), table) for name, table in spec.SOURCE_TABLES.items()}
    built = jobs.build_facts(silver["orders"], silver["order_items"], stored, RUN_TS)
    held = jobs.read_table(spark, house, house.gold("customer_totals"), spec.CUSTOMER_TOTALS).filter("total_orders > 0")
    for name, fact in built.items():
        assert differing_rows(stored[name], fact).isEmpty(), name
    assert differing_rows(held, customer_totals(built["fact_orders"])).isEmpty()
    assert jobs.results(spark, house)["customer_mart"].count() > 0


def test_only_touched_ranges_are_rewritten(spark, folder, small):
    tables = retail.sources(spark, small)
    house = first_run(spark, f"{folder}/house", tables)
    land_changes(house, tables)
    places = [("silver", "orders"), ("gold", "fact_orders"), ("gold", "fact_order_items")]
    before = {place: files(house, *place) for place in places}
    assert increments.transform_new(spark, house, "retail", SECOND, AS_OF, RUN_TS)
    for place in places:
        after = files(house, *place)
        same = {key for key in after if after[key] == before[place][key]}
        assert same == set(after) - {0} and len(after) >= 3, place
    assert not exists(spark, house.increment("20020701_000000"))
    assert_as_from_scratch(spark, house)


@pytest.mark.parametrize("broken", ["update_totals"])
def test_a_run_that_died_is_completed_by_the_next(spark, folder, small, monkeypatch, broken):
    tables = retail.sources(spark, small)
    house = first_run(spark, f"{folder}/house", tables)
    land_changes(house, tables)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(increments, broken, die)
        with pytest.raises(RuntimeError, match="lost"):
            increments.transform_new(spark, house, "retail", SECOND, AS_OF, RUN_TS)
    increments.transform_new(spark, house, "retail", SECOND, AS_OF, RUN_TS)
    assert_as_from_scratch(spark, house)


FACT = "customer_key long, order_key long, created_at timestamp_ntz, total_amount decimal(12,2), item_count long"


def facts(spark, *rows):
    from decimal import Decimal

    return spark.createDataFrame([(c, o, datetime(2024, 1, d), Decimal(a), i) for c, o, d, a, i in rows], FACT)


def test_totals_take_back_what_left(spark):
    """The first order moves away, the last one changes its amount, a customer loses all, another is new."""
    before = [(1, 10, 1, "5.00", 1), (1, 11, 2, "6.00", 2), (1, 12, 3, "7.00", 3), (2, 20, 5, "1.00", 1), (3, 30, 9, "2.00", 0)]
    after = [(4, 10, 1, "5.00", 1), (1, 11, 2, "6.00", 2), (1, 12, 3, "9.50", 3), (3, 20, 5, "1.00", 1), (3, 30, 9, "2.00", 0)]
    held, whole = customer_totals(facts(spark, *before)), facts(spark, *after)
    touched = {10, 12, 20}
    delta = totals_delta(*(facts(spark, *[r for r in rows if r[1] in touched]) for rows in (before, after)))
    changed = {r["customer_key"]: r for r in apply_delta(held, delta, whole).collect()}
    assert tuple(changed[2])[1:] == (None, None, 0, 0, 0)
    expected = {r["customer_key"]: r for r in customer_totals(whole).collect()}
    assert {k: tuple(r) for k, r in changed.items() if k != 2} == {k: tuple(r) for k, r in expected.items()}


def test_touched_keys(spark):
    orders = spark.createDataFrame([(1, 7), (2, 8), (3, 9), (4, 9)], "order_id long, customer_id long")
    items = spark.createDataFrame([(10, 1), (20, 2), (30, None)], "item_id long, order_id long")
    known = spark.createDataFrame([(1, 7), (2, -1), (3, -1), (4, -1)], "order_id long, customer_key long")
    batch = {
        "orders": spark.createDataFrame([(5, 1)], "order_id long, customer_id long"),
        "order_items": spark.createDataFrame([(10, 6), (30, None)], "item_id long, order_id long"),
        "customers": spark.createDataFrame([(9,), (7,)], "customer_id long"),
    }
    stored = {"orders": orders, "order_items": items}
    keys = touched_orders(batch, stored, known)
    # 5 itself; 6 and 1, where an item is and was; 3 and 4, whose customer came
    assert sorted(r[0] for r in keys.collect()) == [1, 3, 4, 5, 6]
    assert sorted(r[0] for r in touched_items(keys, batch["order_items"], items).collect()) == [10, 30]


def test_the_totals_table_follows_a_whole_rebuild(spark, folder, small):
    """A customer whose orders are gone from the facts is held with none."""
    house = Lakehouse(folder)
    stale = spark.createDataFrame([(10**9, None, None, 3, 100, 5)], spec.CUSTOMER_TOTALS.schema)
    jobs.merge_table(stale, house, house.gold("customer_totals"), spec.CUSTOMER_TOTALS)
    for name, rows in retail.sources(spark, small).items():
        write_batch(rows, house.raw, name, FIRST)
    jobs.transform(spark, house, AS_OF, RUN_TS)
    held = jobs.read_table(spark, house, house.gold("customer_totals"), spec.CUSTOMER_TOTALS)
    assert held.filter("customer_key = 1000000000").first()["total_orders"] == 0
    mart = jobs.results(spark, house)["customer_mart"]
    assert mart.filter("customer_key = 1000000000").isEmpty() and not mart.isEmpty()
