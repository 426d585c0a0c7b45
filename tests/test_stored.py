"""Stored layers: checked rows, footers, fingerprints, batches decided by their write, the stream's state, MERGE."""

import shutil
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark import spec
from tidemark.operators import audit, fingerprints
from tidemark.operators.fingerprints import differing_keys, differing_ranges, range_fingerprints
from tidemark.operators.quality import validate
from tidemark.operators.upsert import key_tally
from tidemark.plans import jobs
from tidemark.plans.jobs import Lakehouse
from tidemark.plans.queries import EVENTS
from tidemark.sources import checked, footers, ranges, raw, retail, snapshots
from tidemark.sources.raw import batch_inventory, batch_path, raw_exists, write_batch
from tidemark.sources.shared import exists
from tidemark.streaming import pickup

ORDER = "order_id long, customer_id long, status string, total_amount decimal(12,2), region string, created_at timestamp_ntz, updated_at timestamp_ntz"
ROW = "k long, v string, at timestamp_ntz"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(spark, *values):
    return spark.createDataFrame([(k, v, None) for k, v in values], ROW)


def test_rows_are_stored_once_by_their_first_broken_rule(spark, folder, small):
    house = Lakehouse(folder)
    orders = retail.orders(spark, small)
    odd = spark.createDataFrame([(None, 1, "pending", None, None, None, None), (7, 1, None, Decimal(5), None, None, None)], ORDER)
    write_batch(orders.unionByName(odd), house.raw, "orders", datetime(2001, 1, 1))
    stored = jobs.check_raw(spark, house, spec.ORDERS)
    assert stored.count() == orders.count() + 2
    assert checked.passed(stored).exceptAll(validate(orders, spec.ORDERS.rules)).isEmpty()
    broken = {r["order_id"]: r["broken_rule"] for r in checked.rejects(stored).collect() if r["order_id"] in (None, 7)}
    assert broken[None] == "key_present" and broken[7] == "status_known"
    counts = [tuple(r) for r in checked.stored_drop_counts(stored, spec.ORDERS).collect()]
    assert [(i, rule) for i, rule, _ in counts] == list(enumerate(spec.ORDERS.rules, 1))
    assert sum(n for *_, n in counts) == checked.rejects(stored).count() > 2
    assert "PartitionFilters: [isnotnull(broken_rule" in plan(checked.passed(stored))


def test_a_check_without_rules_or_rows(spark, folder):
    table = spec.TableSpec("plain", "k", ROW)
    stored = checked.store_checked(rows(spark), f"{folder}/none", table)
    assert stored.collect() == [] and checked.stored_drop_counts(stored, table).collect() == []
    stored = checked.store_checked(rows(spark, (1, "a")), f"{folder}/one", table)
    kept = checked.store_checked(rows(spark, (2, "b")), f"{folder}/one", table, again=False)
    assert [r["k"] for r in kept.collect()] == [1]


def test_counts_come_from_footers(spark, folder, small):
    retail.orders(spark, small).write.parquet(f"{folder}/orders")
    rows(spark).write.parquet(f"{folder}/none")
    jobs.write_snapshot(rows(spark, (1, "a")), f"{folder}/versions")
    jobs.write_snapshot(rows(spark, (1, "a"), (2, "b")), f"{folder}/versions")
    paths = {name: f"{folder}/{name}" for name in ("orders", "none", "versions", "absent")}
    counted = footers.stored_row_counts(spark, paths)
    assert plan(counted).count("PushedAggregation: [COUNT(*)]") == 3
    assert dict(map(tuple, counted.collect())) == {
        "orders": retail.orders(spark, small).count(), "none": 0, "versions": 2, "absent": 0,
    }
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # of the session itself


def test_fingerprints_find_lost_repeated_changed_and_new_rows(spark):
    same = [(i, str(i)) for i in range(200, 300)]
    first = rows(spark, *same, (1, "a"), (2, "b"), (2, "b"), (3, "c"), (None, "x"), (50, None))
    second = rows(spark, *same, (2, "b"), (3, "C"), (4, "d"), (None, "y"), (50, ""))
    found = {r["k"]: (r["first_rows"], r["second_rows"], r["difference"]) for r in differing_keys(first, second, "k", 10).collect()}
    assert found == {
        1: (1, 0, "lost"), 2: (2, 1, "repeated"), 3: (1, 1, "changed"), 4: (0, 1, "new"),
        None: (1, 1, "changed"), 50: (1, 1, "changed"),
    }
    ranges = {r["key_range"]: r["same"] for r in differing_ranges(first, second, "k", 10).collect()}
    assert {k for k, equal in ranges.items() if not equal} == {0, 5, None} and len(ranges) == 13


def test_equal_tables_have_equal_fingerprints_in_any_order(spark):
    values = [(i % 40, str(i % 7)) for i in range(300)]
    first, second = rows(spark, *values).repartition(5), rows(spark, *reversed(values))
    assert differing_ranges(first, second, "k", 10).filter("NOT same").isEmpty()
    assert differing_keys(rows(spark), rows(spark), "k").collect() == []
    late = second.withColumn("at", F.lit("2024-01-01").cast("timestamp_ntz"))
    assert differing_ranges(first, late, "k", 10, ignore=["at"]).filter("NOT same").isEmpty()
    assert not differing_ranges(first, late, "k", 10).filter("NOT same").isEmpty()


def test_fingerprints_shuffle_no_rows(spark, folder):
    rows(spark, (1, "a")).withColumn("wide", F.repeat("v", 1000)).write.parquet(f"{folder}/wide")
    prints = range_fingerprints(spark.read.parquet(f"{folder}/wide"), "k")
    exchange = [line for line in prints._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Aggregate" in line]
    assert len(exchange) == 1
    shuffled = prints._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(")[1:]
    assert [x.split(",")[0].split("#")[0] for x in shuffled] == ["key_range"]
    assert {f.name: f.dataType for f in prints.schema if f.name != "key_range"} == dict.fromkeys(
        ["rows", "a_low", "a_high", "b_low", "b_high"], LongType()
    )


def test_a_batch_reads_its_source_once_and_an_empty_one_leaves_nothing(spark, folder):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(value):
        read.add(1)
        return value

    house = Lakehouse(folder)
    jobs.start_pipeline(spark, house, "p", datetime(2024, 1, 1))
    at = F.lit("2024-01-02").cast("timestamp_ntz")
    source = spark.range(20).select("id", seen(F.col("id").cast("string")).alias("v"), at.alias("updated_at"))
    assert jobs.extract(spark, house, {"orders": source}, "p", datetime(2024, 1, 3)).rows == {"orders": 20}
    assert read.value == 20
    empty = jobs.extract(spark, house, {"orders": source, "customers": source}, "p", datetime(2024, 1, 5))
    assert empty.rows == {"orders": 0, "customers": 0}
    assert exists(spark, batch_path(house.raw, "orders", datetime(2024, 1, 3)))
    assert not exists(spark, batch_path(house.raw, "orders", datetime(2024, 1, 5)))
    assert not raw_exists(spark, house.raw, spec.CUSTOMERS)
    found = batch_inventory(spark, house.raw, "orders").collect()
    assert [(r["batch"], r["rows"]) for r in found] == [("20240103_000000", 20)]


def test_the_stream_forgets_old_batches_and_drops_their_replays(spark, folder, monkeypatch):
    """Each daily batch brings ten rows and replays five of the day before."""
    house, merged = Lakehouse(folder), []

    def keep(rows, *_, **__):
        merged.append(rows.count())

    monkeypatch.setattr(pickup, "merge_table", keep)
    held = []
    for day in range(1, 8):
        ids = spark.range(day * 10 - 5 if day > 1 else 10, day * 10 + 10).select(F.col("id").alias("event_id"))
        filled = [F.lit(None).cast(f.dataType).alias(f.name) for f in EVENTS.schema if f.name != "event_id"]
        write_batch(ids.select("event_id", *filled).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")), house.raw, "events", datetime(2024, 1, day))
        query = pickup.pick_up(spark, house, EVENTS, replays_within="2 days")
        query.awaitTermination()
        held.append(max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]))
    assert sum(merged) == 70
    assert held[-3:] == [50, 50, 50]


@pytest.mark.parametrize("newer_by", [None, "updated_at"])
def test_tables_of_a_merging_format_are_merged(spark, folder, monkeypatch, newer_by):
    calls = []
    monkeypatch.setattr(jobs, "merge_into", lambda source, *rest: calls.append((source.columns, *rest)))
    house = Lakehouse(folder, merge_tables={"orders": "lake.orders"})
    orders = spark.createDataFrame([], ORDER).withColumn("more", F.lit(1))
    jobs.merge_table(orders, house, house.silver("orders"), spec.ORDERS, newer_by)
    assert calls == [(spec.ORDERS.columns, "lake.orders", "order_id", newer_by)]
    assert not exists(spark, house.silver("orders"))


def test_readers_see_a_merge_that_is_not_published(spark, folder, monkeypatch):
    """The merge staged its ranges and died: they are read from there, the others from the table."""
    table, path = spec.TableSpec("pairs", "k", ROW), f"{folder}/pairs"
    ranges.merge_ranges(rows(spark, *[(k, "a") for k in range(0, 50, 5)]), path, table, span=10)
    monkeypatch.setattr(ranges, "_publish", lambda *_: None)
    ranges.merge_ranges(rows(spark, (5, "b"), (31, "b"), (72, "b")), path, table, span=10)
    expected = {k: "a" for k in range(0, 50, 5)} | {5: "b", 31: "b", 72: "b"}
    assert sorted((r["k"], r["v"]) for r in ranges.read_ranges(spark, path, table).collect()) == sorted(expected.items())


def test_many_ranges_are_listed_by_few_tasks(spark, folder):
    """A task for each folder, kept by the driver, is too much where ranges are many; nor are listings kept."""
    table, path = spec.TableSpec("pairs", "k", ROW), f"{folder}/pairs"
    ranges.merge_ranges(rows(spark, *[(k, "a") for k in range(150)]), path, table, span=1)
    keys = ["spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.hive.filesourcePartitionFileCacheSize"]
    before, tracker = [spark.conf.get(k) for k in keys], spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        stored = ranges.read_ranges(spark, path, table)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert [s.numTasks for s in stages] == [100] and stored.count() == 150
    assert [spark.conf.get(k) for k in keys] == before


def test_only_the_named_tables_are_read(spark, folder, monkeypatch):
    """Reading a stored table lists its files, so those that are not needed are left alone."""
    read = []
    monkeypatch.setattr(jobs, "read_table", lambda spark, house, path, table: read.append(table.name))
    assert list(jobs.gold_tables(spark, Lakehouse(folder), "dim_customer")) == read == ["dim_customer"]
    jobs.gold_tables(spark, Lakehouse(folder))
    assert read[1:] == list(spec.GOLD_TABLES)


def test_staged_ranges_are_moved_into_the_table(spark, folder, monkeypatch):
    """No range is written twice, and one that died on the way is read and then completed."""
    table, path, publish = spec.TableSpec("pairs", "k", ROW), f"{folder}/pairs", ranges._publish
    files = lambda at: {f"{f.parent.name}/{f.name}" for f in Path(at).glob("key_range=*/*.parquet")}
    ranges.merge_ranges(rows(spark, *[(k, "a") for k in range(40)]), path, table, span=10)
    untouched, staged = files(path), set()
    monkeypatch.setattr(ranges, "_publish", lambda *_: staged.update(files(f"{path}.staged")))
    ranges.merge_ranges(rows(spark, (5, "b"), (15, "b"), (75, "b")), path, table, span=10)
    shutil.rmtree(f"{path}/key_range=1")  # half-way: one range is moved, one taken away and not yet replaced
    shutil.rmtree(f"{path}/key_range=0")
    shutil.move(f"{path}.staged/key_range=0", f"{path}/key_range=0")
    expected = {k: "a" for k in range(40)} | {5: "b", 15: "b", 75: "b"}
    for _ in range(2):
        assert {r["k"]: r["v"] for r in ranges.read_ranges(spark, path, table).collect()} == expected
        monkeypatch.setattr(ranges, "_publish", publish)
        ranges.merge_ranges(rows(spark), path, table, span=10)
    untouched = {f for f in untouched if not f.startswith(("key_range=0/", "key_range=1/"))}
    assert files(path) == untouched | staged and not exists(spark, f"{path}.staged")


def test_ranges_that_lie_apart_do_not_overflow_the_planner(spark):
    """A thousand intervals that cannot be joined."""
    target = spark.range(6000).select(F.col("id").alias("key_range"), F.lit("v").alias("v"))
    touched = ranges._touching(target, spark.range(0, 6000, 3).select(F.col("id").alias("key_range")))
    assert touched.agg(F.count("*"), F.min("key_range"), F.max("key_range")).first()[:] == (2000, 0, 5997)
    assert ranges._joined([(7, 9), (0, 2), (3, 3), (5, 5)]) == [(0, 3), (5, 5), (7, 9)]


def test_many_touched_ranges_are_pruned_by_few_intervals(spark, folder, monkeypatch):
    monkeypatch.setattr(ranges, "MOST_INTERVALS", 3)
    table, path = spec.TableSpec("pairs", "k", ROW), f"{folder}/pairs"
    ranges.merge_ranges(rows(spark, *[(k, "a") for k in range(200)]), path, table, span=10)
    target = spark.read.parquet(path)
    touched = ranges._touching(target, spark.createDataFrame([(0,), (1,), (12,), (19,)], "key_range long"))
    assert plan(touched).count("key_range#") and sorted({r["key_range"] for r in touched.collect()}) == [0, 1, 12, 19]
    assert len(target.inputFiles()) > 4
    ranges.merge_ranges(rows(spark, (3, "b"), (195, "b"), (1000, "b")), path, table, span=10)
    found = {r["k"]: r["v"] for r in ranges.read_ranges(spark, path, table).collect()}
    assert len(found) == 201 and sorted(k for k, v in found.items() if v == "b") == [3, 195, 1000]


def test_old_versions_are_retired(spark, folder):
    house = Lakehouse(folder, {"orders": 10})
    for v in "abc":
        jobs.write_snapshot(rows(spark, (1, v)), house.silver("customers"))
    (rows(spark, (1, "x")).write.parquet(f"{house.silver('customers')}/version=000003"))
    expired = jobs.retire(spark, house, keep=2)
    assert expired["customers"] == [0, 1] and expired["order_items"] == [] and "orders" not in expired
    assert [r["v"] for r in spark.read.parquet(f"{house.silver('customers')}/version=000002").collect()] == ["c"]
    with pytest.raises(ValueError, match="current"):
        jobs.retire(spark, house, keep=0)


def test_a_merge_decides_by_keys_alone_which_rows_stay(spark, folder, monkeypatch):
    """Without meeting rows in a join: all keys again, most of them, few of them, null ones and a repeated one."""
    monkeypatch.setattr(snapshots, "upsert", None)
    table = spec.TableSpec("pairs", "k", ROW)

    def merged(*values):
        version = snapshots.merge_snapshot(rows(spark, *values), folder, table)
        held = snapshots.read_snapshot(spark, folder, table)
        return version, sorted(((r["k"], r["v"]) for r in held.collect()), key=str)

    first = [(k, "a") for k in range(20)] + [(None, "a")]
    assert merged(*first) == (0, sorted(first, key=str))
    expected = {k: "b" for k in range(20)}
    nulls = [(None, "a"), (None, "b"), (None, "b")]
    assert merged(*expected.items(), (None, "b"), (None, "b")) == (1, sorted([*expected.items(), *nulls], key=str))
    for version, keys in ((2, range(3, 25)), (3, [7, 90])):
        expected |= {k: f"v{version}" for k in keys}
        assert merged(*[(k, f"v{version}") for k in keys]) == (version, sorted([*expected.items(), *nulls], key=str))
    for keys in ([*range(30), 4], [4, 4]):
        with pytest.raises(ValueError, match="repeated k: 4"):
            merged(*[(k, "z") for k in keys])
        assert snapshots.current_version(spark, folder) == 3
    assert merged() == (4, sorted([*expected.items(), *nulls], key=str))


def test_merged_keys_are_read_without_their_rows(spark, folder):
    rows(spark, (1, "a"), (2, "b")).write.parquet(f"{folder}/old")
    old = spark.read.parquet(f"{folder}/old")
    tally = key_tally(old.filter("k = 1"), old, "k")
    assert plan(tally).count("ReadSchema: struct<k:bigint>") == 2
    assert sorted(map(tuple, tally.collect())) == [(1, 1), (2, 0)]


def test_rows_are_compared_only_where_the_buckets_differ(spark, monkeypatch):
    looked = []
    exact = audit.differing_rows
    monkeypatch.setattr(audit, "differing_rows", lambda one, other: looked.append(one.count() + other.count()) or exact(one, other))
    values = [(i % 900, str(i % 7)) for i in range(3000)] + [(None, None)]
    one, other = rows(spark, *values).repartition(5), rows(spark, *reversed(values))
    names = ("first_rows", "second_rows", "rows_differing", "identical")
    assert audit.compare({"t": one}, {"t": other}).select(*names).first()[:] == (3001, 3001, 0, True)
    assert looked == []
    changed = other.filter("k <> 5 OR k IS NULL").unionByName(rows(spark, (2000, "x")))
    lost = one.filter("k = 5").count()
    found = audit.compare({"t": one}, {"t": changed}).select(*names).first()
    assert found[:] == (3001, 3002 - lost, lost + 1, False) and 0 < looked[0] < 300


def test_nested_rows_are_compared_themselves(spark):
    ddl = "k long, s struct<a: string, b: string>"
    one, other = (spark.createDataFrame([(1, s)], ddl) for s in (("x", None), (None, "x")))
    found = audit.compare({"t": one}, {"t": other}).first()
    assert (found["first_rows"], found["second_rows"], found["rows_differing"]) == (1, 1, 2)


def test_ranges_that_are_the_same_are_only_counted(spark, monkeypatch):
    same = rows(spark, *[(i % 400, str(i)) for i in range(1000)], (None, "n"))
    monkeypatch.setattr(fingerprints, "range_fingerprints", None)
    found = differing_ranges(same, same.repartition(3), "k", 10)
    assert found.filter("same").agg(F.count("*"), F.sum("first_rows"), F.sum("second_rows")).first()[:] == (41, 1001, 1001)


def test_keys_that_stay_the_same_are_not_tallied(spark, folder, monkeypatch):
    """Keys in equal buckets are left out of the tally; null keys never are."""
    table, tallied = spec.TableSpec("pairs", "k", ROW), []
    tally = snapshots.key_tally
    monkeypatch.setattr(snapshots, "key_tally", lambda *sides: tallied.append([s and s.count() for s in sides[:2]]) or tally(*sides))
    snapshots.merge_snapshot(rows(spark, *[(k, "a") for k in range(5000)]), folder, table)
    snapshots.merge_snapshot(rows(spark, *[(k, "b") for k in range(5000)]), folder, table)
    assert tallied.pop() == [0, 0]
    snapshots.merge_snapshot(rows(spark, *[(k, "c") for k in range(1, 5001)], (None, "c")), folder, table)
    offered, held = tallied.pop()
    assert 1 < offered < 50 and 1 <= held < 50
    snapshots.merge_snapshot(rows(spark, (None, "d"), *[(k, "d") for k in range(5001)]), folder, table)
    stored = snapshots.read_snapshot(spark, folder, table)
    assert {r[0]: r[1] for r in stored.groupBy("v").count().collect()} == {"c": 1, "d": 5002}
    assert stored.filter("k IS NULL").count() == 2


def test_stored_files_are_compressed_well(spark, folder):
    """Smaller by a quarter at least than the default codec leaves them."""
    wide = spark.range(200_000).select(F.col("id").alias("k"), F.md5(F.pmod("id", F.lit(900)).cast("string")).alias("v"), F.lit(None).cast("timestamp_ntz").alias("at"))
    wide.write.parquet(f"{folder}/plain")
    snapshots.merge_snapshot(wide, f"{folder}/pairs", spec.TableSpec("pairs", "k", ROW))
    size = {p: raw.file_inventory(spark, f"{folder}/{p}").first()["bytes"] for p in ("plain", "pairs")}
    assert size["pairs"] < 0.75 * size["plain"]


@pytest.mark.parametrize("key", ["key", "bucket", "offered", "staying"])
def test_columns_may_have_the_names_used_inside(spark, folder, key):
    names = ["key", "bucket", "offered", "staying", "key_range"]
    table = spec.TableSpec("named", key, ", ".join(f"{n} BIGINT" for n in names))

    def numbered(first, last, value):
        return spark.range(first, last).select(*[(F.col("id") if n == key else F.lit(value)).cast("long").alias(n) for n in names])

    for first, last, value in ((0, 40, 1), (1, 41, 2), (50, 52, 3)):
        snapshots.merge_snapshot(numbered(first, last, value), folder, table)
    merged = numbered(0, 1, 1).unionByName(numbered(1, 41, 2)).unionByName(numbered(50, 52, 3))
    stored = snapshots.read_snapshot(spark, folder, table)
    assert audit.compare({"t": merged}, {"t": stored}).first()["identical"]
    assert audit.compare({"t": merged}, {"t": stored.filter(f"{key} > 3")}).first()["rows_differing"] == 4
    assert differing_ranges(merged, stored.filter(f"{key} <> 3"), key, 10).filter("NOT same").count() == 1
