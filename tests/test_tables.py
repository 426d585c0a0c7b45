"""Upserts, snapshots, key ranges, raw batches, catalog tables."""

from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.operators.facts import fact_orders, item_counts
from tidemark.operators.upsert import merge_into, upsert
from tidemark.session import settings
from tidemark.sources import ranges, raw
from tidemark.sources.catalog import create_as, create_typed, register_parquet, save_bucketed, use_schema
from tidemark.sources.jdbc import jdbc_options
from tidemark.sources.shared import exists, materialize, shared_dir
from tidemark.sources.snapshots import (
    current_version, merge_snapshot, read_snapshot, snapshot_state, versions, write_snapshot,
)
from tidemark.spec import TableSpec

PAIRS = TableSpec("pairs", "k", "k BIGINT, v STRING, updated_at TIMESTAMP_NTZ")


def pairs(spark, *rows):
    return spark.createDataFrame([(k, v, datetime(2024, 1, d)) for k, v, d in rows], PAIRS.schema)


def content(df):
    return sorted(((r["k"], r["v"]) for r in df.collect()), key=str)


def test_upsert_replaces_adds_and_keeps(spark):
    target = pairs(spark, (1, "a", 1), (2, "b", 1))
    source = pairs(spark, (2, "B", 1), (3, "C", 1)).select("v", "updated_at", "k")
    assert content(upsert(target, source, "k")) == [(1, "a"), (2, "B"), (3, "C")]


def test_null_keys_match_nothing(spark):
    target, source = pairs(spark, (None, "a", 1)), pairs(spark, (None, "b", 1), (None, "c", 1), (1, "d", 1))
    assert content(upsert(target, source, "k")) == [(1, "d"), (None, "a"), (None, "b"), (None, "c")]


def test_rows_without_a_key_are_not_shuffled(spark, folder):
    for name in ("target", "source"):
        pairs(spark, (None, "a", 1), (1, "b", 1)).write.parquet(f"{folder}/{name}")
    target, source = (spark.read.parquet(f"{folder}/{n}") for n in ("target", "source"))
    assert content(upsert(target, source, "k")) == [(1, "b"), (None, "a"), (None, "a")]
    plan = upsert(target, source, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Filter isnull(k") == 2
    assert content(upsert(target, source, "k", nullable_key=False)) == content(upsert(target, source, "k"))


def test_repeated_source_key_fails(spark):
    source = pairs(spark, (1, "a", 1), (1, "b", 1))
    with pytest.raises(PySparkException, match="repeated k: 1"):
        upsert(pairs(spark), source, "k").collect()


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_upsert_scans_and_shuffles_each_side_once(spark, folder):
    """Also where the source is checked for repeated keys and older rows are kept back."""
    for name, rows in (("target", [(1, "a", 1), (2, "b", 1)]), ("source", [(2, "B", 1), (3, "C", 1)])):
        pairs(spark, *rows).withColumn("copy", F.lit(0)).withColumn("offered", F.lit(0)).write.parquet(f"{folder}/{name}")
    target, source = (spark.read.parquet(f"{folder}/{n}") for n in ("target", "source"))
    for newer_by in (None, "updated_at"):
        merged = upsert(target, source, "k", newer_by, nullable_key=False)
        assert scans(merged) == 2
        assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        assert merged.columns == target.columns and merged.count() == 3


def test_upsert_needs_equal_columns(spark):
    with pytest.raises(ValueError, match="columns differ"):
        upsert(pairs(spark), pairs(spark).drop("v"), "k")


def test_newer_target_rows_stay(spark):
    target = pairs(spark, (1, "newer", 5), (2, "older", 1), (3, "same", 2))
    source = pairs(spark, (1, "late", 4), (2, "fresh", 2), (3, "again", 2), (4, "added", 1))
    merged = upsert(target, source, "k", newer_by="updated_at")
    assert content(merged) == [(1, "newer"), (2, "fresh"), (3, "again"), (4, "added")]


def test_upsert_is_idempotent(spark):
    target, source = pairs(spark, (1, "a", 1), (2, "b", 1)), pairs(spark, (2, "B", 1), (3, "C", 1))
    once = upsert(target, source, "k")
    assert content(upsert(once, source, "k")) == content(once)


def test_merge_needs_a_format_that_supports_it(spark):
    pairs(spark).write.mode("overwrite").saveAsTable("plain_pairs")
    with pytest.raises(PySparkException):
        merge_into(pairs(spark, (1, "a", 1)), "plain_pairs", "k")


def test_snapshots_keep_versions(spark, folder):
    assert current_version(spark, folder) == -1
    assert tuple(snapshot_state(spark, folder, PAIRS).first()) == ("pairs", 0, -1)
    assert read_snapshot(spark, folder, PAIRS).count() == 0
    assert merge_snapshot(pairs(spark, (1, "a", 1)), folder, PAIRS) == 0
    assert merge_snapshot(pairs(spark, (1, "A", 1), (2, "b", 1)), folder, PAIRS) == 1
    assert versions(spark, folder) == [0, 1]
    assert content(read_snapshot(spark, folder, PAIRS)) == [(1, "A"), (2, "b")]
    assert content(read_snapshot(spark, folder, PAIRS, version=0)) == [(1, "a")]
    assert tuple(snapshot_state(spark, folder, PAIRS).first()) == ("pairs", 2, 1)


def test_an_unfinished_snapshot_is_not_read(spark, folder):
    write_snapshot(pairs(spark, (1, "a", 1)), folder)
    pairs(spark, (9, "half", 1)).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{folder}/version=000001")
    assert content(read_snapshot(spark, folder, PAIRS)) == [(1, "a")]
    assert write_snapshot(pairs(spark, (2, "b", 1)), folder) == 1
    assert content(read_snapshot(spark, folder, PAIRS)) == [(2, "b")]


def test_ranges_rewrite_only_what_they_touch(spark, folder):
    path = f"{folder}/pairs"
    ranges.merge_ranges(pairs(spark, (1, "a", 1), (12, "b", 1), (25, "c", 1), (-3, "n", 1)), path, PAIRS, span=10)

    def files(key_range):
        table = spark.read.parquet(path).filter(F.col("key_range") == key_range)
        return sorted(r[0] for r in table.select("_metadata.file_path").distinct().collect())

    untouched, touched = files(0) + files(2), files(1)
    ranges.merge_ranges(pairs(spark, (12, "B", 2), (13, "d", 1)), path, PAIRS, span=10)
    assert files(0) + files(2) == untouched
    assert files(1) != touched
    expected = [(1, "a"), (12, "B"), (13, "d"), (25, "c"), (-3, "n")]
    assert content(ranges.read_ranges(spark, path, PAIRS)) == sorted(expected, key=str)
    assert not exists(spark, f"{path}.staged")


def test_ranges_finish_what_a_dead_run_staged(spark, folder):
    path = f"{folder}/pairs"
    ranges.merge_ranges(pairs(spark, (1, "a", 1), (12, "b", 1)), path, PAIRS, span=10)
    staged = pairs(spark, (12, "B", 2), (14, "e", 2)).withColumn("key_range", F.lit(1).cast("bigint"))
    staged.write.partitionBy("key_range").parquet(f"{path}.staged")
    ranges.merge_ranges(pairs(spark, (2, "z", 1)), path, PAIRS, span=10)
    expected = [(1, "a"), (2, "z"), (12, "B"), (14, "e")]
    assert content(ranges.read_ranges(spark, path, PAIRS)) == sorted(expected, key=str)


def test_ranges_refuse_another_span(spark, folder):
    path = f"{folder}/pairs"
    ranges.merge_ranges(pairs(spark, (5, "a", 1), (25, "b", 1)), path, PAIRS, span=10)
    with pytest.raises(ValueError, match="ranges of 10 keys"):
        ranges.merge_ranges(pairs(spark, (25, "B", 2)), path, PAIRS, span=100)
    assert content(ranges.read_ranges(spark, path, PAIRS)) == sorted([(5, "a"), (25, "b")], key=str)


def test_first_write_refuses_repeated_keys(spark, folder):
    twice = pairs(spark, (1, "a", 1), (1, "b", 2))
    with pytest.raises(Exception, match="repeated"):
        ranges.merge_ranges(twice, f"{folder}/ranges", PAIRS, span=10)
    with pytest.raises(Exception, match="repeated"):
        merge_snapshot(twice, f"{folder}/snapshots", PAIRS)
    assert read_snapshot(spark, f"{folder}/snapshots", PAIRS).count() == 0


def test_ranges_of_nothing(spark, folder):
    path = f"{folder}/pairs"
    assert ranges.read_ranges(spark, path, PAIRS).count() == 0
    ranges.merge_ranges(pairs(spark), path, PAIRS, span=10)
    assert ranges.read_ranges(spark, path, PAIRS).count() == 0


def test_ranges_keep_newer_rows(spark, folder):
    path = f"{folder}/pairs"
    ranges.merge_ranges(pairs(spark, (1, "newer", 5)), path, PAIRS, span=10)
    ranges.merge_ranges(pairs(spark, (1, "late", 4)), path, PAIRS, span=10, newer_by="updated_at")
    assert content(ranges.read_ranges(spark, path, PAIRS)) == [(1, "newer")]


def test_raw_layout(spark, folder):
    end = datetime(2024, 6, 5, 8, 0, 9)
    path = raw.write_batch(pairs(spark, (1, "a", 1)), folder, "pairs", end)
    assert path == f"{folder}/pairs/year=2024/month=06/day=05/batch=20240605_080009"
    for table in (PAIRS, "pairs"):
        row = raw.read_raw(spark, folder, table, with_partitions=True).first()
        assert (row["year"], row["month"], row["day"], row["batch"]) == ("2024", "06", "05", "20240605_080009")
    assert raw.read_raw(spark, folder, PAIRS).columns == PAIRS.columns


def test_raw_appends_and_prunes(spark, folder):
    for day, key in ((1, 1), (2, 2), (3, 3)):
        raw.write_batch(pairs(spark, (key, "a", day)), folder, "pairs", datetime(2024, 6, day))
    raw.write_batch(pairs(spark, (3, "again", 3)), folder, "pairs", datetime(2024, 6, 3))
    assert raw.read_raw(spark, folder, PAIRS).count() == 4
    later = raw.read_raw(spark, folder, PAIRS, after="20240602_000000")
    assert {r["k"] for r in later.collect()} == {3}
    scan = later._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in scan


def test_raw_columns_meet_by_name(spark, folder):
    raw.write_batch(pairs(spark, (1, "a", 1)).select("v", "k"), folder, "pairs", datetime(2024, 6, 1))
    extra = pairs(spark, (2, "b", 1)).withColumn("more", F.lit(5))
    raw.write_batch(extra, folder, "pairs", datetime(2024, 6, 2))
    merged = {r["k"]: r for r in raw.read_raw(spark, folder, "pairs", merge_schema=True).collect()}
    assert (merged[1]["v"], merged[1]["more"], merged[2]["more"]) == ("a", None, 5)
    assert {r["k"]: r["updated_at"] for r in raw.read_raw(spark, folder, PAIRS).collect()}[1] is None


def test_file_inventory(spark, folder):
    for day in (1, 2):
        raw.write_batch(pairs(spark, (day, "a", 1)).coalesce(1), folder, "pairs", datetime(2024, 6, day))
    found = raw.file_inventory(spark, folder).first()
    assert found["files"] == 2
    assert found["bytes"] > 0
    assert tuple(raw.file_inventory(spark, f"{folder}/pairs/year=2024/month=06/day=01").first())[0] == 1


def test_catalog_tables(spark, folder):
    use_schema(spark, "layers")
    try:
        raw.write_batch(pairs(spark, (1, "a", 1)), folder, "pairs", datetime(2024, 6, 1))
        assert register_parquet(spark, "raw_pairs", f"{folder}/pairs").count() == 1
        assert register_parquet(spark, "raw_pairs", f"{folder}/elsewhere").count() == 1
        create_typed(spark, "typed", spec.ORDERS, "Orders. It's one row per order.")
        create_typed(spark, "typed", PAIRS)
        assert spark.table("typed").columns == spec.ORDERS.columns
        assert spark.catalog.getTable("typed").description == "Orders. It's one row per order."
        assert create_as(pairs(spark, (1, "a", 1)), "built")
        assert not create_as(pairs(spark, (2, "b", 1)), "built")
        assert content(spark.table("built")) == [(1, "a")]
        assert spark.catalog.currentDatabase() == "layers"
    finally:
        spark.sql("USE default")
        spark.sql("DROP SCHEMA layers CASCADE")


def test_bucketed_tables_join_without_a_shuffle(spark, medium):
    from tidemark.sources import retail

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders = save_bucketed(retail.orders(spark, medium), "bucketed_orders", "order_id", 8)
        items = save_bucketed(retail.order_items(spark, medium), "bucketed_items", "order_id", 8)
        counted = orders.join(item_counts(items), "order_id", "left")
        assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
        assert counted.count() == orders.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_customer_is_split(spark, folder):
    """A third of all orders belong to one customer: adaptive execution splits that join partition."""
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000)
    noise = F.sha2(F.col("id").cast("string"), 512)
    spark.range(0, 300_000, numPartitions=8).select(
        F.col("id").alias("order_id"), hot.alias("customer_id"), noise.alias("status"),
        F.lit(1).cast("decimal(12,2)").alias("total_amount"), noise.alias("region"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("created_at"),
        F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at"),
    ).write.parquet(f"{folder}/orders")
    spark.range(5000).selectExpr("id AS customer_id", "id AS customer_key").write.parquet(f"{folder}/customers")
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB",
    }
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        items = spark.createDataFrame([(1, 1)], "item_id long, order_id long")
        orders, customers = (spark.read.parquet(f"{folder}/{t}") for t in ("orders", "customers"))
        fact = fact_orders(orders, items, customers, datetime(2024, 1, 1))
        assert len(fact.collect()) == 300_000
        assert "skew=true" in fact._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in changed:
            spark.conf.unset(key)


def test_materialize_uses_the_shared_folder(spark):
    stored = materialize(pairs(spark, (1, "a", 1), (2, "b", 1)), "pairs")
    assert all(shared_dir(spark) in f for f in stored.inputFiles())
    assert content(stored) == [(1, "a"), (2, "b")]
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(
        getConf=lambda: {}, getCheckpointDir=lambda: None, master="yarn"
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(SimpleNamespace(sparkContext=context))


def test_settings_follow_the_shuffle():
    assert settings(cores=8)["spark.sql.shuffle.partitions"] == "8"
    assert settings(cores=4000, shuffle_bytes=10 * 2**40)["spark.sql.shuffle.partitions"] == "40960"


def test_jdbc_options_split_on_the_key():
    options = jdbc_options("jdbc:x", "orders", "order_id", (1, 900), 8, user="reader")
    assert options["partitionColumn"] == "order_id"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("1", "900", "8")
    assert options["user"] == "reader"
