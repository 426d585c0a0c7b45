"""The registered queries: every operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions import expose_money, moment
from tidemark.operators import audit, changes, dedup, dimensions, facts, fingerprints, mart, quality, totals
from tidemark.operators.ranking import RFM_MEASURES
from tidemark.operators.upsert import upsert
from tidemark.plans import checks, jobs, layers
from tidemark.sources import catalog, checked, footers, ranges, raw, retail, snapshots
from tidemark.sources.shared import materialize, new_folder
from tidemark.streaming.pickup import pick_up

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2001, 8, 2)
RUN_TS = datetime(2001, 8, 2, 6, 0)

# Event windows: the second batch opens 15 minutes before the first one's end.
FIRST_WATERMARK = datetime(2024, 1, 1, 0, 0)
FIRST_END = datetime(2024, 1, 15, 12, 0)
SECOND_END = datetime(2024, 1, 31, 0, 0)

# A year of changes of the retail tables.
CHANGE_START = datetime(2000, 1, 1)
CHANGE_END = datetime(2001, 1, 1)

# Keys of one range of the large tables; more rows make more ranges.
KEYS_PER_RANGE = {"orders": 5_000, "order_items": 50_000, "fact_orders": 5_000, "fact_order_items": 50_000}

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _silver(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return layers.silver(retail.sources(spark, folder, *names))


def _dim_customer(tables: layers.Tables) -> DataFrame:
    return dimensions.dim_customer(tables["customers"], RUN_TS)


def _fact_orders(tables: layers.Tables) -> DataFrame:
    return facts.fact_orders(tables["orders"], tables["order_items"], _dim_customer(tables), RUN_TS)


def _fact_order_items(spark: SparkSession, tables: layers.Tables) -> DataFrame:
    products = dimensions.dim_product(spark, run_ts=RUN_TS)
    return facts.fact_order_items(
        tables["order_items"], tables["orders"], _dim_customer(tables), products, RUN_TS
    )


def _profile(spark: SparkSession, folder: str, keep_unknown: bool = False) -> DataFrame:
    tables = _silver(spark, folder)
    return mart.customer_profile(_fact_orders(tables), _dim_customer(tables), AS_OF, keep_unknown)


def _mart(spark: SparkSession, folder: str, method: str = "tiles", keep_unknown: bool = False) -> DataFrame:
    tables = _silver(spark, folder)
    return mart.build_mart(
        _fact_orders(tables), _dim_customer(tables), AS_OF, RUN_TS, method, keep_unknown
    )


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return retail.load(spark, folder, "events")


def _first_batch(events: DataFrame) -> DataFrame:
    return changes.changes(events, changes.window_start(FIRST_WATERMARK), FIRST_END, "ts")


def _second_batch(events: DataFrame) -> DataFrame:
    return changes.changes(events, changes.window_start(FIRST_END), SECOND_END, "ts")


# Extraction and control state -----------------------------------------------


@query
def extract_window(spark, folder):
    return _first_batch(_events(spark, folder))


@query
def extract_overlap(spark, folder):
    return _second_batch(_events(spark, folder))


@query
def extract_counts(spark, folder):
    changed = {n: changes.changes(t, CHANGE_START, CHANGE_END) for n, t in retail.sources(spark, folder).items()}
    return audit.with_total(audit.row_counts(changed))


@query
def extract_max_key(spark, folder):
    return audit.highest_key(retail.orders(spark, folder), "order_id")


def _control(events: DataFrame) -> DataFrame:
    """One pipeline per event type, its watermark the last event of the first batch."""
    seen = _first_batch(events).groupBy(F.col("event_type").alias("pipeline_name"))
    return spec.CONTROL.conform(
        seen.agg(F.max("ts").alias("last_watermark")).withColumns(
            {"last_run_at": moment(FIRST_END), "status": F.lit("new")}
        )
    )


@query
def watermark_read(spark, folder):
    control = changes.with_window_start(_control(_events(spark, folder)))
    return control.select("pipeline_name", "last_watermark", "window_start")


@query
def watermark_advance(spark, folder):
    events = _events(spark, folder)
    finished = _second_batch(events).filter(F.col("value") > 0).select("event_type").distinct()
    moved = finished.filter(F.col("event_type") != "error").select(
        F.col("event_type").alias("pipeline_name"),
        moment(SECOND_END).alias("last_watermark"),
        moment(SECOND_END).alias("last_run_at"),
    )
    return changes.advance_watermark(_control(events), moved)


@query
def incremental_reduction(spark, folder):
    events = _events(spark, folder)
    return audit.extract_reduction(events, _second_batch(events))


# Raw layer -------------------------------------------------------------------


@query
def bronze_roundtrip(spark, folder):
    events, root = _events(spark, folder), new_folder(spark, "raw")
    raw.write_batch(_first_batch(events), root, "events", FIRST_END)
    raw.write_batch(_second_batch(events), root, "events", SECOND_END)
    return raw.read_raw(spark, root, "events", with_partitions=True)


@query
def bronze_union_batches(spark, folder):
    events, root = _events(spark, folder), new_folder(spark, "raw")
    raw.write_batch(_first_batch(events).drop("props"), root, "events", FIRST_END)
    raw.write_batch(_second_batch(events).drop("user_id"), root, "events", SECOND_END)
    return raw.read_raw(spark, root, "events", merge_schema=True).select(*events.columns)


@query
def batch_concat(spark, folder):
    events = _events(spark, folder)
    return raw.union_batches(_first_batch(events).drop("props"), _second_batch(events).drop("user_id"))


# Validation -------------------------------------------------------------------


def _validated(spark, folder, name):
    table = spec.SOURCE_TABLES[name]
    return expose_money(quality.validate(retail.SOURCES[name](spark, folder), table.rules))


@query
def validate_orders(spark, folder):
    return _validated(spark, folder, "orders")


@query
def validate_customers(spark, folder):
    return _validated(spark, folder, "customers")


@query
def validate_items(spark, folder):
    return _validated(spark, folder, "order_items")


@query
def rule_drop_counts(spark, folder):
    whole = None
    for name, table in spec.SOURCE_TABLES.items():
        counts = quality.drop_counts(retail.SOURCES[name](spark, folder), table.rules)
        counts = counts.select(F.lit(name).alias("table_name"), "*")
        whole = counts if whole is None else whole.unionByName(counts)
    return whole


@query
def rejected_orders(spark, folder):
    return expose_money(quality.rejected(retail.orders(spark, folder), spec.ORDERS.rules))


@query
def leak_check(spark, folder):
    return checks.leak_report(retail.sources(spark, folder))


@query
def quality_gate(spark, folder):
    house = jobs.Lakehouse(new_folder(spark, "gate"))
    raw.write_batch(retail.orders(spark, folder), house.raw, "orders", CHANGE_END)
    return checks.quality_gate(spark, house, RUN_TS)


def _checked(spark, folder, *names):
    """The raw layer of the named tables and their rows, stored by the first rule each breaks."""
    house = jobs.Lakehouse(new_folder(spark, "checked"))
    for name in names:
        raw.write_batch(retail.SOURCES[name](spark, folder), house.raw, name, CHANGE_END)
    return house, {name: jobs.check_raw(spark, house, spec.SOURCE_TABLES[name]) for name in names}


@query
def quarantine_rows(spark, folder):
    """The rejected orders, read from where the check stored them."""
    house, _ = _checked(spark, folder, "orders")
    return expose_money(jobs.rejected_rows(spark, house, spec.ORDERS))


@query
def quarantine_counts(spark, folder):
    """Drop counts of all tables from the same files as the trusted rows and the rejects."""
    whole = None
    for name, rows in _checked(spark, folder, *spec.SOURCE_TABLES)[1].items():
        counts = checked.stored_drop_counts(rows, spec.SOURCE_TABLES[name])
        counts = counts.select(F.lit(name).alias("table_name"), "*")
        whole = counts if whole is None else whole.unionByName(counts)
    return whole


# Deduplication and the trusted layer --------------------------------------------


@query
def dedup_latest(spark, folder):
    return expose_money(dedup.latest_by_key(retail.order_items(spark, folder), "item_id"))


@query
def dedup_counts(spark, folder):
    whole = None
    for name, table in spec.SOURCE_TABLES.items():
        counts = dedup.duplicate_counts(retail.SOURCES[name](spark, folder), table.key)
        counts = counts.select(F.lit(name).alias("table_name"), "*")
        whole = counts if whole is None else whole.unionByName(counts)
    return whole


@query
def silver_orders(spark, folder):
    return expose_money(_silver(spark, folder, "orders")["orders"])


@query
def silver_customers(spark, folder):
    return _silver(spark, folder, "customers")["customers"]


@query
def silver_order_items(spark, folder):
    return expose_money(_silver(spark, folder, "order_items")["order_items"])


@query
def silver_items_dedup_first(spark, folder):
    items = retail.order_items(spark, folder)
    return expose_money(layers.trusted(items, spec.ORDER_ITEMS, dedup_first=True))


@query
def stream_pickup(spark, folder):
    """Orders landed in two batches and picked up by the stream, the second with changed statuses."""
    house = jobs.Lakehouse(new_folder(spark, "stream"))
    first = retail.orders(spark, folder)
    late = changes.changes(first, CHANGE_START, CHANGE_END).withColumn("status", F.lit("delivered"))
    late = late.withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 1 DAY"))
    for rows, end in ((first, CHANGE_START), (late, CHANGE_END)):
        raw.write_batch(rows, house.raw, "orders", end)
        pick_up(spark, house, spec.ORDERS).awaitTermination()
    return expose_money(jobs.read_table(spark, house, house.silver("orders"), spec.ORDERS))


EVENTS = spec.TableSpec(
    name="events",
    key="event_id",
    ddl="event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    rules={"key_present": "event_id IS NOT NULL"},
    changed_at="ts",
)


@query
def stream_overlap(spark, folder):
    """Two windows that overlap by 15 minutes, picked up one after the other without the replayed rows."""
    house, events = jobs.Lakehouse(new_folder(spark, "overlap")), _events(spark, folder)
    for rows, end in ((_first_batch(events), FIRST_END), (_second_batch(events), SECOND_END)):
        raw.write_batch(rows, house.raw, "events", end)
        pick_up(spark, house, EVENTS, replays_within="20 days").awaitTermination()
    return jobs.read_table(spark, house, house.silver("events"), EVENTS)


# Upsert ---------------------------------------------------------------------------


def _upsert_batches(spark, folder):
    orders = quality.validate(retail.orders(spark, folder), spec.ORDERS.rules)
    target = orders.filter(F.col("updated_at") < moment(datetime(2000, 1, 1)))
    source = orders.filter(F.col("updated_at") >= moment(datetime(1999, 7, 1)))
    return target, source.withColumn("status", F.lit("delivered"))


@query
def upsert_orders(spark, folder):
    return expose_money(upsert(*_upsert_batches(spark, folder), "order_id", nullable_key=False))


@query
def upsert_key_ranges(spark, folder):
    """The same upsert, on a stored table split into key ranges."""
    path = new_folder(spark, "ranges")
    for rows in _upsert_batches(spark, folder):
        ranges.merge_ranges(rows, path, spec.ORDERS, span=KEYS_PER_RANGE["orders"])
    return expose_money(ranges.read_ranges(spark, path, spec.ORDERS))


@query
def scd1_customer(spark, folder):
    customers = _silver(spark, folder, "customers")["customers"]
    known = customers.filter(F.col("updated_at") < moment(datetime(1995, 4, 1)))
    changed = customers.filter(F.col("updated_at") >= moment(datetime(1995, 3, 1)))
    changed = changed.withColumns({"tier": F.lit("enterprise"), "email": F.concat(F.lit("new."), F.trim("email"))})
    return upsert(
        dimensions.dim_customer(known, FIRST_END),
        dimensions.dim_customer(changed, SECOND_END),
        "customer_key",
        nullable_key=False,
    )


@query
def snapshot_counts(spark, folder):
    """Three writes of orders, one of customers, none of order items."""
    root = new_folder(spark, "snapshots")
    tables = _silver(spark, folder, "orders", "customers")
    old, new = (tables["orders"].filter(c) for c in ("customer_id % 2 = 0", "customer_id % 2 = 1"))
    for rows in (old, new, old):
        snapshots.merge_snapshot(rows, f"{root}/orders", spec.ORDERS)
    snapshots.merge_snapshot(tables["customers"], f"{root}/customers", spec.CUSTOMERS)
    states = [snapshots.snapshot_state(spark, f"{root}/{n}", t) for n, t in spec.SOURCE_TABLES.items()]
    return states[0].unionByName(states[1]).unionByName(states[2])


# Dimensions and facts -----------------------------------------------------------------


@query
def dim_customer(spark, folder):
    return _dim_customer(_silver(spark, folder, "customers"))


@query
def dim_product(spark, folder):
    """Each generated product with the lines and units the trusted items hold for it."""
    products = dimensions.dim_product(spark, run_ts=RUN_TS)
    sold = _silver(spark, folder, "order_items")["order_items"].groupBy("product_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units")
    )
    return products.join(sold, "product_id", "left").select(
        *products.columns,
        F.coalesce("lines", F.lit(0)).alias("lines"),
        F.coalesce("units", F.lit(0)).alias("units"),
    )


def _order_calendar(spark, folder):
    """Calendar over the whole years the order dates span."""
    return dimensions.calendar(dimensions.date_span(retail.load(spark, folder, "orders"), "o_orderdate"))


@query
def dim_date(spark, folder):
    return _order_calendar(spark, folder)


@query
def dim_date_iso(spark, folder):
    span = dimensions.date_span(retail.load(spark, folder, "lineitem"), "l_shipdate")
    return dimensions.calendar(span, iso_weekday=True)


@query
def item_counts(spark, folder):
    return facts.item_counts(_silver(spark, folder, "order_items")["order_items"])


@query
def fact_orders(spark, folder):
    return expose_money(_fact_orders(_silver(spark, folder)))


@query
def fact_order_items(spark, folder):
    return expose_money(_fact_order_items(spark, _silver(spark, folder)))


@query
def unresolved_keys(spark, folder):
    tables = _silver(spark, folder)
    orders = facts.unresolved_counts(_fact_orders(tables), "fact_orders", ["customer_key"])
    items = facts.unresolved_counts(
        _fact_order_items(spark, tables), "fact_order_items", ["customer_key", "product_key"]
    )
    return orders.unionByName(items)


@query
def fact_by_calendar(spark, folder):
    orders = _fact_orders(_silver(spark, folder))
    return facts.by_calendar(orders, _order_calendar(spark, folder))


# Mart -------------------------------------------------------------------------------------


@query
def customer_profile(spark, folder):
    return expose_money(_profile(spark, folder))


SCORED = ["customer_key", *[m.value for m in RFM_MEASURES], *[m.score for m in RFM_MEASURES]]


@query
def rfm_ntile_scores(spark, folder):
    return expose_money(mart.score_profile(_profile(spark, folder)).select(*SCORED))


@query
def rfm_null_scores(spark, folder):
    """Tiles where every third customer has no recency."""
    recency = F.when(F.col("customer_key") % 3 != 0, F.col("recency_days"))
    profile = _profile(spark, folder).withColumn("recency_days", recency)
    return expose_money(mart.score_profile(profile).select(*SCORED))


@query
def rfm_pct_scores(spark, folder):
    scored = mart.score_profile(_profile(spark, folder, keep_unknown=True), "percentile")
    return expose_money(scored.select(*SCORED))


@query
def rfm_mart(spark, folder):
    return expose_money(_mart(spark, folder))


@query
def rfm_mart_pct(spark, folder):
    return expose_money(_mart(spark, folder, "percentile", keep_unknown=True))


@query
def mart_validation(spark, folder):
    return mart.mart_metrics(_mart(spark, folder))


@query
def segment_distribution(spark, folder):
    return mart.distribution(_mart(spark, folder), "rfm_segment")


@query
def churn_distribution(spark, folder):
    return mart.distribution(_mart(spark, folder), "churn_risk")


# Audits -----------------------------------------------------------------------------------


@query
def layer_row_counts(spark, folder):
    sources = retail.sources(spark, folder)
    silver = layers.silver(sources)
    tables = {f"bronze_{n}": t for n, t in sources.items()}
    tables |= {f"silver_{n}": t for n, t in silver.items()}
    tables["gold_dim_customer"] = _dim_customer(silver)
    tables["gold_fact_orders"] = _fact_orders(silver)
    tables["gold_fact_order_items"] = _fact_order_items(spark, silver)
    return audit.row_counts(tables)


@query
def idempotency_check(spark, folder):
    """Source to mart as stored tables, the second half run twice."""
    house = jobs.Lakehouse(new_folder(spark, "lakehouse"))
    sources = retail.sources(spark, folder)
    first, last = audit.change_bounds(sources.values(), "updated_at")
    jobs.start_pipeline(spark, house, "retail", first - timedelta(days=1))
    jobs.extract(spark, house, sources, "retail", last + timedelta(days=1))
    return checks.idempotency(spark, house, AS_OF, RUN_TS)


# Increments ---------------------------------------------------------------------------------

PIPELINE = "retail"


def _started(spark, sources: layers.Tables, label: str) -> tuple[jobs.Lakehouse, datetime, datetime]:
    """A new lakehouse with key ranges, and the first and the last change of the sources."""
    house = jobs.Lakehouse(new_folder(spark, label), KEYS_PER_RANGE)
    first, last = audit.change_bounds(sources.values(), "updated_at")
    jobs.start_pipeline(spark, house, PIPELINE, first - timedelta(days=1))
    return house, first, last


def _run(spark, house: jobs.Lakehouse, sources: layers.Tables, end: datetime) -> None:
    jobs.run(spark, house, sources, PIPELINE, end, AS_OF, RUN_TS)


@query
def end_to_end_run(spark, folder):
    """Source to mart in three batches: half of the time, the rest, and one that finds nothing new."""
    sources = retail.sources(spark, folder)
    house, first, last = _started(spark, sources, "batches")
    for end in (first + (last - first) / 2, last, last + timedelta(days=1)):
        _run(spark, house, sources, end.replace(microsecond=0))
    return expose_money(jobs.read_table(spark, house, house.gold(spec.MART.name), spec.MART))


def _late_orders(orders: DataFrame, at: datetime) -> DataFrame:
    """A year's orders again: delivered, at twice the amount, every third for the next customer."""
    late = changes.changes(orders, CHANGE_START, CHANGE_END)
    moved = F.when(F.col("order_id") % 3 == 0, F.col("customer_id") + 1).otherwise(F.col("customer_id"))
    amount = (F.col("total_amount") * 2).cast("decimal(12,2)")
    return late.withColumns({"customer_id": moved, "status": F.lit("delivered"), "total_amount": amount, "updated_at": moment(at)})


@query
def profile_delta(spark, folder):
    """Customer profiles from totals that a second batch of late changes only corrects."""
    sources = retail.sources(spark, folder)
    house, _, last = _started(spark, sources, "late-orders")
    _run(spark, house, sources, last)
    late, end = _late_orders(sources["orders"], last + timedelta(days=1)), last + timedelta(days=2)
    _run(spark, house, sources | {"orders": sources["orders"].unionByName(late)}, end)
    totals_ = jobs.read_table(spark, house, house.gold(spec.CUSTOMER_TOTALS.name), spec.CUSTOMER_TOTALS)
    customers = jobs.gold_tables(spark, house, "dim_customer")["dim_customer"]
    return expose_money(mart.profile_of_totals(totals_, customers, AS_OF))


@query
def totals_change(spark, folder):
    """The totals of all customers, the late changes taken in as a difference without any job around it."""
    tables = _silver(spark, folder)
    late = quality.validate(_late_orders(retail.orders(spark, folder), RUN_TS), spec.ORDERS.rules)
    customers = _dim_customer(tables)
    after = tables | {"orders": upsert(tables["orders"], late, "order_id", nullable_key=False)}
    facts_before, facts_after = _fact_orders(tables), _fact_orders(after)
    touched = late.select("order_id")
    delta = totals.totals_delta(*(f.join(touched, "order_id", "left_semi") for f in (facts_before, facts_after)))
    held = totals.customer_totals(facts_before)
    changed = totals.apply_delta(held, delta, facts_after)
    merged = upsert(held, changed.select(*held.columns), "customer_key", nullable_key=False)
    return merged.filter("total_orders > 0")


@query
def late_customers(spark, folder):
    """Facts without a customer before and after a batch brings a third of the customers."""
    sources = retail.sources(spark, folder)
    house, _, last = _started(spark, sources, "late-customers")
    known = F.col("customer_id") % 3 != 0
    arriving = sources["customers"].filter(~known).withColumn("updated_at", moment(last + timedelta(days=1)))
    _run(spark, house, sources | {"customers": sources["customers"].filter(known)}, last)

    def unresolved(name: str) -> DataFrame:
        stored = jobs.gold_tables(spark, house, "fact_orders", "fact_order_items")
        counts = [facts.unresolved_counts(fact, f, ["customer_key"]) for f, fact in stored.items()]
        return counts[0].unionByName(counts[1]).select("fact", F.col("unresolved").alias(name))

    before = materialize(unresolved("before"), "unresolved")
    _run(spark, house, sources | {"customers": arriving}, last + timedelta(days=2))
    return before.join(unresolved("after"), "fact").withColumn("fell", F.col("after") < F.col("before"))


# Stored layers --------------------------------------------------------------------------------


def _lakehouse(spark, folder) -> jobs.Lakehouse:
    """All sources as a lakehouse, source to mart."""
    house, sources = jobs.Lakehouse(new_folder(spark, "lakehouse")), retail.sources(spark, folder)
    first, last = audit.change_bounds(sources.values(), "updated_at")
    jobs.start_pipeline(spark, house, PIPELINE, first - timedelta(days=1))
    _run(spark, house, sources, last)
    return house


@query
def stored_row_counts(spark, folder):
    """The rows of every stored layer, from the footers of its files alone."""
    house = _lakehouse(spark, folder)
    paths = {f"bronze_{n}": f"{house.raw}/{n}" for n in spec.SOURCE_TABLES}
    paths |= {f"silver_{n}": house.silver(n) for n in spec.SOURCE_TABLES}
    paths |= {f"gold_{n}": house.gold(n) for n in ("dim_customer", "fact_orders", "fact_order_items")}
    return footers.stored_row_counts(spark, paths)


@query
def mart_reports(spark, folder):
    """Both distributions and the validation figures from one stored mart."""
    house = _lakehouse(spark, folder)
    stored = jobs.results(spark, house)[spec.MART.name]
    labels = [
        mart.distribution(stored, label).select(F.lit(label).alias("report"), F.col(label).alias("label"), F.col("customers").cast("double").alias("value"))
        for label in ("rfm_segment", "churn_risk")
    ]
    metrics = mart.mart_metrics(stored).select(F.lit("metric").alias("report"), F.col("metric").alias("label"), "value")
    return labels[0].unionByName(labels[1]).unionByName(metrics)


@query
def idempotency_ranges(spark, folder):
    """Source to mart, the second half run twice, compared by the fingerprints of key ranges."""
    house, sources = jobs.Lakehouse(new_folder(spark, "lakehouse")), retail.sources(spark, folder)
    first, last = audit.change_bounds(sources.values(), "updated_at")
    jobs.start_pipeline(spark, house, PIPELINE, first - timedelta(days=1))
    jobs.extract(spark, house, sources, PIPELINE, last + timedelta(days=1))
    return checks.idempotency_by_range(spark, house, AS_OF, RUN_TS, span=1000)


@query
def changed_keys(spark, folder):
    """Orders against a copy with lost, repeated, changed and new rows; the ranges tell where to look."""
    orders = _silver(spark, folder, "orders")["orders"]
    part = F.col("order_id") % 50
    first = orders.filter(part != 3)
    amount = F.when(part == 2, F.col("total_amount") + 1).otherwise(F.col("total_amount"))
    second = orders.filter(part != 0).withColumn("total_amount", amount.cast("decimal(12,2)"))
    second = second.unionByName(orders.filter(part == 1))
    return fingerprints.differing_keys(first, second, "order_id", span=10)


def _with_schema(spark, build):
    """Run ``build`` in a new schema of the session catalog, and go back to the one before."""
    before, place = spark.catalog.currentDatabase(), new_folder(spark, "schema")
    catalog.use_schema(spark, place.rsplit("/", 1)[1].replace("-", "_"), location=place)
    try:
        return build()
    finally:
        spark.catalog.setCurrentDatabase(before)


@query
def catalog_tables(spark, folder):
    """Raw orders registered as an external table, made trusted into a typed table, read back by name."""

    def build():
        house = jobs.Lakehouse(new_folder(spark, "external"))
        raw.write_batch(retail.orders(spark, folder), house.raw, "orders", CHANGE_END)
        landed = catalog.register_parquet(spark, "raw_orders", f"{house.raw}/orders")
        catalog.create_typed(spark, "trusted_orders", spec.ORDERS, "Orders that pass all rules")
        layers.trusted(landed, spec.ORDERS).write.insertInto("trusted_orders")
        return spark.table("trusted_orders")

    return expose_money(_with_schema(spark, build))


@query
def catalog_registry(spark, folder):
    """Each catalog table with its rows and whether it was created; asking again creates nothing."""

    def build():
        tables = _silver(spark, folder, "customers", "order_items")
        once = {f"{n}_as": catalog.create_as(t, f"{n}_as") for n, t in tables.items()}
        again = {n: catalog.create_as(spark.range(3), n) for n in once}
        catalog.create_typed(spark, "dim_customer", spec.DIM_CUSTOMER)
        catalog.create_typed(spark, "dim_customer", spec.DIM_PRODUCT)
        counts = audit.row_counts({n: spark.table(n) for n in (*once, "dim_customer")})
        columns = [F.when(F.col("table_name") == n, len(spark.table(n).columns)) for n in (*once, "dim_customer")]
        made = F.col("table_name").isin([n for n in once if once[n] and not again[n]])
        return counts.withColumns({"columns": F.coalesce(*columns), "created_once": made})

    return _with_schema(spark, build)


@query
def file_inventory(spark, folder):
    """Files, rows and bytes of two batches by the files' metadata, the bytes against a listing."""
    root, orders = new_folder(spark, "raw"), retail.orders(spark, folder)
    written = {CHANGE_START: 8, CHANGE_END: 3}
    for end, files in written.items():
        raw.write_batch(orders.repartition(files), root, "orders", end)
    found = raw.batch_inventory(spark, root, "orders")
    listed = raw.file_inventory(spark, root).select(F.col("bytes").alias("listed"))
    total = found.agg(F.sum("bytes").alias("total")).join(listed).select((F.col("total") == F.col("listed")).alias("bytes_match"))
    return found.select("batch", "files", "rows").join(total)


@query
def extract_empty_window(spark, folder):
    """A year's changes by prefixed source names; tables without any leave no folder."""
    house, sources = jobs.Lakehouse(new_folder(spark, "windows")), retail.sources(spark, folder)
    jobs.start_pipeline(spark, house, PIPELINE, CHANGE_START + timedelta(minutes=spec.OVERLAP_MINUTES))
    prefixed = {f"shop_{name}": rows for name, rows in sources.items()}
    rows = jobs.extract(spark, house, prefixed, PIPELINE, CHANGE_END, table_prefix="shop_").rows
    landed = [(n, count, raw.raw_exists(spark, house.raw, spec.SOURCE_TABLES[n])) for n, count in rows.items()]
    return spark.createDataFrame(landed, "table_name string, row_count long, landed boolean")
