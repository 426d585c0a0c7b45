"""Validation, deduplication and labels on small frames."""

from datetime import date, datetime

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions import as_cents, churn_band, from_cents, mean_cents, moment, product_label, rfm_segment
from tidemark.operators.dedup import duplicate_counts, latest_by_key
from tidemark.operators.dimensions import calendar, date_span, dim_customer, dim_date, dim_product
from tidemark.operators.quality import drop_counts, first_broken, leaked, rejected, validate
from tidemark.operators.audit import differing_rows
from tidemark.plans.layers import trusted
from tidemark.sources.retail import order_items

DAY = datetime(2024, 5, 1)


def orders(spark, rows):
    """Rows of (order_id, status, amount, updated day)."""
    full = [(k, 1, status, amount, "North", DAY, datetime(2024, 5, day)) for k, status, amount, day in rows]
    ddl = spec.ORDERS.ddl.replace("DECIMAL(12,2)", "DOUBLE")
    return spec.ORDERS.conform(spark.createDataFrame(full, ddl))


ROWS = [
    (1, "pending", 10.0, 1),
    (2, "lost", -1.0, 1),  # breaks two rules, counts for the first
    (3, "lost", 5.0, 1),
    (None, "pending", 5.0, 1),
    (4, None, 5.0, 1),
    (5, "shipped", None, 1),
    (6, "shipped", 0.0, 1),
]


def test_rules_count_the_first_one_broken(spark):
    df = orders(spark, ROWS)
    counts = {r["rule"]: r["dropped"] for r in drop_counts(df, spec.ORDERS.rules).collect()}
    assert counts == {"key_present": 1, "amount_positive": 3, "status_known": 2}
    broken = {r["order_id"]: r["broken_rule"] for r in rejected(df, spec.ORDERS.rules).collect()}
    assert broken[2] == "amount_positive"
    assert broken[4] == "status_known"


def test_validate_keeps_what_breaks_nothing(spark):
    df = orders(spark, ROWS)
    kept = validate(df, spec.ORDERS.rules)
    assert [r["order_id"] for r in kept.collect()] == [1]
    assert df.filter(first_broken(spec.ORDERS.rules).isNull()).exceptAll(kept).isEmpty()


def test_rules_may_be_columns(spark):
    df = orders(spark, ROWS)
    assert validate(df, {"small": F.col("total_amount") < 6, "known": "order_id > 2"}).count() == 3


def test_validation_reaches_the_scan(spark, folder):
    orders(spark, ROWS).write.parquet(folder + "/orders")
    plan = validate(spark.read.parquet(folder + "/orders"), spec.ORDERS.rules)
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(total_amount,0" in scan
    assert "In(status, [" in scan


def test_leaked_compares_rows_not_keys(spark):
    table = orders(spark, [(1, "pending", 5.0, 2), (2, "shipped", -7.0, 3), (3, None, 1.0, 1)])
    bad = orders(spark, [(1, "pending", -5.0, 1), (2, "shipped", -7.0, 3), (3, None, 1.0, 1), (9, "pending", 0.0, 1)])
    assert sorted(r["order_id"] for r in leaked(table, bad).collect()) == [2, 3]


def test_latest_wins_and_ties_are_settled(spark):
    rows = [(1, "pending", 1.0, 1), (1, "shipped", 1.0, 3), (1, "delivered", 1.0, 2)]
    rows += [(2, "pending", 5.0, 2), (2, "pending", 7.0, 2), (2, "confirmed", 9.0, 2)]
    for order in (rows, rows[::-1]):
        latest = {r["order_id"]: r for r in latest_by_key(orders(spark, order), "order_id").collect()}
        assert latest[1]["status"] == "shipped"
        assert (latest[2]["status"], float(latest[2]["total_amount"])) == ("pending", 7.0)


def test_a_null_change_time_loses(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, DAY, "b")], "id long, updated_at timestamp_ntz, v string")
    assert latest_by_key(df, "id").first()["v"] == "b"


def test_newest_row_invalid(spark):
    """Validate first falls back to the older valid row; dedup first loses the key."""
    df = orders(spark, [(1, "pending", 5.0, 1), (1, "lost", 5.0, 2), (2, "pending", 5.0, 1)])
    assert {r["order_id"] for r in trusted(df, spec.ORDERS).collect()} == {1, 2}
    assert {r["order_id"] for r in trusted(df, spec.ORDERS, dedup_first=True).collect()} == {2}


def test_duplicate_counts_take_null_as_one_key(spark):
    df = orders(spark, [(1, "a", 1.0, 1), (1, "a", 1.0, 1), (None, "a", 1.0, 1), (None, "a", 1.0, 1)])
    assert tuple(duplicate_counts(df, "order_id").first()) == (4, 2, 2)
    assert tuple(duplicate_counts(df.filter("false"), "order_id").first()) == (0, 0, 0)


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    df = orders(spark, ROWS)
    plan = latest_by_key(df, "order_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("[max(struct") < plan.index("Exchange") < plan.index("[partial_max(struct")


def test_latest_is_row_number_one(spark, small):
    items = order_items(spark, small)
    others = [c for c in items.columns if c not in ("item_id", "updated_at")]
    order = [F.col(c).desc_nulls_last() for c in ["updated_at", *others]]
    numbered = items.withColumn("n", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    assert differing_rows(latest_by_key(items, "item_id"), numbered.filter("n = 1").drop("n")).isEmpty()


def test_latest_of_a_composite_key(spark):
    df = spark.createDataFrame([(1, 1, "a", DAY), (1, 2, "b", DAY), (1, 1, "c", DAY)], "x int, y int, v string, updated_at timestamp_ntz")
    assert {tuple(r)[:3] for r in latest_by_key(df, ["x", "y"]).collect()} == {(1, 1, "c"), (1, 2, "b")}


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(
            st.one_of(st.none(), st.integers(1, 4)),
            st.sampled_from(["pending", "lost"]),
            st.integers(-1, 3),
            st.integers(1, 4),
        ),
        min_size=1,
        max_size=25,
    )
)
def test_trusted_against_pandas(spark, rows):
    df = orders(spark, [(k, s, float(a), d) for k, s, a, d in rows])
    frame = pd.DataFrame(rows, columns=["k", "s", "a", "d"]).dropna(subset=["k"])
    frame = frame[(frame["a"] > 0) & (frame["s"] == "pending")]
    expected = {int(k): int(g["d"].max()) for k, g in frame.groupby("k")}
    actual = {r["order_id"]: r["updated_at"].day for r in trusted(df, spec.ORDERS).collect()}
    assert actual == expected


def test_every_score_has_a_segment(spark):
    cube = [(r, f, m) for r in range(1, 6) for f in range(1, 6) for m in range(1, 6)]
    df = spark.createDataFrame(cube, "r_score int, f_score int, m_score int")
    named = {tuple(r[:3]): r[3] for r in df.withColumn("s", rfm_segment()).collect()}
    assert set(named.values()) == {*spec.RFM_SEGMENTS, spec.RFM_SEGMENT_OTHERWISE}
    assert named[5, 5, 1] == "Champions"
    assert named[4, 1, 5] == "New Customers"
    assert named[4, 3, 3] == "Potential Loyalists"
    assert named[3, 5, 1] == "Loyal Customers"
    assert named[2, 3, 2] == "At Risk"
    assert named[1, 2, 3] == "Cannot Lose Them"
    assert named[2, 2, 2] == "Lost"
    assert named[3, 1, 5] == "Hibernating"


def test_churn_edges(spark):
    df = spark.createDataFrame([(30,), (31,), (90,), (91,)], "d int")
    assert [r[0] for r in df.select(churn_band(F.col("d"))).collect()] == ["LOW", "MEDIUM", "MEDIUM", "HIGH"]


def test_money_is_exact(spark):
    df = spark.sql("SELECT 0.05BD AS a, 2.675BD AS b, 0.10BD AS c").select(
        as_cents(F.col("a")).alias("cents"), from_cents(F.lit(267)).alias("back")
    )
    assert tuple(map(str, df.first())) == ("5", "2.67")
    halves = spark.createDataFrame([(5, 2), (3, 2), (10, 3), (11, 3), (1, 3)], "cents long, n long")
    assert [r[0] for r in halves.select(mean_cents(F.col("cents"), F.col("n"))).collect()] == [3, 2, 3, 4, 0]


def test_moment_ignores_time_zones(spark):
    at = datetime(2024, 3, 31, 2, 30, 1, 250)
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert spark.range(1).select(moment(at)).first()[0] == at
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_calendar(spark):
    days = dim_date(spark)
    assert days.count() == 1461
    assert days.dtypes == spec.DIM_DATE.conform(days).dtypes
    first = days.filter("date_key = 20240101").first()
    assert (first["day_of_week"], first["day_name"], first["week_of_year"], first["is_weekend"]) == (2, "Monday", 1, False)
    assert dim_date(spark, iso_weekday=True).filter("date_key = 20240101").first()["day_of_week"] == 1
    pandas_days = pd.date_range("2024-01-01", "2027-12-31")
    rows = dim_date(spark, iso_weekday=True).orderBy("date_key").collect()
    assert [r["day_of_week"] for r in rows] == list(pandas_days.dayofweek + 1)
    assert [r["week_of_year"] for r in rows] == list(pandas_days.isocalendar().week)
    assert [r["quarter"] for r in rows] == list(pandas_days.quarter)
    assert [r["month_name"] for r in rows] == list(pandas_days.strftime("%B"))


def test_calendar_of_data(spark):
    df = spark.createDataFrame([(datetime(2023, 2, 3),), (datetime(2024, 1, 1),)], "at timestamp_ntz")
    days = calendar(date_span(df, "at")).agg(F.min("full_date"), F.max("full_date"), F.count("*")).first()
    assert tuple(days) == (date(2023, 1, 1), date(2024, 12, 31), 731)
    assert calendar(date_span(df.filter("false"), "at")).count() == 0


def test_products(spark):
    products = {r["product_key"]: r for r in dim_product(spark).collect()}
    assert len(products) == 200
    edges = {k: products[k]["category"] for k in (1, 50, 51, 100, 101, 150, 151, 200)}
    assert list(edges.values()) == [
        "Electronics", "Electronics", "Clothing", "Clothing",
        "Home & Kitchen", "Home & Kitchen", "Books & Media", "Books & Media",
    ]
    assert products[77]["product_name"] == "Clothing Item 77"
    beyond = spark.range(500, 501).select(product_label(F.col("id"))).first()[0]
    assert beyond == "Book or Media 500"


def test_customer_attributes_are_cleaned(spark):
    row = (7, "  A@B.Com ", " Ann ", "North", "premium", DAY, DAY)
    dim = dim_customer(spark.createDataFrame([row], spec.CUSTOMERS.schema), DAY).first()
    assert (dim["customer_key"], dim["email"], dim["name"], dim["is_current"]) == (7, "a@b.com", "Ann", True)
    assert dim["effective_from"] == dim["dw_inserted_at"] == DAY


def test_load_time_defaults_to_now(spark):
    dim = dim_customer(spark.createDataFrame([], spec.CUSTOMERS.schema))
    assert dict(dim.dtypes)["dw_inserted_at"] == "timestamp_ntz"


@pytest.mark.parametrize("table", list(spec.GOLD_TABLES.values()) + list(spec.SOURCE_TABLES.values()))
def test_contracts_have_their_key(table):
    assert table.key in table.columns
