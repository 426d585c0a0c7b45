"""Every registered query against DuckDB, and the known figures of the test data."""

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.plans.queries import REGISTRY

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(medium):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{medium}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((value is None, str(value)) for value in row))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_oracle(spark, duck, medium, name):
    result = REGISTRY[name](spark, medium)
    names = sorted(result.columns)
    actual = ordered(tuple(row) for row in result.select(*names).collect())
    expected = duck.execute(f"SELECT {', '.join(names)} FROM ({contract.oracle_sql()[name]})")
    types = {column[0]: str(column[1]) for column in expected.description}
    assert {f.name: SPARK_TYPES[f.dataType.simpleString()] for f in result.schema} == types
    assert actual == ordered(expected.fetchall())
    assert actual


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_is_the_mart(spark):
    mart = contract.entry(spark)
    assert len(mart.columns) == 20
    assert mart.count() > 0


def test_known_figures(spark, medium):
    mart = REGISTRY["rfm_mart"](spark, medium)
    totals = mart.groupBy().sum("total_orders", "total_items").first()
    assert (mart.count(), *totals) == (1171, 11498, 34177)
    segments = {r["rfm_segment"]: r["customers"] for r in REGISTRY["segment_distribution"](spark, medium).collect()}
    assert segments == {
        "Champions": 246, "Lost": 202, "Potential Loyalists": 183, "Hibernating": 151,
        "Loyal Customers": 139, "New Customers": 121, "At Risk": 81, "Cannot Lose Them": 48,
    }
    churn = {r["churn_risk"]: r["customers"] for r in REGISTRY["churn_distribution"](spark, medium).collect()}
    assert churn == {"HIGH": 809, "MEDIUM": 230, "LOW": 132}


def test_known_figures_of_the_layers(spark, medium):
    dropped = {
        (r["table_name"], r["rule"]): r["dropped"] for r in REGISTRY["rule_drop_counts"](spark, medium).collect()
    }
    assert dropped["customers", "email_present"] == 29
    assert dropped["customers", "tier_known"] == 300
    assert dropped["orders", "amount_positive"] == 149
    assert dropped["orders", "status_known"] == 153
    unresolved = {
        (r["fact"], r["key_name"]): r["unresolved"] for r in REGISTRY["unresolved_keys"](spark, medium).collect()
    }
    assert unresolved["fact_orders", "customer_key"] == 3200
    upserted = REGISTRY["upsert_orders"](spark, medium)
    assert upserted.count() == 14698
    assert upserted.filter("status = 'delivered'").count() == 6743
