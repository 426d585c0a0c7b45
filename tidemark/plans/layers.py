"""The trusted layer as DataFrames: nothing runs until a result is asked for."""

from __future__ import annotations

from collections.abc import Mapping
from pyspark.sql import DataFrame

from tidemark import spec
from tidemark.operators.dedup import latest_by_key
from tidemark.operators.quality import validate
from tidemark.spec import TableSpec

Tables = Mapping[str, DataFrame]


def trusted(raw: DataFrame, table: TableSpec, dedup_first: bool = False) -> DataFrame:
    """Valid rows, the latest per key.

    By default a key whose newest row is invalid falls back to its newest valid
    row; with ``dedup_first`` such a key is dropped.
    """
    rows = table.conform(raw)
    if dedup_first:
        return validate(latest_by_key(rows, table.key, table.changed_at), table.rules)
    return latest_by_key(validate(rows, table.rules), table.key, table.changed_at)


def silver(raw: Tables, dedup_first: bool = False) -> dict[str, DataFrame]:
    """The trusted table of each raw table given."""
    return {name: trusted(rows, spec.SOURCE_TABLES[name], dedup_first) for name, rows in raw.items()}
