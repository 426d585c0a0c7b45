"""Rule-based validation: ordered named conditions, null counts as broken."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rules = Mapping[str, "str | Column"]

# The label of rows that break no rule.
PASSED = "passed"


def _condition(rule: str | Column) -> Column:
    return F.expr(rule) if isinstance(rule, str) else rule


def first_broken(rules: Rules) -> Column:
    """Name of the first rule the row breaks, null when it passes all of them."""
    broken = [
        F.when(F.coalesce(_condition(rule), F.lit(False)), F.lit(None)).otherwise(F.lit(name))
        for name, rule in rules.items()
    ]
    return F.coalesce(*broken, F.lit(None).cast("string"))


def _tallies(rules: Rules) -> list[Column]:
    broken = first_broken(rules)
    return [F.count(F.when(broken == name, 1)).alias(name) for name in rules]


def validate(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows that pass every rule.

    The filter is the plain conjunction of the conditions, so Catalyst can push
    it into the scan.
    """
    return df.filter(reduce(Column.__and__, [_condition(r) for r in rules.values()], F.lit(True)))


def rejected(df: DataFrame, rules: Rules, column: str = "broken_rule") -> DataFrame:
    """The rows that fail, each with the first rule it breaks."""
    return df.withColumn(column, first_broken(rules)).filter(F.col(column).isNotNull())


def labelled(df: DataFrame, rules: Rules, column: str = "broken_rule") -> DataFrame:
    """Every row with the first rule it breaks, or ``passed``."""
    return df.withColumn(column, F.coalesce(first_broken(rules), F.lit(PASSED)))


def drop_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule, in order, with the rows it drops (zero included).

    One pass that reads only the columns the rules name. It is a query of its
    own and not an observation on the validated plan: map tasks that run again
    after a lost executor would be observed twice.
    """
    if not rules:
        return df.sparkSession.createDataFrame([], "rule_order int, rule string, dropped long")
    counted = df.agg(*_tallies(rules))
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("rule_order"), F.lit(name).alias("rule"), F.col(name).alias("dropped"))
            for i, name in enumerate(rules, 1)
        ]
    )
    return counted.select(F.inline(rows))


def leaked(table: DataFrame, bad: DataFrame) -> DataFrame:
    """Rows of a trusted table that are known to be bad, alike in all its columns; should be empty."""
    return table.intersect(bad.select(*table.columns))
