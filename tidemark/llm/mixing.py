"""Mixing to target weights by iterative proportional fitting, in DataFrame functions only.

Documents fall into cells of source, language and topic. Each cell's share of
the words is raked: scaled to the target marginal of one dimension after the
other, until all marginals fit. A cell's weight over its present share gives
the probability with which its documents are kept. The probabilities are scaled
to keep a wanted share of all words; where that would ask for more than all of a
cell, the cell is kept whole and the others make up for it.

Only the cells are shuffled while raking, never the documents. Their number is
bounded by the number of different values, not of documents.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import names_apart
from tidemark.sources.shared import materialize

DIMENSIONS = ["source", "lang", "topic"]
# A marginal's target is its present share to this power, scaled to 1: less of the large, more of the small.
FLATTEN = 0.7
KEEP_SHARE = 0.85
SWEEPS_AT_ONCE = 4
TOLERANCE = 1e-6
LEAST_GAIN = 0.01  # of the largest miss, by which some sweeps must lessen it
NONE = "(none)"

# Topics by what a text has; the first that fits. Patterns and names are parameters of ``topic``.
TOPICS = {
    "licence": r"(?i)\b(license|licensed|rights reserved)\b",
    "contact": r"@[A-Za-z0-9]|\(\d{3}\)",
    "figures": r"\d",
    "loud": r"!!|[A-Z]{5}",
}
OTHERWISE = "prose"


def topic(text: str = "text", topics: dict[str, str] = TOPICS, otherwise: str = OTHERWISE) -> Column:
    """The text's topic; null texts have none."""
    chosen = F.when(F.col(text).isNull(), F.lit(None).cast("string"))
    for name, pattern in topics.items():
        chosen = chosen.when(F.col(text).rlike(pattern), name)
    return chosen.otherwise(otherwise)


def words(text: str = "text") -> Column:
    """A document's weight in words; every document has one at least."""
    return F.greatest(F.size(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+")), F.lit(1)).cast("long")


def flattened_targets(cells: DataFrame, dimension: str, power: float = FLATTEN) -> DataFrame:
    """``dimension, _target``: shares of the words to the given power, scaled to 1."""
    sums = cells.groupBy(dimension).agg(F.sum("words").cast("double").alias("_sum"))
    raised = sums.withColumn("_target", F.pow("_sum", F.lit(power)))
    total = F.sum("_target").over(Window.partitionBy(F.lit(1)))
    return raised.select(dimension, (F.col("_target") / total).alias("_target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """``weight`` of each cell, with the target marginals.

    ``targets`` has for each dimension a DataFrame ``dimension, _target``; a value
    that is not among them gets no weight, and targets of values without words
    are spread over the others. Sweeps go on while they bring the marginals nearer
    to their targets. Where these contradict each other (cells that are all empty)
    that ends before they are met: the last sweep is returned with a warning.
    """
    state = cells.withColumn("weight", F.col("words").cast("double"))
    for name, target in targets.items():
        known = target.select(name, F.col("_target").alias(f"_t_{name}"))
        state = state.join(known, name, "left").fillna(0.0, [f"_t_{name}"])
    state = materialize(state, "rake")
    miss = float("inf")
    while miss > TOLERANCE:
        for _ in range(SWEEPS_AT_ONCE):
            for name in targets:
                own = F.sum("weight").over(Window.partitionBy(name))
                state = state.withColumn("weight", F.when(own > 0, F.col("weight") * F.col(f"_t_{name}") / own).otherwise(0.0))
        state = materialize(state, "rake")
        last, miss = miss, _largest_miss(state, list(targets))
        if TOLERANCE < miss and miss > last * (1 - LEAST_GAIN):
            warnings.warn(f"the targets contradict each other: a marginal misses its target by {miss:.6f}", stacklevel=2)
            break
    return state.select(*cells.columns, "weight")


def _largest_miss(state: DataFrame, names: list[str]) -> float:
    """The most by which a marginal misses its target; one row reaches the driver."""
    misses = [
        state.groupBy(n).agg(F.abs(F.sum("weight") - F.first(f"_t_{n}")).alias("miss")).agg(F.max("miss").alias("miss"))
        for n in names
    ]
    return reduce(DataFrame.unionByName, misses).agg(F.max("miss")).first()[0] or 0.0


def probabilities(weighted: DataFrame, keep_share: float = KEEP_SHARE) -> DataFrame:
    """Add ``probability`` to the cells: min(1, scale * weight / words), with ``keep_share`` of all words expected.

    The scale is found among the cells in descending order of that ratio: it
    belongs to the smallest number of whole cells that leaves none above 1.
    """
    ratio = F.when(F.col("words") > 0, F.col("weight") / F.col("words")).otherwise(0.0)
    cells = weighted.withColumn("_ratio", ratio)
    by_ratio = Window.orderBy(F.desc("_ratio"), *DIMENSIONS).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    whole = F.coalesce(F.sum("words").over(by_ratio), F.lit(0))
    lighter = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0.0))
    wanted = F.sum("words").over(every) * keep_share
    scale = F.when(lighter > 1e-12, (wanted - whole) / lighter)
    tried = cells.withColumn("_scale", scale).withColumn("_fits", F.col("_scale") * F.col("_ratio") <= 1)
    best = F.max(F.when(F.col("_fits") & (F.col("_scale") >= 0), F.col("_scale"))).over(every)
    probability = F.least(F.lit(1.0), F.coalesce(best, F.lit(0.0)) * F.col("_ratio"))
    return tried.withColumn("probability", F.when(F.col("_ratio") > 0, probability).otherwise(0.0)).drop(
        "_ratio", "_scale", "_fits"
    )


@names_apart
def mix(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    targets: dict[str, dict[str, float]] | None = None,
    keep_share: float = KEEP_SHARE,
    seed: int = 7,
) -> DataFrame:
    """Add topic, words, weight (the cell's), probability and sampled to every document.

    ``targets`` gives shares for some dimensions (``{"lang": {"en": 0.5, ...}}``);
    the others are flattened. A null source, language or topic is the value
    ``(none)``. A document is sampled by a hash of its id (its text, if it has
    no id) and the seed, so repeated rows are sampled together and a run can be
    repeated. Columns with the added names are replaced; an empty table stays so.
    """
    spark = df.sparkSession
    made = ["topic", "words", "weight", "probability", "sampled"]
    named = df.drop(*made).withColumns({"topic": F.coalesce(topic(text), F.lit(NONE)), "words": words(text)})
    cell = [F.coalesce(F.col(d), F.lit(NONE)).alias(d) for d in DIMENSIONS]
    cells = materialize(named.groupBy(*cell).agg(F.sum("words").alias("words")), "mixing-cells")
    goals = {}
    for d in DIMENSIONS:
        if targets and d in targets:
            goals[d] = spark.createDataFrame(list(targets[d].items()), f"{d} string, _target double")
        else:
            goals[d] = flattened_targets(cells, d)
    rated = materialize(probabilities(rake(cells, goals), keep_share), "mixing-rates")
    rates = rated.select(*[F.col(d).alias(f"_{d}") for d in DIMENSIONS], "weight", "probability")
    same = reduce(Column.__and__, [F.coalesce(F.col(d), F.lit(NONE)) == F.col(f"_{d}") for d in DIMENSIONS])
    chance = F.pmod(F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.col(text)), F.lit(seed)), F.lit(1 << 53)) / (1 << 53)
    joined = named.join(rates, same).drop(*[f"_{d}" for d in DIMENSIONS])
    return joined.withColumn("sampled", chance < F.col("probability"))


@names_apart
def sampled(df: DataFrame, **options) -> DataFrame:
    """The sampled documents, with their own columns."""
    return mix(df, **options).filter("sampled").select(*df.columns)
