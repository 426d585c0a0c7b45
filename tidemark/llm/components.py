"""Connected components of a graph stored as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.shared import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of the edges ``a, b``; the label is the component's smallest node.

    Each round every node is merged into its smallest neighbour and the edges are
    drawn again between the merged nodes, until none is left. The graph is only
    ever stored in the shared folder.
    """
    left = materialize(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = left.select(F.col("a").alias("node")).union(left.select("b")).distinct().withColumn("label", F.col("node"))
    labels = materialize(labels, "labels")
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("nearest"))
        parents = parents.select("node", F.least("node", "nearest").alias("parent"))
        parents = materialize(parents, "parents")
        moved = labels.join(parents.withColumnRenamed("node", "label"), "label", "left")
        labels = materialize(moved.select("node", F.coalesce("parent", "label").alias("label")), "labels")
        to = left.join(parents.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a")
        to = to.join(parents.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b").filter("pa <> pb")
        left = materialize(to.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    return labels
