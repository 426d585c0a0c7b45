"""Near-duplicate vectors by spherical-cap filters with exact link counts.

1. Equal vectors are one node with a weight.
2. A filter is a direction; a node passes those it has a large inner product
   with. The directions are a random product code: each joins one of a few random
   unit vectors in every block of coordinates, so a node's filters are decoded
   from its inner products with the blocks' vectors, without looking at all.
   How large the product must be and how many directions there are follows from
   the number of nodes, so that a filter is passed by some tens of them and a pair
   at the least cosine meets in several filters on average.
3. Nodes that share a filter are compared in double precision. A pair counts in
   the first filter that both pass, so it counts once.
4. Where a filter is passed by more nodes than one task should compare, these
   are first gathered in balls: nodes so near to a common centre that any two of
   them are linked for certain. Other nodes are compared with the centre of a
   ball, and with its members only where the centre leaves it open. What then
   still is too large is cut into blocks, every two of which meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.sources.shared import materialize

COSINE = 0.9
PASSING = 32  # nodes that pass a filter, were all directions alike
MEETINGS = 10.0  # filters that two nodes at the least cosine share, on average
MOST_COMPARED = 512
_MOST_WORDS = 512
CODES = 24
_LEAST_LENGTH = 16
_SEED = 20
_MARGIN = 1e-7  # angle, far above rounding errors
_ENTRY = "length int, filter long, node long, weight long, filters binary, vector binary"


class _Design(NamedTuple):
    height: float
    blocks: int
    words: int


@lru_cache(maxsize=64)
def design(nodes: int, length: int, cosine: float) -> _Design:
    """The least product with a filter's direction, the blocks and the vectors in each of them."""
    length = max(length, _LEAST_LENGTH)
    grid = np.linspace(-1, 1, 4001)

    def above(dimensions: int) -> np.ndarray:
        """How likely a random unit vector has a coordinate of at least each value of the grid."""
        weight = (1 - grid**2) ** ((dimensions - 3) / 2)
        return np.cumsum(weight[::-1])[::-1] / weight.sum()

    caps, caps_across = above(length), above(length - 1)
    height = float(grid[np.searchsorted(-caps, -min(0.25, PASSING / max(nodes, 1)))])
    x = grid[(grid >= height) & (grid < 1)]
    density = (1 - x**2) ** ((length - 3) / 2) / ((1 - grid**2) ** ((length - 3) / 2)).sum()
    across = np.clip((height - cosine * x) / np.sqrt(max(1 - cosine**2, 1e-12) * (1 - x**2)), -1, 1)
    both = float((density * np.interp(across, grid, caps_across)).sum())
    filters = MEETINGS / max(both, 1e-15) / CODES
    blocks = next((m for m in range(2, 8) if filters ** (1 / m) <= _MOST_WORDS), 8)
    return _Design(height, blocks, max(2, int(np.ceil(filters ** (1 / blocks)))))


@lru_cache(maxsize=4 * CODES)
def _code(number: int, length: int, blocks: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """A random rotation to a length that the blocks divide, and the vectors of each block."""
    padded = -(-max(length, _LEAST_LENGTH) // blocks) * blocks
    random = np.random.default_rng([_SEED, number])
    rotation, _ = np.linalg.qr(random.standard_normal((padded, padded)))
    vectors = random.standard_normal((blocks, words, padded // blocks))
    vectors /= np.linalg.norm(vectors, axis=2, keepdims=True) * np.sqrt(blocks)
    return rotation[:length], vectors


def decode(units: np.ndarray, plan: _Design) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a row of ``units`` and a filter it passes, sorted."""
    found = [_decoded(units, plan, number) for number in range(CODES)]
    row, filters = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((filters, row))
    return row[order], filters[order]


def _decoded(units: np.ndarray, plan: _Design, number: int) -> tuple[np.ndarray, np.ndarray]:
    """Those of one code: block by block its vectors are joined to what was chosen so
    far, where the best of the blocks to come can still reach the height."""
    rotation, vectors = _code(number, units.shape[1], plan.blocks, plan.words)
    turned = (units @ rotation).reshape(len(units), plan.blocks, -1)
    products = [turned[:, k] @ vectors[k].T for k in range(plan.blocks)]
    best = np.zeros((plan.blocks + 1, len(units)))
    for k in range(plan.blocks - 1, -1, -1):
        best[k] = best[k + 1] + products[k].max(axis=1)
    row, chosen, total = np.arange(len(units)), np.full(len(units), number, dtype=np.int64), np.zeros(len(units))
    for k in range(plan.blocks):
        sums = total[:, None] + products[k][row]
        at, word = np.nonzero(sums >= (plan.height - best[k + 1][row])[:, None])
        row, chosen, total = row[at], chosen[at] * plan.words + word, sums[at, word]
    return row, chosen


def _units(vectors: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length as rows of length 1."""
    values = np.frombuffer(b"".join(vectors), dtype=kind).reshape(len(vectors), -1).astype(np.float64)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _alike(vectors: list[bytes]) -> Iterator[np.ndarray]:
    """The places of the vectors of each length."""
    lengths = np.array([len(x) for x in vectors])
    for length in np.unique(lengths):
        yield np.flatnonzero(lengths == length)


def _entries(nodes: DataFrame, n: int, kind: str, cosine: float) -> DataFrame:
    """A row for each node and filter it passes, with all the node's filters."""
    size = np.dtype(kind).itemsize

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(2).to_pylist()
            for alike in _alike(every):
                for part in np.array_split(alike, -(-len(alike) // 512)):
                    vectors = [every[i] for i in part]
                    length = len(vectors[0]) // size
                    row, filters = decode(_units(vectors, kind), design(n, length, cosine))
                    own = [x.tobytes() for x in np.split(filters, np.searchsorted(row, np.arange(1, len(part))))]
                    at = pa.array(part[row])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(row), length, dtype=np.int32)),
                            pa.array(filters),
                            *(batch.column(i).take(at) for i in (0, 1)),
                            pa.array(own, pa.binary()).take(pa.array(row)),
                            batch.column(2).take(at),
                        ],
                        names=["length", "filter", "node", "weight", "filters", "vector"],
                    )

    return nodes.select("node", "weight", "vector").mapInArrow(spread, _ENTRY)


def _compared(entries: DataFrame, sizes: DataFrame | None, kind: str, cosine: float) -> DataFrame:
    """``node, links, root``: of each group the weights each node is linked with, and a node of the same component."""
    if sizes is None:
        placed = entries.withColumns({"block": F.lit(0), "i": F.lit(0), "j": F.lit(0)})
    else:
        blocks = sizes.select("length", "filter", F.ceil(F.col("n") / MOST_COMPARED * 2).cast("int").alias("blocks"))
        placed = entries.join(blocks, ["length", "filter"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        placed = placed.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        placed = placed.withColumns({"i": F.least("block", "met"), "j": F.greatest("block", "met")})
    rows = F.collect_list(F.struct("node", "weight", "block", "filters", "vector"))
    groups = placed.groupBy("length", "filter", "i", "j").agg(rows.alias("rows")).filter(F.size("rows") > 1)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crossing = (batch.column(1).to_numpy() != batch.column(2).to_numpy()).tolist()
            for filter_, cross, group in zip(batch.column(0).to_pylist(), crossing, batch.column(3), strict=True):
                found = _links_within(filter_, cross, group.values, kind, cosine)
                if found is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["node", "links", "root"])

    return groups.select("filter", "i", "j", "rows").mapInArrow(compare, "node long, links long, root long")


def _links_within(filter_: int, cross: bool, rows: pa.StructArray, kind: str, cosine: float) -> tuple | None:
    units = _units(rows.field(4).to_pylist(), kind)
    hits = units @ units.T >= cosine
    np.fill_diagonal(hits, False)
    if cross:
        block = rows.field(2).to_numpy()
        hits &= block[:, None] != block[None]
    at = np.flatnonzero(hits.any(axis=1))
    if not len(at):
        return None
    hits = hits[np.ix_(at, at)]
    node, weight = (rows.field(i).to_numpy()[at] for i in (0, 1))
    every = [np.frombuffer(x, dtype=np.int64) for x in rows.field(3).take(pa.array(at)).to_pylist()]
    before = [x[: np.searchsorted(x, filter_)] for x in every]
    names, inverse, times = np.unique(np.concatenate(before), return_inverse=True, return_counts=True)
    shared = np.cumsum(times > 1) - 1
    owners = np.repeat(np.arange(len(at)), [len(x) for x in before])
    wanted = times[inverse] > 1
    passed = np.zeros((len(at), int((times > 1).sum())), dtype=np.float32)
    passed[owners[wanted], shared[inverse[wanted]]] = 1
    hits &= passed @ passed.T == 0
    linked = hits.any(axis=1)
    if not linked.any():
        return None
    root = np.arange(len(at))
    while True:
        lowest = np.minimum(root, np.where(hits, root[None], len(at)).min(axis=1))
        lowest = lowest[lowest]
        if (lowest == root).all():
            break
        root = lowest
    links = (hits @ weight.astype(np.float64)).astype(np.int64)
    return node[linked], links[linked], node[root][linked]


def _angles(rows: DataFrame, one: str, other: str, kind: str) -> DataFrame:
    """The rows with the ``angle`` of two packed vectors; ``other`` is in double precision."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != other)
    names = [f.name for f in rows.schema if f.name != other]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles = np.zeros(batch.num_rows)
            vectors, centres = (batch.column(batch.schema.names.index(x)).to_pylist() for x in (one, other))
            for alike in _alike(vectors):
                products = (_units([vectors[i] for i in alike], kind) * _units([centres[i] for i in alike], "f8")).sum(axis=1)
                angles[alike] = np.arccos(np.clip(products, -1, 1))
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in names), pa.array(angles)], names=[*names, "angle"])

    return rows.mapInArrow(measure, f"{schema}, angle double")


def _as_double(column: str, kind: str) -> F.Column:
    @F.pandas_udf("binary")
    def widen(vectors):
        return vectors.map(lambda x: np.frombuffer(x, dtype=kind).astype(np.float64).tobytes())

    return widen(column)


def _centres(near: DataFrame, kind: str) -> DataFrame:
    """``hub, centre``: the mean direction of the vectors of each hub."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hubs, vectors = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            for hub in np.unique(hubs):
                units = _units([vectors[i] for i in np.flatnonzero(hubs == hub)], kind)
                arrays = [pa.array(np.full(units.shape[1], hub)), pa.array(np.arange(units.shape[1])), pa.array(units.sum(axis=0))]
                yield pa.RecordBatch.from_arrays(arrays, names=["hub", "at", "part"])

    parts = near.select("hub", "vector").mapInArrow(add, "hub long, at long, part double")
    sums = parts.groupBy("hub", "at").agg(F.sum("part").alias("part"))
    listed = sums.groupBy("hub").agg(F.sort_array(F.collect_list(F.struct("at", "part"))).alias("parts"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres = [np.array([x["part"] for x in parts]).tobytes() for parts in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(centres, pa.binary())], names=["hub", "centre"])

    return listed.mapInArrow(pack, "hub long, centre binary")


def _crowded(entries: DataFrame) -> DataFrame:
    counted = entries.groupBy("length", "filter").agg(F.count("*").alias("n"))
    return materialize(counted.filter(F.col("n") > MOST_COMPARED), "crowded-filters")


def _balls(entries: DataFrame, crowded: DataFrame, kind: str, cosine: float, turn: int) -> DataFrame:
    """``ball, node, weight, vector, centre, angle``: disjoint balls of nodes of the crowded filters.

    In each such filter one node, the least of a hash, is the hub: those linked to
    it have a mean direction, and those near enough to this one are a ball.
    """
    inside = entries.join(crowded.select("length", "filter"), ["length", "filter"])
    order = F.xxhash64("node", F.lit(turn))
    hubs = inside.groupBy("length", "filter").agg(
        F.min_by("node", F.struct(order, "node")).alias("hub"), F.min_by("vector", F.struct(order, "node")).alias("hub_vector")
    )
    hubs = hubs.withColumn("hub_vector", _as_double("hub_vector", kind))
    with_hub = inside.select("length", "filter", "node", "weight", "vector").join(hubs, ["length", "filter"])
    near = _angles(with_hub.drop("length", "filter"), "vector", "hub_vector", kind).filter(F.col("angle") <= float(np.arccos(cosine)))
    near = materialize(near.drop("angle").dropDuplicates(["hub", "node"]), "near-hubs")
    measured = near.join(materialize(_centres(near, kind), "centres"), "hub").withColumn("c", F.col("centre"))
    measured = _angles(measured, "vector", "c", kind).filter(F.col("angle") <= float(np.arccos(cosine)) / 2 - _MARGIN)
    first = F.row_number().over(Window.partitionBy("node").orderBy("angle", "hub"))
    own = measured.withColumn("first", first).filter("first = 1").drop("first")
    return own.select(F.col("hub").alias("ball"), "node", "weight", "vector", "centre", "angle")


def _gathered(entries: DataFrame, kind: str, cosine: float) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """The entries outside balls, the filters that still are crowded, and the balls' members with their entries' filters."""
    members, turn = None, 0
    crowded = _crowded(entries)
    while not crowded.isEmpty():
        balls = materialize(_balls(entries, crowded, kind, cosine, turn), "balls")
        if balls.isEmpty():
            return entries, crowded, members
        found = entries.drop("weight", "vector", "filters").join(balls, "node")
        found = materialize(found.withColumn("ball", F.xxhash64("ball", F.lit(turn))), "ball-members")
        members = found if members is None else members.unionByName(found)
        entries = materialize(entries.join(balls.select("node"), "node", "left_anti"), "entries-left")
        crowded, turn = _crowded(entries), turn + 1
    return entries, None, members


def _ball_links(entries: DataFrame, members: DataFrame, kind: str, cosine: float) -> DataFrame:
    """``node, links, root`` of the balls' members among each other, and of others with them."""
    widest = float(np.arccos(cosine))
    inner = members.select("ball", "node", "weight", "vector", "angle").dropDuplicates(["node"])
    inner = materialize(inner, "ball-nodes")
    balls = inner.groupBy("ball").agg(F.sum("weight").alias("all"), F.max("angle").alias("radius"), F.min("node").alias("root"))
    centres = members.groupBy("ball").agg(F.any_value("centre").alias("centre"))
    balls = materialize(balls.join(centres, "ball"), "ball-centres")
    within = inner.join(balls, "ball").select("node", (F.col("all") - F.col("weight")).alias("links"), "root")
    # Others that share a filter with a member: nodes outside balls, and members of balls before this one.
    met = members.select("length", "filter", "ball").distinct()
    columns = ["length", "filter", "node", "weight", "vector"]
    others = entries.select(*columns, F.lit(None).cast("long").alias("own"))
    others = others.union(members.select(*columns, F.col("ball").alias("own")))
    pairs = others.join(met, ["length", "filter"]).filter("own IS NULL OR own < ball")
    pairs = pairs.select("node", "weight", "vector", "ball").dropDuplicates(["node", "ball"]).join(balls, "ball")
    pairs = materialize(_angles(pairs, "vector", "centre", kind), "nodes-with-balls")
    certain = pairs.filter(F.col("angle") + F.col("radius") <= widest - _MARGIN)
    to_all = certain.groupBy("ball").agg(F.sum("weight").alias("links"))
    certain_links = certain.select("node", F.col("all").alias("links"), "root").union(
        inner.join(to_all, "ball").join(balls.select("ball", "root"), "ball").select("node", "links", "root")
    )
    opened = F.col("angle").between(widest - F.col("radius") - _MARGIN, widest + F.col("radius") + _MARGIN)
    opened = pairs.filter(opened & ~(F.col("angle") + F.col("radius") <= widest - _MARGIN))
    theirs = inner.select("ball", F.col("node").alias("other"), F.col("weight").alias("other_weight"), _as_double("vector", kind).alias("v"))
    compared = _cosines(opened.select("ball", "node", "weight", "vector").join(theirs, "ball").drop("ball"), kind)
    linked = compared.filter(F.col("cosine") >= cosine)
    open_links = linked.select("node", F.col("other_weight").alias("links"), F.col("other").alias("root")).union(
        linked.select(F.col("other").alias("node"), F.col("weight").alias("links"), F.col("other").alias("root"))
    )
    return within.union(certain_links).union(open_links)


def _cosines(rows: DataFrame, kind: str) -> DataFrame:
    schema = "node long, weight long, other long, other_weight long, cosine double"

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosines = np.zeros(batch.num_rows)
            vectors, theirs = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            for alike in _alike(vectors):
                cosines[alike] = (_units([vectors[i] for i in alike], kind) * _units([theirs[i] for i in alike], "f8")).sum(axis=1)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(cosines)], names=["node", "weight", "other", "other_weight", "cosine"])

    return rows.select("node", "weight", "other", "other_weight", "vector", "v").mapInArrow(measure, schema)


def near_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id`` of each row; other columns take no part, whatever their names.

    ``n_links`` counts the other rows whose vector has at least this cosine with
    the row's, ``component_id`` is the smallest id that links lead to. Vectors
    that are null, empty, zero or hold null or non-finite components have no
    links, nor have vectors of different lengths with each other. Rows with equal
    vectors are linked, repeated rows too; a row without an id counts as others,
    and its component's id is null where no row in it has one. Vectors are told
    apart by a 64-bit hash.
    """
    value = F.col(vector)
    kind = "f4" if df.schema[vector].dataType.elementType.simpleString() == "float" else "f8"
    value = value.cast("array<float>" if kind == "f4" else "array<double>")
    usable = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(usable & F.exists(value, lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(vec_id).alias("_id"), F.when(usable, value).alias("_vector"))
    rows = rows.withColumn("node", F.when(F.col("_vector").isNotNull(), F.xxhash64("_vector")))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            values, ends = lists.flatten().to_numpy().astype(kind), np.cumsum(pa.compute.list_value_length(lists).to_numpy())
            packed = [x.tobytes() for x in np.split(values, ends[:-1])] if len(lists) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["node", "weight", "vector"])

    different = rows.filter("node IS NOT NULL").groupBy("node", "_vector").agg(F.count("*").alias("weight"))
    nodes = different.select("node", "weight", "_vector").mapInArrow(pack, "node long, weight long, vector binary")
    nodes = materialize(nodes, "vectors")
    entries = materialize(_entries(nodes, nodes.count(), kind, cosine), "cap-entries")
    entries, crowded, members = _gathered(entries, kind, cosine)
    found = _compared(entries, crowded, kind, cosine)
    if members is not None:
        found = found.union(_ball_links(entries, members, kind, cosine))
    found = materialize(found, "cap-links")
    labels = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.select("node", "weight").join(counted, "node", "left").join(labels, "node", "left")
    known = known.select("node", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("label", "node").alias("component"))
    listed = materialize(rows.select("_id", "node").join(known, "node", "left"), "linked-vectors")
    smallest = listed.filter("component IS NOT NULL").groupBy("component").agg(F.min("_id").alias("smallest"))
    result = listed.join(smallest, "component", "left")
    return result.select(
        F.col("_id").alias(vec_id),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.when(F.col("component").isNull(), F.col("_id")).otherwise(F.col("smallest")).alias("component_id"),
    )
