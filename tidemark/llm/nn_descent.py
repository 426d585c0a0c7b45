"""Approximate nearest neighbours by largest inner product, on a graph that NN-descent builds.

1. Rows with equal vectors are one node, so that copies do not fill the graph.
2. A first graph comes from several sortings by random hyperplanes: nodes that
   lie next to each other are compared.
3. Each round joins every node with its neighbours and with some that have it as
   theirs; these meet pairwise, as neighbours of neighbours, and every node keeps
   the nearest it has met.
4. A query starts at its own neighbours in the graph and greedily visits the
   neighbours of the nearest found, some at a time. The nearest are compared with
   the original vectors, in double precision.

Between Spark's joins vectors travel as bytes with a scale. A node's degree in
the graph is bounded, which is what makes it approximate; all rows are indexed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.shared import materialize

DEGREE = 24
SORTINGS, CHUNK, PLANES = 12, 2048, 12
ROUNDS = 3
MET = 12  # of those a node meets in one join it is told the nearest
HOPS, VISITS = 4, 32
RESCORED = 64  # at least, and twice the number asked for


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Scales and bytes of packed vectors, as floats ready to multiply."""
    packed = b"".join(column.to_pylist())
    rows = np.frombuffer(packed, dtype=np.uint8).reshape(len(column), -1) if len(column) else np.zeros((0, 5), dtype=np.uint8)
    scale = np.ascontiguousarray(rows[:, :4]).view(np.float32)[:, 0]
    return scale, np.ascontiguousarray(rows[:, 4:]).view(np.int8).astype(np.float32)


def _vectors(column: pa.Array) -> np.ndarray:
    scale, values = _codes(column)
    return values * scale[:, None]


def _pack(vector: list[float]) -> bytes:
    values = np.asarray(vector, dtype=np.float64)
    scale = np.float32(np.abs(values).max() / 127)
    return scale.tobytes() + np.rint(values / scale).astype(np.int8).tobytes()


def _nearest(owner: np.ndarray, other: np.ndarray, near: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each owner the ``keep`` different nearest others, in order."""
    order = np.lexsort((-near, other, owner))
    owner, other, near = owner[order], other[order], near[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    owner, other, near = owner[new], other[new], near[new]
    order = np.lexsort((other, -near, owner))
    owner, other, near = owner[order], other[order], near[order]
    first = np.ones(len(owner), dtype=bool)
    first[1:] = owner[1:] != owner[:-1]
    starts = np.flatnonzero(first)
    rank = np.arange(len(owner)) - np.repeat(starts, np.diff(np.append(starts, len(owner))))
    kept = rank < keep
    return owner[kept], other[kept], near[kept]


def _lists(owner: np.ndarray, other: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    """A row for each owner (they are sorted) with its others."""
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, dtype=np.int64)
    offsets = pa.array(np.append(starts, len(owner)).astype(np.int32))
    arrays = [
        pa.array(owner[starts], pa.int64()),
        pa.ListArray.from_arrays(offsets, pa.array(other, pa.int64())),
        pa.ListArray.from_arrays(offsets, pa.array(near.astype(np.float32))),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["node", "others", "near"])


_GRAPH = "node long, others array<long>, near array<float>"


def _merge(lists: DataFrame, degree: int) -> DataFrame:
    """One list of the nearest for each node."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, found = batch.column(0).to_numpy(), batch.column(1)
            sizes = np.diff(found.offsets.to_numpy())
            pairs = found.flatten()
            others, near = pairs.field(0), pairs.field(1)
            lengths = np.diff(others.offsets.to_numpy())
            owner = np.repeat(np.repeat(node, sizes), lengths)
            yield _lists(*_nearest(owner, others.flatten().to_numpy(), near.flatten().to_numpy(), degree))

    return lists.groupBy("node").agg(F.collect_list(F.struct("others", "near")).alias("found")).mapInArrow(merge, _GRAPH)


def _first_graph(nodes: DataFrame, degree: int, seed: int) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = _vectors(batch.column(1))
            if planes is None:
                planes = np.random.default_rng(seed).standard_normal((SORTINGS, values.shape[1], PLANES + 1)).astype(np.float32)
            for sorting in range(SORTINGS):
                sides = values @ planes[sorting]
                code = (sides[:, :PLANES] > 0) @ (1 << np.arange(PLANES))
                arrays = [pa.array(np.full(len(values), sorting, dtype=np.int32)), pa.array(code.astype(np.int32))]
                arrays += [pa.array(sides[:, PLANES].astype(np.float64)), batch.column(0), batch.column(1)]
                yield pa.RecordBatch.from_arrays(arrays, names=["sorting", "code", "side", "node", "code8"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, node = _vectors(batch.column(4)), batch.column(3).to_numpy()
            for at in range(0, len(node), CHUNK // 2):  # each chunk and the half of the next
                part = slice(at, at + CHUNK)
                if at and at + CHUNK // 2 >= len(node):
                    break
                yield _met(node[part], values[part], degree)

    placed = nodes.select("node", "code8").mapInArrow(place, "sorting int, code int, side double, node long, code8 binary")
    ordered = placed.repartitionByRange("sorting", "code", "side").sortWithinPartitions("sorting", "code", "side")
    return _merge(ordered.mapInArrow(compare, _GRAPH), degree)


def _met(node: np.ndarray, values: np.ndarray, keep: int) -> pa.RecordBatch:
    """All nodes of a small group compared; for each its nearest."""
    near = values @ values.T
    np.fill_diagonal(near, -np.inf)
    count = min(keep, len(node) - 1)
    if count < 1:
        return _lists(*(np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.float32)))
    best = np.argpartition(-near, count - 1, axis=1)[:, :count]
    owner = np.repeat(np.arange(len(node)), count)
    order = np.argsort(node[owner], kind="stable")
    return _lists(node[owner][order], node[best.reshape(-1)][order], near[owner, best.reshape(-1)][order])


def _both_ways(graph: DataFrame, degree: int) -> DataFrame:
    """``node, other``: the neighbours, and as many of those that have the node as theirs."""
    ahead = graph.select("node", F.explode("others").alias("other"))
    back = ahead.select(F.col("other").alias("node"), F.col("node").alias("other"))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("node", "other")))
    some = back.withColumn("_rank", rank).filter(F.col("_rank") <= degree).drop("_rank")
    return ahead.union(some).distinct()


def _round(graph: DataFrame, nodes: DataFrame, degree: int) -> DataFrame:
    own = nodes.select("node", F.col("node").alias("other"))
    rows = _both_ways(graph, degree).union(own).join(nodes.select(F.col("node").alias("other"), "code8"), "other")
    groups = rows.groupBy("node").agg(F.collect_list(F.struct("other", "code8")).alias("met")).select("met")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups, found = batch.column(0), []
            ends = groups.offsets.to_numpy() - groups.offsets[0].as_py()
            members = groups.flatten()
            node, values = members.field(0).to_numpy(), _vectors(members.field(1))
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                met = _met(node[a:b], values[a:b], MET)
                sizes = np.diff(met.column(1).offsets.to_numpy())
                found.append((np.repeat(met.column(0).to_numpy(), sizes), *(met.column(i).flatten().to_numpy() for i in (1, 2))))
                if len(found) >= 1000:
                    yield _lists(*_nearest(*map(np.concatenate, zip(*found, strict=True)), degree))
                    found = []
            if found:
                yield _lists(*_nearest(*map(np.concatenate, zip(*found, strict=True)), degree))

    return _merge(graph.unionByName(groups.mapInArrow(meet, _GRAPH)), degree)


def build_graph(nodes: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS, seed: int = 5) -> DataFrame:
    """``node, others, near``: the nearest neighbours found for each of ``nodes`` (``node, code8``)."""
    graph = materialize(_first_graph(nodes, degree, seed), "graph")
    for _ in range(rounds):
        graph = materialize(_round(graph, nodes, degree), "graph")
    return graph


_STATE = "query long, code8 binary, seen binary, near binary, visited binary, frontier array<long>"


def _step(state: DataFrame, found: DataFrame, visits: int) -> DataFrame:
    """Add what was found to the queries' states, and choose what to visit next."""
    rows = state.drop("frontier").join(found, "query", "left")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            query, code, seen, near, visited, met = (batch.column(i) for i in range(6))
            out: list[list] = [[], [], [], []]
            for row in range(batch.num_rows):
                ids, sims, done = (np.frombuffer(c[row].as_py(), dtype=t) for c, t in ((seen, "i8"), (near, "f4"), (visited, "i8")))
                if met[row].is_valid:
                    new = met[row].values
                    sims = np.concatenate([sims, _vectors(new.field(1)) @ _vectors(code.slice(row, 1))[0]]).astype(np.float32)
                    ids = np.concatenate([ids, new.field(0).to_numpy()])
                order = np.lexsort((ids, -sims))
                ids, sims = ids[order], sims[order]
                fresh = ids[~np.isin(ids, done)][:visits]
                for column, value in zip(out, (ids, sims, np.concatenate([done, fresh])), strict=False):
                    column.append(value.tobytes())
                out[3].append(fresh.tolist())
            arrays = [query, code, *(pa.array(x, pa.binary()) for x in out[:3]), pa.array(out[3], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["query", "code8", "seen", "near", "visited", "frontier"])

    return rows.select("query", "code8", "seen", "near", "visited", "found").mapInArrow(step, _STATE)


def greedy_search(queries: DataFrame, links: DataFrame, nodes: DataFrame, hops: int, visits: int, most: int = RESCORED) -> DataFrame:
    """``query, node``: the ``most`` nearest nodes found for the nodes ``query``, themselves among them."""
    start = nodes.join(queries.select(F.col("query").alias("node")), "node", "left_semi")
    none = F.lit(b"").cast("binary")
    state = start.select(
        F.col("node").alias("query"), "code8", none.alias("seen"), none.alias("near"), none.alias("visited"),
        F.array("node").alias("frontier"),
    )
    asked = state.select("query", F.col("query").alias("node"))
    for hop in range(hops + 1):
        frontier = state.select("query", F.explode("frontier").alias("node"))
        to = frontier.join(links, "node").select("query", F.col("other").alias("node"))
        wanted = to.union(asked).distinct() if hop == 0 else to.distinct().join(known, ["query", "node"], "left_anti")
        wanted = materialize(wanted, "wanted")
        known = wanted if hop == 0 else known.union(wanted)
        found = wanted.join(nodes, "node").groupBy("query").agg(F.collect_list(F.struct("node", "code8")).alias("found"))
        state = materialize(_step(state, found, visits), "searches")

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, seen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(seen, dtype=np.int64)[:most]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), query)), pa.array(ids)], names=["query", "node"])

    return state.select("query", "seen").mapInArrow(nearest, "query long, node long")


def search(
    df: DataFrame,
    is_query,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    degree: int = DEGREE,
    rounds: int = ROUNDS,
    hops: int = HOPS,
    visits: int = VISITS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row with ``is_query`` the ``k`` nearest other rows found.

    Vectors that are null, empty, zero or hold null, NaN or infinity take no part,
    nor do rows without an id; of rows that share id and vector one counts.
    Vectors are expected to have one length. Ties go to the smaller id.
    """
    vector = F.col(embedding).cast("array<double>")
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(embedding, lambda x: x != 0)
    rows = df.filter(F.col(vec_id).isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = rows.select(F.col(vec_id).cast("long").alias("_id"), is_query.alias("_asks"), vector.alias("_vec"))
    rows = materialize(rows.withColumn("node", F.xxhash64("_vec")).dropDuplicates(["_id", "node"]), "vectors")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = pa.array([_pack(x.values.to_numpy()) for x in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), codes, batch.column(1)], names=["node", "code8", "vec"])

    one = rows.groupBy("node").agg(F.first("_vec").alias("vec"))
    nodes = materialize(one.mapInArrow(pack, "node long, code8 binary, vec array<double>"), "nodes")
    codes = nodes.select("node", "code8")
    graph = build_graph(codes, degree, rounds)
    links = materialize(_both_ways(graph, degree), "links")
    asking = rows.filter("_asks").select(F.col("_id").alias("query_id"), F.col("node").alias("query"))
    found = greedy_search(asking.select("query").distinct(), links, codes, hops, visits, max(RESCORED, 2 * k))
    exact = found.join(nodes.select("node", "vec"), "node").join(nodes.select(F.col("node").alias("query"), F.col("vec").alias("own")), "query")
    product = F.aggregate(F.zip_with("vec", "own", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = exact.select("query", "node", product.alias("score"))
    # Of equal vectors the k + 1 smallest ids are enough, whichever row asks.
    copies = rows.select("node", F.col("_id").alias(vec_id))
    copies = copies.withColumn("_rank", F.row_number().over(Window.partitionBy("node").orderBy(vec_id)))
    copies = copies.filter(F.col("_rank") <= k + 1).drop("_rank")
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), vec_id)
    answers = scored.join(copies, "node").withColumn("_rank", F.row_number().over(nearest)).filter(F.col("_rank") <= k + 1)
    paired = asking.join(answers.drop("_rank", "node"), "query").filter(F.col("query_id") != F.col(vec_id))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), vec_id))
    return paired.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", vec_id, "score")
