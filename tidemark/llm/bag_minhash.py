"""Near-duplicates of texts as multisets of word shingles, by BagMinHash.

A shingle's multiplicity is a weight, discretised to whole numbers. For every
shingle the unit intervals of weight are grouped into dyadic blocks [0, 1),
[1, 2), [2, 4), [4, 8) ..., each with a Poisson process of its own whose rate is
the block's width: a point has a time, a weight within the block and a place in
the signature. A text takes the points below its weights, and each place of the
signature keeps the earliest. Two texts agree at a place with the probability of
their weighted Jaccard similarity. A process is followed only until its time is
later than all places of the signature.

1. Texts with equal multisets are one node.
2. Signatures are banded. In each bucket every node is paired with the bucket's
   hub, which a hash chooses anew for every bucket, and the pairs are verified
   exactly. Linked nodes form components.
3. In buckets that still hold several components, the pairs between these whose
   signatures agree enough are verified too, in blocks of bounded size. So no
   candidate pair is left out but those that are connected already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, mix, names_apart, row_key, shingle_hashes, utf8
from tidemark.llm.components import components
from tidemark.sources.shared import materialize

WIDTH = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
# Signatures of texts with the similarity sought agree less than this in about one case of 100,000.
LEAST_AGREEMENT = 0.65
# Nodes, and shingles of all of them, in a block.
BLOCK, BLOCK_SHINGLES = 512, 1_000_000
_OWNER_BITS = np.uint64(12)
_TWO_32 = np.uint64(1 << 32)
_ROUND = np.uint64(0x9E3779B97F4A7C15)


def signatures(texts: list[bytes], width: int = WIDTH, places: int = BANDS * ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of at most 4096 texts: the earliest times at all places, the multisets' fingerprints, and their sizes."""
    shingles, sizes = shingle_hashes(texts, width)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), sizes)
    keys, weights = np.unique((shingles & ~np.uint64(4095)) | owner, return_counts=True)
    element, owner = mix(keys >> _OWNER_BITS), (keys & np.uint64(4095)).astype(np.int64)
    prints = np.zeros(len(texts), dtype=np.uint64)
    np.add.at(prints, owner, mix(element + mix(weights.astype(np.uint64))))
    times = np.full(len(texts) * places, np.inf)
    level, own = 0, np.arange(len(keys))
    seeds, owners, lows, highs = [], [], [], []
    while len(own):
        low, high = (0, 1) if level == 0 else (1 << (level - 1), 1 << level)
        own = own[weights[own] > low]
        seeds.append(mix(element[own] ^ mix(np.full(len(own), level + 1, dtype=np.uint64))))
        owners.append(owner[own])
        lows.append(np.full(len(own), high - low, dtype=np.float64))
        highs.append((weights[own] - low).astype(np.float64))
        level += 1
    seed, owner = np.concatenate(seeds or [element]), np.concatenate(owners or [owner])
    rate, share = np.concatenate(lows or [np.zeros(0)]), np.concatenate(highs or [np.zeros(0)])
    share /= np.maximum(rate, 1)  # of the block that the text's weight covers
    now = np.zeros(len(seed))
    serial = np.zeros(1, dtype=np.uint64)
    while len(seed):
        serial += _ROUND
        drawn = mix(seed + serial)
        now = now - np.log1p(-(drawn >> np.uint64(11)).astype(np.float64) / (1 << 53)) / rate
        drawn = mix(drawn ^ _ROUND)
        place = ((drawn >> np.uint64(32)) * np.uint64(places) >> np.uint64(32)).astype(np.int64)
        taken = (drawn & (_TWO_32 - np.uint64(1))).astype(np.float64) / (1 << 32) < share
        np.minimum.at(times, owner[taken] * places + place[taken], now[taken])
        going = now < times.reshape(-1, places).max(axis=1)[owner]
        seed, owner, rate, share, now = seed[going], owner[going], rate[going], share[going], now[going]
    return times.reshape(-1, places), prints, sizes


def sketch(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``__key, _id, node, size, bands, short`` of each row; texts without words have no node."""
    names = ["__key", "_id", "node", "size", "bands", "short"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = mix(np.arange(1, ROWS + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            texts = utf8(batch.column(2))
            for part in in_slices(texts):
                times, prints, sizes = signatures(texts[part])
                values = mix(np.ascontiguousarray(times).view(np.uint64))
                bands = mix((values.reshape(-1, BANDS, ROWS) * factors).sum(axis=2, dtype=np.uint64)).view(np.int64)
                short = (values >> np.uint64(48)).astype(np.uint16)
                nodes = pa.array(mix(prints + sizes.astype(np.uint64)).view(np.int64), mask=sizes == 0)
                n = part.stop - part.start
                offsets = pa.array(np.arange(n + 1, dtype=np.int32) * BANDS)
                arrays = [
                    *(batch.column(i).slice(part.start, n) for i in range(2)),
                    nodes,
                    pa.array(sizes.astype(np.int64)),
                    pa.ListArray.from_arrays(offsets, pa.array(bands.reshape(-1))),
                    pa.array([x.tobytes() for x in short], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    own = df.select(row_key(doc_id, text).alias("__key"), F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    kind = own.schema["_id"].dataType.simpleString()
    return own.mapInArrow(build, f"__key long, _id {kind}, node long, size long, bands array<long>, short binary")


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets, each as sorted values and their times."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    return shared / max(1, int(a[1].sum()) + int(b[1].sum()) - shared)


def _verify(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs ``a, b`` whose texts are similar enough, with ``similarity``."""
    one, other = (texts.select(F.col("node").alias(x), F.col("_text").alias(f"t{x}")) for x in "ab")
    rows = pairs.join(one, "a").join(other, "b").select("a", "b", "ta", "tb")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [batch.column(i).to_pylist() for i in (0, 1)]
            columns = [batch.column(i) for i in (2, 3)]
            found, known = [], {}
            for row, pair in enumerate(zip(*nodes, strict=True)):
                for node, column in zip(pair, columns, strict=True):
                    if node not in known:
                        if len(known) >= 256:
                            known.clear()
                        hashes, _ = shingle_hashes([column[row].as_buffer().to_pybytes()], WIDTH)
                        known[node] = np.unique(hashes, return_counts=True)
                    if pair[0] not in known:  # made room for the other
                        hashes, _ = shingle_hashes([columns[0][row].as_buffer().to_pybytes()], WIDTH)
                        known[pair[0]] = np.unique(hashes, return_counts=True)
                found.append(overlap(known[pair[0]], known[pair[1]]))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 1)), pa.array(found, pa.float64())], names=["a", "b", "similarity"])

    return rows.mapInArrow(compare, "a long, b long, similarity double").filter(F.col("similarity") >= least)


def _other_links(members: DataFrame, nodes: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Links ``a, b`` between the components of ``members`` (``bucket, band, node, label``).

    Buckets with several components are cut into blocks of bounded size, and every
    two blocks of a bucket meet in a group of their own. There all pairs of nodes
    in different components whose signatures agree enough are compared exactly,
    the likeliest first, each in the first bucket that it shares; two components
    that a link has joined need no other. Only links leave the group.
    """
    sized = members.join(nodes.select("node", "size", "short", "bands"), "node")
    per_bucket = sized.groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum("size").alias("all"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("all") / BLOCK_SHINGLES)).cast("int")
    mixed = per_bucket.filter("low < high").select("bucket", blocks.alias("blocks"))
    own = sized.join(mixed, "bucket").join(texts, "node")
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    met = own.withColumn("_own", block).withColumn("_met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = met.groupBy("bucket", "band", F.least("_own", "_met").alias("i"), F.greatest("_own", "_met").alias("j"))
    rows = F.collect_list(F.struct("node", "label", "size", "short", "bands", "_text"))
    groups = keyed.agg(rows.alias("rows")).select("band", "rows")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for band, group in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                links = _links_within(band, group.values, least)
                if links:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], names=["a", "b"])

    return groups.mapInArrow(compare, "a long, b long").distinct()


def _links_within(band: int, rows: pa.StructArray, least: float) -> list[tuple[int, int]]:
    node, label, size = (rows.field(i).to_numpy() for i in range(3))
    short = np.frombuffer(b"".join(rows.field(3).to_pylist()), dtype=np.uint16).reshape(len(node), -1)
    bands = rows.field(4).flatten().to_numpy().reshape(len(node), -1)
    found = []
    for row in range(len(node)):
        later = np.flatnonzero(label[row + 1 :] != label[row]) + row + 1
        later = later[np.minimum(size[later], size[row]) >= least * np.maximum(size[later], size[row])]
        later = later[(bands[later] == bands[row]).argmax(axis=1) == band] if len(later) else later
        if len(later):
            agree = (short[later] == short[row]).mean(axis=1)
            found += [(x, row, y) for x, y in zip(agree.tolist(), later.tolist(), strict=True) if x >= LEAST_AGREEMENT]
    joined = {x: x for x in label.tolist()}

    def top(x: int) -> int:
        while joined[x] != x:
            joined[x] = x = joined[joined[x]]
        return x

    bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    links = []
    for _, *pair in sorted(found, reverse=True):
        ends = [top(int(label[x])) for x in pair]
        if ends[0] == ends[1]:
            continue
        for x in pair:
            if x not in bags:
                hashes, _ = shingle_hashes([rows.field(5)[x].as_buffer().to_pybytes()], WIDTH)
                bags[x] = np.unique(hashes, return_counts=True)
        if overlap(*(bags[x] for x in pair)) >= least:
            joined[ends[0]] = ends[1]
            links.append((int(min(node[pair])), int(max(node[pair]))))
    return links


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, wordless_alone: bool = True
) -> DataFrame:
    """``__key, doc_id, class_id, is_first`` of each row: the class of texts that links of ``similarity`` connect.

    Words are split at ASCII white space and A-Z taken as a-z; a text of fewer
    than five words is one shingle. ``class_id`` is the smallest id in the class,
    and rows with it are first (of several rows without an id, that with the
    smallest key; ids come before none). Null texts and texts without words are
    each a class of their own, unless ``wordless_alone`` is false: then they are
    one class, as their multisets are equal. ``__key`` is the row key of id and
    text, so repeated rows have the same.
    """
    sketched = materialize(sketch(df, doc_id, text), "sketches")
    if not wordless_alone:
        sketched = sketched.withColumn("node", F.coalesce("node", F.lit(0)))  # the fingerprint of no shingles
    place = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("__key").alias("key"))
    firsts = sketched.filter("node IS NOT NULL").groupBy("node").agg(
        F.min(place).alias("first"),
        F.any_value("bands").alias("bands"),
        F.any_value("short").alias("short"),
        F.any_value("size").alias("size"),
    )
    nodes = materialize(firsts, "nodes")
    banded = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    banded = banded.select(F.xxhash64("band", "value").alias("bucket"), "band", "node")
    chosen = F.min(F.struct(F.xxhash64("bucket", "node").alias("order"), F.col("node").alias("hub")))
    hubs = banded.groupBy("bucket").agg(F.count("*").alias("n"), chosen.alias("hub")).filter("n > 1")
    members = materialize(banded.join(hubs.select("bucket", F.col("hub.hub").alias("hub")), "bucket"), "buckets")
    pairs = members.filter("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    wanted = members.select("node").distinct().join(nodes.select("node", F.col("first.key").alias("__key")), "node")
    own = df.select(row_key(doc_id, text).alias("__key"), F.col(text).cast("binary").alias("_text"))
    texts = materialize(own.join(wanted, "__key").dropDuplicates(["__key"]).drop("__key"), "candidate-texts")
    links = _verify(pairs.distinct(), texts, similarity)
    labels = components(links)
    labelled = members.join(labels, "node", "left")
    labelled = labelled.select("bucket", "band", "node", F.coalesce("label", "node").alias("label"))
    more = materialize(_other_links(labelled, nodes, texts, similarity), "more-links")
    ends = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    across = more.join(ends, "a", "left").join(ends.toDF("b", "lb"), "b", "left")
    merged = components(across.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    base = nodes.select("node", "first").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    base = base.join(merged.toDF("label", "final"), "label", "left").withColumn("final", F.coalesce("final", "label"))
    heads = base.groupBy("final").agg(F.min("first").alias("head"))
    classes = base.join(heads, "final").select("node", "head")
    found = sketched.select("__key", "_id", "node").join(classes, "node", "left")
    alone = F.col("head").isNull()
    return found.select(
        "__key",
        F.col("_id").alias(doc_id),
        F.when(alone, F.col("_id")).otherwise(F.col("head.id")).alias("class_id"),
        (alone | (F.col("__key") == F.col("head.key"))).alias("is_first"),
    )


@names_apart
def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The first document of each class, with its own columns; of repeated rows one. Texts without words all stay, unless told otherwise."""
    classes = near_duplicates(df, doc_id, text, **options)
    first = classes.filter("is_first").select("__key").distinct()
    keyed = df.withColumn("__key", row_key(doc_id, text)).join(first, "__key", "left_semi")
    return keyed.dropDuplicates(["__key"]).select(*df.columns)
