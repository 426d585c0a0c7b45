"""Line deduplication over a sharded minimal perfect hash of all lines.

1. Tasks pack the lines of their documents into blocks: for each block and shard
   of the hash space one row with the different line hashes, in how many of the
   block's documents each occurs, and the keys of these documents. A line that a
   third of all documents share is one entry of a block.
2. Each shard adds up its blocks and indexes its different hashes: a minimal
   perfect hash gives every line a place in an array of fingerprints and an
   array of counts.
3. The blocks probe the arrays of their shards; only documents with lines above
   the limit get an answer. Lines are never joined with lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, in_slices, mix, names_apart, row_key, utf8
from tidemark.sources.shared import materialize

# Text that the lines of one shard stand for, and the fewest shards.
SHARD_BYTES = 64 << 20
LEAST_SHARDS = 64
# Text packed at once.
PACK_BYTES = 16 << 20

_LOOSE = 2.0  # bits for each key still to be placed, in a level
_LEVELS = 24
_LARGEST = np.iinfo(np.uint32).max


def line_key(line: bytes) -> bytes:
    """The line without white space at its ends, A-Z as a-z."""
    return line.strip(SPACES).lower()


def line_hash(line: bytes) -> int:
    return xxhash.xxh3_64_intdigest(line_key(line))


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys ^ mix(np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)


@dataclass
class LineIndex:
    """A minimal perfect hash of 64-bit keys with a 32-bit fingerprint and a count for each.

    Each level has a bit array; a key that is alone at its bit is placed there,
    the others go on to the next level. A key's place is the number of set bits
    before its own. The few keys left after the last level are listed.
    """

    sizes: np.ndarray
    bits: np.ndarray
    before: np.ndarray
    rest: np.ndarray
    fingerprints: np.ndarray
    counts: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, counts: np.ndarray) -> LineIndex:
        """Index different keys."""
        keys = np.asarray(keys, dtype=np.uint64)
        sizes, words, left = [], [], keys
        for level in range(_LEVELS):
            if not len(left):
                break
            size = -(-max(64, int(_LOOSE * len(left))) // 64) * 64
            places = _places(left, level, size)
            alone = np.bincount(places, minlength=size) == 1
            sizes.append(size)
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            left = left[~alone[places]]
        bits = np.concatenate(words) if words else np.zeros(0, dtype=np.uint64)
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits))]).astype(np.uint32)
        index = cls(np.array(sizes, dtype=np.int64), bits, before, np.sort(left), np.zeros(0), np.zeros(0))
        at = index.place(keys)
        index.fingerprints = np.zeros(len(keys), dtype=np.uint32)
        index.fingerprints[at] = _fingerprints(keys)
        index.counts = np.zeros(len(keys), dtype=np.uint32)
        index.counts[at] = np.minimum(counts, _LARGEST)
        return index

    def place(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; of keys that were not indexed, any place or -1."""
        result = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        start = 0
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = _places(keys[open_], level, int(size)) + start
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (self.bits[word] >> bit) & np.uint64(1) == 1
            low = self.bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            result[open_[hit]] = self.before[word[hit]] + np.bitwise_count(low)
            open_ = open_[~hit]
            start += int(size)
        if len(open_) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            result[open_[hit]] = int(self.before[-1]) + at[hit]
        return result

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Counts of the keys; 0 where the fingerprint shows that a key was not indexed."""
        keys = np.asarray(keys, dtype=np.uint64)
        at = self.place(keys)
        if not len(self.counts):
            return np.zeros(len(keys), dtype=np.uint32)
        known = (at >= 0) & (self.fingerprints[at] == _fingerprints(keys))
        return np.where(known, self.counts[at], 0)

    def to_row(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() for name in _KINDS}

    @classmethod
    def from_row(cls, row) -> LineIndex:
        return cls(**{name: np.frombuffer(row[name], dtype=kind) for name, kind in _KINDS.items()})


_KINDS = {"sizes": "i8", "bits": "u8", "before": "u4", "rest": "u8", "fingerprints": "u4", "counts": "u4"}


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys + np.uint64(1)) >> np.uint64(32)).astype(np.uint32)


def pack_lines(df: DataFrame, shards: int, text: str = "text", min_chars: int = 1) -> DataFrame:
    """Rows of ``shard, hashes, counts, keys`` (packed 64-, 32- and 64-bit integers), a row for each block and shard.

    ``df`` has the documents' ``__key``. Lines whose key has fewer than
    ``min_chars`` code points are left out.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(zero_copy_only=False), utf8(batch.column(1))
            for part in in_slices(texts, PACK_BYTES, len(texts)):
                found = [_line_hashes(x, min_chars) for x in texts[part]]
                owners = np.repeat(keys[part], [len(x) for x in found])
                hashes = np.fromiter((h for x in found for h in x), dtype=np.uint64, count=len(owners))
                if len(hashes):
                    yield _packed(hashes, owners, shards)

    own = df.select("__key", F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return own.mapInArrow(pack, "shard int, hashes binary, counts binary, keys binary")


def _line_hashes(text: bytes, min_chars: int) -> set[int]:
    keys = {line_key(x) for x in text.split(b"\n")}
    return {xxhash.xxh3_64_intdigest(x) for x in keys if len(x) >= min_chars and _length(x) >= min_chars}


def _length(line: bytes) -> int:
    """Code points of UTF-8."""
    return len(line) if line.isascii() else len(line.decode("utf-8", "replace"))


def _packed(hashes: np.ndarray, owners: np.ndarray, shards: int) -> pa.RecordBatch:
    order = np.argsort(hashes, kind="stable")
    hashes, owners = hashes[order], owners[order].astype(np.int64)
    single, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    shard = _shard(single, shards)
    edges = np.flatnonzero(np.diff(shard, prepend=-1, append=shards))
    rows: dict[str, list] = {"shard": [], "hashes": [], "counts": [], "keys": []}
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        rows["shard"].append(int(shard[a]))
        rows["hashes"].append(single[a:b].tobytes())
        rows["counts"].append(counts[a:b].astype(np.uint32).tobytes())
        rows["keys"].append(owners[first[a] : first[b] if b < len(first) else len(owners)].tobytes())
    kinds = [("shard", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary()), ("keys", pa.binary())]
    return pa.RecordBatch.from_pydict(rows, schema=pa.schema(kinds))


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash space."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def build_index(packed: DataFrame) -> DataFrame:
    """A row for each shard with the arrays of its LineIndex; a line's count is its number of documents."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hashes = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in rows["hashes"]])
        counts = np.concatenate([np.frombuffer(x, dtype=np.uint32) for x in rows["counts"]])
        single, inverse = np.unique(hashes, return_inverse=True)
        totals = np.zeros(len(single), dtype=np.int64)
        np.add.at(totals, inverse, counts)
        return pd.DataFrame([{"shard": key[0]} | LineIndex.build(single, totals).to_row()])

    fields = ", ".join(f"{name} binary" for name in _KINDS)
    return packed.select("shard", "hashes", "counts").groupBy("shard").applyInPandas(build, f"shard int, {fields}")


def frequent_lines(packed: DataFrame, index: DataFrame, min_docs: int) -> DataFrame:
    """``__key`` and the sorted hashes of the document's lines that at least ``min_docs`` documents hold."""

    def probe(key: tuple, blocks: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        found = []
        shard = LineIndex.from_row(arrays.iloc[0])
        for hashes, counts, keys in zip(blocks["hashes"], blocks["counts"], blocks["keys"], strict=True):
            own = np.frombuffer(hashes, dtype=np.uint64)
            times = np.frombuffer(counts, dtype=np.uint32)
            many = shard.count(own) >= min_docs
            docs = np.frombuffer(keys, dtype=np.int64)[np.repeat(many, times)]
            found.append(pd.DataFrame({"__key": docs, "_hash": np.repeat(own[many], times[many]).view(np.int64)}))
        return pd.concat(found) if found else pd.DataFrame({"__key": [], "_hash": []}, dtype="int64")

    pairs = packed.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(probe, "__key long, _hash long")
    return pairs.groupBy("__key").agg(F.collect_set("_hash").alias("_frequent"))


def shard_count(df: DataFrame, text: str = "text") -> int:
    """Shards for the table's size."""
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(LEAST_SHARDS, -(-size // SHARD_BYTES))


def lines_key(text: str = "text") -> Column:
    """A key of the text's line keys in order, empty ones left out; null counts as empty."""
    spaces = F.lit(SPACES.decode())
    lines = F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), lambda x: F.translate(F.btrim(x, spaces), ascii_uppercase, ascii_lowercase))
    return F.xxhash64(F.filter(lines, lambda x: x != ""))


@names_apart
def drop_frequent_lines(
    df: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    text: str = "text",
    doc_id: str = "doc_id",
    shards: int | None = None,
    equal_once: bool = False,
) -> DataFrame:
    """Remove from every text the lines whose key at least ``min_docs`` documents hold.

    Replaces the text and adds n_lines (before), n_dropped and kept_sha256 (of the
    new text); columns with these names are replaced. Each row is a document,
    also repeated ones; with ``equal_once`` all rows with equal lines count as one
    document, so that copies alone do not make their lines frequent. A null or
    empty text is one empty line; its text stays as it is. Lines are known by
    64-bit hashes.
    """
    added = ["n_lines", "n_dropped", "kept_sha256"]
    own = df.drop(*added)
    keyed = own.withColumn("__key", row_key(doc_id, text))
    shards = shards or shard_count(own, text)
    packed = counted = materialize(pack_lines(keyed, shards, text, min_chars), "line-blocks")
    if equal_once:
        single = own.select(lines_key(text).alias("__key"), text).dropDuplicates(["__key"])
        counted = materialize(pack_lines(single, shards, text, min_chars), "line-blocks-once")
    index = materialize(build_index(counted), "line-index")
    joined = keyed.join(frequent_lines(packed, index, min_docs), "__key", "left").drop("__key")
    columns = own.columns
    schema = own.select(*[F.col(c) for c in columns]).schema

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = columns.index(text)
        for batch in batches:
            frequent = batch.column(len(columns)).to_pylist()
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            results = [_without(x, f) for x, f in zip(texts, frequent, strict=True)]
            kept, lines, dropped = zip(*results, strict=True) if results else ((), (), ())
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays[at] = pa.array(kept, pa.binary()).cast(pa.string())
            digests = [hashlib.sha256(x or b"").hexdigest() for x in kept]
            arrays += [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, *added])

    fields = schema.add("n_lines", "long").add("n_dropped", "long").add("kept_sha256", "string")
    return joined.select(*columns, "_frequent").mapInArrow(remove, fields)


def _without(text: bytes | None, frequent: list[int] | None) -> tuple[bytes | None, int, int]:
    if not text:
        return text, 1, 0
    lines = text.split(b"\n")
    if not frequent:
        return text, len(lines), 0
    out = {x & 0xFFFFFFFFFFFFFFFF for x in frequent}
    kept = [x for x in lines if line_hash(x) not in out]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)
