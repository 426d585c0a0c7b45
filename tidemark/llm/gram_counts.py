"""Counts of byte n-grams over a whole table, for the byte and character models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, utf8

_COMPACT = 1 << 21
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32


def grams(data: np.ndarray, order: int) -> np.ndarray:
    """Each run of ``order`` (at most 4) bytes as one integer, the first byte highest."""
    n = len(data) - order + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint32)
    codes = np.zeros(n, dtype=np.uint32)
    for i in range(order):
        codes <<= np.uint32(8)
        codes |= data[i : i + n]
    return codes


def plain_bytes(text: bytes, order: int) -> np.ndarray:
    """The text's bytes, A-Z as a-z and white space as space, after as many spaces as a first byte has before it."""
    return _LOWER[np.frombuffer(b" " * (order - 1) + text, dtype=np.uint8)]


def count_grams(df: DataFrame, text: str, group: str, order: int) -> DataFrame:
    """``group, gram, times``: how often each n-gram occurs in the texts of each group; null texts have none."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, list[np.ndarray]] = {}

        def compact(name: str) -> None:
            found, times = np.unique(np.concatenate(waiting.pop(name)), return_counts=True)
            if name in totals:
                found = np.concatenate([totals[name][0], found])
                times = np.concatenate([totals[name][1], times])
                found, inverse = np.unique(found, return_inverse=True)
                times = np.bincount(inverse, weights=times).astype(np.int64)
            totals[name] = (found, times)

        sizes: dict[str, int] = {}
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
            for part in in_slices(texts):
                for name, value in zip(names[part], texts[part], strict=True):
                    if not value:
                        continue
                    own = grams(plain_bytes(value, order), order)
                    waiting.setdefault(name, []).append(own)
                    sizes[name] = sizes.get(name, 0) + len(own)
                    if sizes[name] >= _COMPACT:
                        compact(name)
                        sizes[name] = 0
        for name in list(waiting):
            compact(name)
        for name, (found, times) in totals.items():
            for at in range(0, len(found), 50_000):
                part = slice(at, at + 50_000)
                arrays = [pa.array([name] * len(found[part]), pa.string())]
                arrays += [pa.array(x[part].astype(np.int64)) for x in (found, times)]
                yield pa.RecordBatch.from_arrays(arrays, names=["name", "gram", "times"])

    found = df.select(F.col(group).alias("name"), text).mapInArrow(count, "name string, gram long, times long")
    return found.groupBy(F.col("name").alias(group), "gram").agg(F.sum("times").alias("times"))
