"""Language identification by prediction by partial matching.

For each language a byte context tree (contexts of up to three bytes) is counted
over all training texts. A text's code length under a language's frozen tree is
exact: each byte is coded in the longest context the tree knows; where the byte
is new there, an escape is coded and the next shorter context is tried, down to
256 equally likely bytes. The language with the shortest code is predicted.

Escapes have the weight of the number of different bytes seen in the context.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import utf8
from tidemark.llm.gram_counts import count_grams, grams, plain_bytes
from tidemark.sources.shared import materialize

ORDER = 4  # the longest context and the byte after it
_LETTER = re.compile(r"[^\W\d_]")
_STEP = 1 << 20
# A text's bytes are not independent: so much of the code length counts as evidence, in nats for a byte.
_TEMPER = 0.1
_SLOTS = 1 << 22


class ContextTree:
    """One language's counts of n-grams of ORDER bytes and of all their suffix contexts."""

    def __init__(self, leaves: np.ndarray, times: np.ndarray) -> None:
        self._levels = []  # from the longest: symbols in context, their times, contexts, totals, kinds
        found, counts = leaves.astype(np.uint32), times.astype(np.float64)
        for order in range(ORDER, 0, -1):
            contexts, first, inverse = np.unique(found >> np.uint32(8), return_index=True, return_inverse=True)
            totals = np.bincount(inverse, weights=counts) if len(found) else np.zeros(0)
            kinds = np.bincount(inverse) if len(found) else np.zeros(0)
            self._levels.append((found, counts, contexts, totals, kinds))
            shorter = found & np.uint32((1 << 8 * (order - 1)) - 1)
            found, inverse = np.unique(shorter, return_inverse=True)
            counts = np.bincount(inverse, weights=counts) if len(inverse) else np.zeros(0)

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """The code length, in bits, of the last byte of each n-gram after the bytes before it."""
        result = np.zeros(len(codes))
        left = np.arange(len(codes))
        for order, (found, counts, contexts, totals, kinds) in zip(range(ORDER, 0, -1), self._levels, strict=True):
            if not len(left) or not len(found):
                break
            own = codes[left] & np.uint32((1 << 8 * order) - 1)
            context = own >> np.uint32(8)
            at = np.minimum(np.searchsorted(contexts, context), len(contexts) - 1)
            seen = contexts[at] == context
            whole = totals[at] + kinds[at]
            symbol = np.minimum(np.searchsorted(found, own), len(found) - 1)
            hit = seen & (found[symbol] == own)
            result[left[hit]] += np.log2(whole[hit] / counts[symbol[hit]])
            escaped = seen & ~hit
            result[left[escaped]] += np.log2(whole[escaped] / kinds[at[escaped]])
            left = left[~hit]
        result[left] += 8
        return result


class LanguageModel:
    """The trees, and a table of the code lengths of all n-grams that any of them has."""

    def __init__(self, names: list[str], trees: list[ContextTree], leaves: np.ndarray) -> None:
        self.names = names
        self._trees = trees
        self._leaves = np.unique(leaves).astype(np.uint32)
        self._bits = np.stack([t.bits(self._leaves) for t in trees], axis=1).astype(np.float32)
        self._slots = np.full(_SLOTS, -1, dtype=np.int32)
        self._slots[self._slot(self._leaves)] = np.arange(len(self._leaves), dtype=np.int32)

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes * np.uint32(2654435761)) >> np.uint32(32 - 22)

    def code_lengths(self, text: bytes) -> np.ndarray:
        """The text's code length in bits under each language."""
        data = plain_bytes(text, ORDER)
        total = np.zeros(len(self.names))
        for at in range(0, len(data), _STEP):
            total += self._sum(grams(data[at : at + _STEP + ORDER - 1], ORDER))
        return total

    def _sum(self, codes: np.ndarray) -> np.ndarray:
        place = self._slots[self._slot(codes)]
        hit = (place >= 0) & (self._leaves[place] == codes)
        times = np.bincount(place[hit], minlength=0)
        used = np.flatnonzero(times)
        total = times[used] @ self._bits[used].astype(np.float64)
        rest = codes[~hit]
        if len(rest):
            found, again = np.unique(rest, return_counts=True)
            at = np.minimum(np.searchsorted(self._leaves, found), len(self._leaves) - 1)
            known = self._leaves[at] == found
            total = total + again[known] @ self._bits[at[known]].astype(np.float64)
            if not known.all():
                total = total + again[~known] @ np.stack([t.bits(found[~known]) for t in self._trees], axis=1)
        return total

    def predict(self, text: bytes) -> tuple[str, float]:
        """The language of the shortest code, and its share of belief; no language for a text without a letter."""
        if not _LETTER.search(text.decode("utf-8", "replace")):
            return "und", 0.0
        lengths = self.code_lengths(text)
        best = int(np.argmin(lengths))
        weights = np.exp2(-(lengths - lengths[best]) * _TEMPER)
        return self.names[best], float(1 / weights.sum())


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel | None:
    """Count all rows that have a language, every n-gram of them; None if there are none."""
    counts = count_grams(df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()), text, lang, ORDER)
    rows = materialize(counts, "language-counts").toArrow()
    if not rows.num_rows:
        return None
    names = np.array(rows.column(lang).to_pylist())
    leaves, times = rows.column("gram").to_numpy(), rows.column("times").to_numpy()
    known = sorted(set(names))
    trees = [ContextTree(*(x[np.argsort(leaves[names == n])] for x in (leaves[names == n], times[names == n]))) for n in known]
    return LanguageModel(known, trees, leaves)


def identify(df: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``; columns with these names are replaced.

    A text that is null or has no letter is ``und`` with score 0, and so is every
    text without a model. Rows with equal texts are predicted alike.
    """
    own = df.drop("lang_pred", "score")
    columns = own.columns
    fields = own.select(*[F.col(c) for c in columns]).schema.add("lang_pred", "string").add("score", "double")
    sent = df.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            texts = utf8(batch.column(columns.index(text)))
            found = [known.predict(x) if known and x else ("und", 0.0) for x in texts]
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "lang_pred", "score"])

    return own.mapInArrow(predict, fields)
