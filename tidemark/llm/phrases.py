"""Phrases that occur often, and how firmly their words belong together.

1. Level by level, for one word to the longest phrase, tasks fingerprint the
   n-grams of their texts (``phrase_prints``) and count each fingerprint; the
   shuffle adds the counts up and keeps one occurrence's place. An n-gram is only
   looked at where both n-grams one word shorter may be frequent: a bit filter of
   the frequent ones, whose size is bounded, tells; what it lets through wrongly
   is counted and falls below the limit like any other.
2. Fingerprints with different checks are collisions and counted apart. Frequent
   ones are read from the text at their place, and must have its fingerprint.
3. Scores and the choice of phrases are joins of these few phrases by their text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, utf8
from tidemark.llm.phrase_prints import WORD, Words, blocks
from tidemark.sources.shared import materialize

MIN_COUNT, LONGEST, TOP = 30, 4, 2000
SCALE, COVERED = 2_000_000, 80
UNKNOWN = "und"
_FILTER_BITS = 1 << 27  # the most a filter of one level has: 16 MB
_BITS_EACH = 16
_TOGETHER = 1 << 18  # n-grams of a task counted at once
_ROWS = 1 << 15
_TEXTS = 512  # held as bytes at once
_WHOLE = "decimal(38,0)"
_COUNTS = "print long, check long, times long, key long, at long"


def _keyed(df: DataFrame, doc_id: str, text: str, group: str) -> DataFrame:
    """Texts with a key of the row's contents, their group and its salt."""
    name = F.coalesce(F.col(group).cast("string"), F.lit(UNKNOWN))
    key = F.xxhash64(F.col(doc_id), F.col(text), F.col(group).cast("string"))
    return df.select(key.alias("key"), F.xxhash64(name).alias("salt"), name.alias("group"), F.col(text).alias("text"))


def _may_hold(bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    mask = np.uint64(len(bits) * 64 - 1)
    found = np.ones(len(prints), dtype=bool)
    for shift in (0, 32):
        place = (prints >> np.uint64(shift)) & mask
        found &= (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return found


def _filter(frequent: DataFrame) -> Broadcast:
    """The fingerprints as bits, two for each; larger for more of them, up to a bound."""
    wanted = _BITS_EACH * max(frequent.count(), 64)
    size = min(_FILTER_BITS, 1 << (wanted - 1).bit_length())
    places = F.explode(F.array(*(F.shiftrightunsigned("print", shift).bitwiseAND(F.lit(size - 1).cast("long")) for shift in (0, 32))))
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    words = frequent.select(places.alias("place")).groupBy(F.call_function("div", F.col("place"), F.lit(64)).alias("word"))
    found = words.agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(size // 64, dtype=np.uint64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(bits)


def _counted(docs: DataFrame, size: int, shorter: Broadcast | None) -> DataFrame:
    """Counts of the n-grams of a size; for single words also all words of each group, as check -1 of its salt."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, ...]] = []
        totals: dict[int, int] = {}

        def emit() -> Iterator[pa.RecordBatch]:
            prints, checks, keys, places = (np.concatenate(x) for x in zip(*waiting, strict=True))
            waiting.clear()
            order = np.argsort(prints, kind="stable")
            if _collide(prints[order], checks[order]):
                order = np.lexsort((checks, prints))
            prints, checks = prints[order], checks[order]
            new = np.ones(len(prints), dtype=bool)
            new[1:] = (prints[1:] != prints[:-1]) | (checks[1:] != checks[:-1])
            first = np.flatnonzero(new)
            columns = [prints[first].view(np.int64), checks[first], np.diff(first, append=len(prints))]
            columns += [keys[order[first]], places[order[first]]]
            for at in range(0, len(first), _ROWS):
                yield _batch(*(x[at : at + _ROWS] for x in columns))

        held = 0
        for batch in (whole.slice(at, _TEXTS) for whole in batches for at in range(0, whole.num_rows, _TEXTS)):
            keys, salts, every = batch.column(0).to_numpy(), batch.column(1).to_numpy(), utf8(batch.column(2))
            for part in in_slices(every):
                for owners, begins, offsets, words in blocks(every[part]):
                    own = np.searchsorted(begins, words.starts, side="right") - 1
                    row = part.start + owners[own]
                    salt = salts[row]
                    if size == 1:
                        for name, times in zip(*np.unique(salt, return_counts=True), strict=True):
                            totals[int(name)] = totals.get(int(name), 0) + int(times)
                    at = words.grams(size)
                    if shorter is not None:
                        known = np.zeros(len(words), dtype=bool)
                        below = words.grams(size - 1)
                        known[below] = _may_hold(shorter.value, words.prints(below, size - 1, salt[below].view(np.uint64)))
                        at = at[known[at] & known[at + 1]]
                    place = words.starts[at] - begins[own[at]] + offsets[own[at]]
                    waiting.append((words.prints(at, size, salt[at].view(np.uint64)), words.checks(at, size), keys[row[at]], place))
                    held += len(at)
                    if held >= _TOGETHER:
                        yield from emit()
                        held = 0
        if waiting:
            yield from emit()
        if totals:
            names = np.fromiter(totals, dtype=np.int64, count=len(totals))
            nothing = np.zeros(len(names), dtype=np.int64)
            yield _batch(names, nothing - 1, np.fromiter(totals.values(), dtype=np.int64, count=len(totals)), nothing, nothing)

    found = docs.select("key", "salt", "text").mapInArrow(count, _COUNTS)
    return found.groupBy("print", "check").agg(
        F.sum("times").alias("times"), F.min_by("at", "key").alias("at"), F.min("key").alias("key")
    )


def _collide(prints: np.ndarray, checks: np.ndarray) -> bool:
    """Whether a fingerprint has two checks; ``prints`` are sorted."""
    return bool(((prints[1:] == prints[:-1]) & (checks[1:] != checks[:-1])).any())


def _batch(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["print", "check", "times", "key", "at"])


def _read(frequent: DataFrame, docs: DataFrame) -> DataFrame:
    """``group, phrase, size, times`` of the frequent n-grams, read from the texts at their places."""
    places = frequent.groupBy("key").agg(F.collect_list(F.struct("at", "size", "print", "check", "times")).alias("places"))
    rows = docs.join(places, "key").select("group", "salt", "text", "places")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2))]
            for group, salt, text, found in zip(*columns, batch.column(3), strict=True):
                at, size, prints, checks, times = (found.values.field(i).to_numpy() for i in range(5))
                phrases = [_phrase(text, *x) for x in zip(at.tolist(), size.tolist(), strict=True)]
                words = Words(b"\n".join(phrases))
                first = np.searchsorted(words.piece, np.arange(len(phrases)))
                for n in np.unique(size):
                    own = size == n
                    salts = np.full(int(own.sum()), salt, dtype=np.int64).view(np.uint64)
                    same = words.prints(first[own], int(n), salts).view(np.int64) == prints[own]
                    if not (same & (words.checks(first[own], int(n)) == checks[own])).all():
                        raise ValueError("a phrase differs from its fingerprint")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([group] * len(at)), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(size), pa.array(times), pa.array(prints), pa.array(checks)],
                    names=["group", "phrase", "size", "times", "print", "check"],
                )

    schema = "group string, phrase string, size int, times long, print long, check long"
    return rows.mapInArrow(read, schema).dropDuplicates(["group", "phrase"]).drop("print", "check")


def _phrase(text: bytes, at: int, size: int) -> bytes:
    words = []
    for _ in range(size):
        word = WORD.search(text, at)
        words.append(word.group().lower())
        at = word.end()
    return b" ".join(words)


def frequent_phrases(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    group: str = "lang",
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
) -> tuple[DataFrame, DataFrame]:
    """``group, phrase, size, times`` of all phrases of up to ``longest`` words that a
    group's texts hold ``min_count`` times at least, single words too; and
    ``group, words``, the number of all words of each group.

    A-Z are taken as a-z. Texts are split into pieces at ``.,;:!?`` and line ends
    and these into words at spaces and tabs; phrases lie within a piece and
    overlap. Texts of null group are those of ``und``; null texts are empty.
    """
    docs = _keyed(df, doc_id, text, group)
    levels, shorter = [], None
    for size in range(1, longest + 1):
        counted = _counted(docs, size, shorter).filter((F.col("times") >= min_count) | (F.col("check") < 0))
        level = materialize(counted.withColumn("size", F.lit(size)), f"frequent-{size}")
        levels.append(level)
        if size < longest:
            if shorter is not None:
                shorter.destroy()
            shorter = _filter(level.filter("check >= 0"))
    frequent = levels[0]
    for level in levels[1:]:
        frequent = frequent.union(level)
    phrases = materialize(_read(frequent.filter("check >= 0"), docs), "phrases")
    names = docs.select("salt", "group").distinct()
    totals = levels[0].filter("check < 0").join(names, F.col("print") == F.col("salt"))
    return phrases, totals.select("group", F.col("times").alias("words"))


def _part(words: str, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    group: str = "lang",
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    top: int = TOP,
) -> DataFrame:
    """``group, rank, phrase, a, l, r, n, score``: the firmest phrases of each group.

    Phrases have two words at least. Cut after its first k words, a phrase of
    count a scores ``floor(2000000 * a / (l + r))`` with the counts of both parts;
    its lowest cut counts, the shortest first part among equals. A phrase that a
    longer one covers in 80 % of its occurrences or more is left out. Of each
    group the first ``top`` by score, count and phrase are returned; the group's
    column has its name in ``df``. Other columns take no part, whatever their
    names. Tables without texts have no phrases.
    """
    phrases, totals = frequent_phrases(df, doc_id, text, group, longest, min_count)
    split = phrases.filter("size > 1").withColumn("words", F.split("phrase", " "))
    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"left": _part("words", 1, F.col("k")), "right": _part("words", F.col("k") + 1, F.col("size") - F.col("k"))})
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(phrases.select("group", F.col("phrase").alias(side), F.col("times").alias(name)), ["group", side])
    over = F.col("times").cast(_WHOLE) * F.lit(SCALE).cast("decimal(7,0)")
    score = F.call_function("div", over, F.col("l").cast(_WHOLE) + F.col("r").cast(_WHOLE))
    lowest = cuts.withColumn("score", score.cast("long")).groupBy("group", "phrase", "times").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    inner = split.filter("size > 2").withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    inner = inner.select("group", _part("words", F.col("start"), F.col("length")).alias("phrase"), "times")
    longer = inner.groupBy("group", "phrase").agg(F.max("times").alias("longer"))
    covered = F.col("longer").cast(_WHOLE) * 100 >= F.col("times").cast(_WHOLE) * COVERED
    kept = lowest.join(longer, ["group", "phrase"], "left").filter(~F.coalesce(covered, F.lit(False)))
    order = Window.partitionBy("group").orderBy(F.desc("cut.score"), F.desc("times"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.col("rank").cast("long"))
    return ranked.join(totals, "group").select(
        F.col("group").alias(group), "rank", "phrase", F.col("times").alias("a"), "cut.l", "cut.r", F.col("words").alias("n"), "cut.score"
    )
