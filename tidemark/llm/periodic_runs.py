"""Periodic runs of words: stretches that repeat their first words at least some times over.

1. A run of period q that holds ``min_exponent`` periods covers as many
   neighbouring multiples of q, so equal words on such multiples, the harmonic
   grid, are its candidates. All periods of a text have n log n grid places.
2. Texts with candidates are recompressed into a run-length grammar
   (``run_grammar``). How far words q apart stay equal, to the right and, on the
   grammar of the reversed words, to the left, gives the exact run.
3. Of the periods found for a stretch the smallest counts.

Nothing is shuffled: a text is worked on where it is read, with others in
slices of bounded size; a longer text is a slice of its own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, utf8
from tidemark.llm.run_grammar import Grammar

MIN_EXPONENT, MIN_WORDS = 4, 6
_AT_ONCE, _TURNS = 1 << 20, 4
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_NONE = np.zeros(0, dtype=np.int64)


def _grid(words: np.ndarray, begins: np.ndarray, sizes: np.ndarray, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods of equal words on neighbouring multiples of the period.

    ``begins`` and ``sizes`` are those of the texts in ``words``, shortest first:
    a period is only looked for in texts long enough for it.
    """
    places, periods = [_NONE], [_NONE]
    longest = int(sizes[-1]) if len(sizes) else 0
    wanted = np.arange(1, longest // exponent + 1)
    offsets = begins[np.searchsorted(sizes, wanted * exponent)]
    for period, offset in zip(wanted.tolist(), offsets.tolist(), strict=True):
        grid = words[offset::period]
        equal = grid[1:] == grid[:-1]
        hits = equal[: len(equal) - exponent + 2].copy()
        for ahead in range(1, exponent - 1):
            hits &= equal[ahead : ahead + len(hits)]
        at = np.flatnonzero(hits)
        if len(at):
            places.append(offset + period * at)
            periods.append(np.full(len(at), period))
    return np.concatenate(places), np.concatenate(periods)


def _joined(texts: list[np.ndarray], kinds: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, a word of its own before, between and after them, and where each begins."""
    parts, begins, at = [np.array([kinds])], [], 1
    for i, text in enumerate(texts, 1):
        begins.append(at)
        parts += [text, np.array([kinds + i])]
        at += len(text) + 1
    return np.concatenate(parts).astype(np.int32), np.array(begins, dtype=np.int64)


def _extended(words: np.ndarray, places: np.ndarray, periods: np.ndarray, least: np.ndarray) -> Iterator[np.ndarray]:
    """Start, length and period of what the places extend to, where it has the least length.

    Of neighbouring places the first is extended, then the first that this does
    not reach, and after some such turns all that are left.
    """
    onwards, backwards = Grammar(words), Grammar(words[::-1])
    streak = np.cumsum((np.diff(places, prepend=-1) != periods) | (np.diff(periods, prepend=0) != 0))
    left = np.arange(len(places))
    for turn in range(_TURNS + 1):
        heads = left if turn == _TURNS else left[np.flatnonzero(np.diff(streak[left], prepend=0))]
        reached = np.full(int(streak[-1]) + 1, -1, dtype=np.int64)
        for part in range(0, len(heads), _AT_ONCE):
            own = heads[part : part + _AT_ONCE]
            at, period = places[own], periods[own]
            right = onwards.extension(at, at + period)
            before = backwards.extension(len(words) - at, len(words) - at - period)
            reached[streak[own]] = at + right
            enough = before + right + period >= least[own]
            yield np.unique(np.stack([at - before, before + right + period, period])[:, enough], axis=1)
        left = left[places[left] > reached[streak[left]]]
        if turn == _TURNS or not len(left):
            return


def runs_of(texts: list[np.ndarray], min_exponent: int = MIN_EXPONENT, min_words: int = MIN_WORDS) -> dict[int, np.ndarray]:
    """Runs of texts given as arrays of word numbers: for each text that has any, rows of start, length, period.

    Runs are in the order of start, then period.
    """
    kinds = max((int(x.max()) + 1 for x in texts if len(x)), default=1)
    order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    joined, begins = _joined([texts[i] for i in order], kinds)
    sizes = np.array([len(texts[i]) for i in order], dtype=np.int64)
    places, periods = _grid(joined, begins, sizes, min_exponent)
    owners = np.searchsorted(begins, places, side="right") - 1
    inside = places + (min_exponent - 1) * periods < begins[owners] + sizes[owners] if len(places) else places > 0
    places, periods, owners = places[inside], periods[inside], owners[inside]
    if not len(places):
        return {}
    chosen, owners = np.unique(owners, return_inverse=True)
    kept, starts = _joined([texts[order[i]] for i in chosen], kinds)
    places += (starts - begins[chosen])[owners]
    found = list(_extended(kept, places, periods, np.maximum(min_words, min_exponent * periods)))
    start, length, period = np.unique(np.concatenate(found, axis=1), axis=1)
    smallest = np.ones(len(start), dtype=bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[smallest], length[smallest], period[smallest]
    owners = np.searchsorted(starts, start, side="right") - 1
    start -= starts[owners]
    by_place = np.lexsort((period, start, owners))
    rows, owners = np.stack([start, length, period], axis=1)[by_place], owners[by_place]
    edges = np.flatnonzero(np.diff(owners, prepend=-1, append=-1))
    return {order[chosen[owners[x]]]: rows[x:y] for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)}


def _kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words no run holds after its first period."""
    marks = np.zeros(n + 1, dtype=np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 0] + runs[:, 1], -1)
    return np.flatnonzero(np.cumsum(marks[:-1]) == 0)


def periodic_runs(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", min_exponent: int = MIN_EXPONENT, min_words: int = MIN_WORDS
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for each row.

    Words are split at ASCII white space. ``runs`` lists ``start, length, period``
    of each run, in words, by start, then period: its words repeat with the
    smallest period, ``min_exponent`` (2 at least) times over and ``min_words``
    long at least, and no word beside it goes on with it. ``collapsed`` is the
    text without the words that a run repeats, joined by one space. Null and empty
    texts have no words, no runs and an empty ``collapsed``; repeated rows have
    equal results. Other columns of ``df`` take no part, whatever their names.
    """
    if min_exponent < 2:
        raise ValueError("min_exponent is 2 at least")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            for part in in_slices(texts):
                numbers = defaultdict(count().__next__)
                split = [x.split() for x in texts[part]]
                coded = [np.fromiter(map(numbers.__getitem__, x), dtype=np.int32, count=len(x)) for x in split]
                found = runs_of(coded, min_exponent, min_words)
                collapsed = []
                for i, words in enumerate(split):
                    if i in found:
                        words = [words[at] for at in _kept(len(words), found[i]).tolist()]
                    collapsed.append(b" ".join(words))
                lengths = [len(found.get(i, ())) for i in range(len(split))]
                rows = np.concatenate([found[i] for i in sorted(found)] or [np.zeros((0, 3), dtype=np.int64)])
                runs = pa.StructArray.from_arrays([pa.array(x) for x in rows.T], fields=list(_RUN))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part.start : part.stop],
                        pa.array([len(x) for x in split], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), runs),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    own = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return own.mapInArrow(find, schema).withColumnRenamed("doc_id", doc_id)
