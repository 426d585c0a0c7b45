"""A run-length grammar of a sequence by recompression, and longest common extensions on it.

Levels alternate two steps. Block compression names each maximal block of one
symbol by the symbol and its length. Pair compression deals the symbols into
left and right ones and names each pair of a left one followed by a right one.
Both only look at the symbols next to them, so equal stretches of the sequence
are named alike on every level, but for a symbol or so at either end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from tidemark.llm.common import mix


@dataclass
class _Step:
    """The symbols of a level, the symbol above each of them, and the first below each of the next level's."""

    symbols: np.ndarray
    above: np.ndarray
    first: np.ndarray
    blocks: bool


def _names(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs of small integers."""
    _, names = np.unique(one.astype(np.int64) * (int(other.max()) + 1) + other, return_inverse=True)
    return names.astype(np.int32)


def _blocks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a symbol begins a block, and the names of the blocks."""
    begins = np.ones(len(symbols), dtype=bool)
    np.not_equal(symbols[1:], symbols[:-1], out=begins[1:])
    first = np.flatnonzero(begins)
    return begins, _names(symbols[first], np.diff(first, append=len(symbols)))


def _pairs(symbols: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether a symbol begins a pair or stands alone, and the names of pairs and single symbols."""
    left = (mix(np.arange(int(symbols.max()) + 1, dtype=np.uint64) + np.uint64(level << 40)) & np.uint64(1)).astype(bool)[symbols]
    joined = left[:-1] & ~left[1:]
    turned = ~left[:-1] & left[1:]
    if np.count_nonzero(turned) > np.count_nonzero(joined):
        joined = turned
    begins = np.ones(len(symbols), dtype=bool)
    begins[1:] = ~joined
    second = np.zeros(len(symbols), dtype=np.int64)
    second[:-1][joined] = symbols[1:][joined].astype(np.int64) + 1
    first = np.flatnonzero(begins)
    return begins, _names(symbols[first], second[first])


class Grammar:
    """Grammar of a sequence of small integers whose last one occurs nowhere else in it."""

    def __init__(self, sequence: np.ndarray):
        self._steps: list[_Step] = []
        symbols = np.asarray(sequence, dtype=np.int32)
        while len(symbols) > 1:
            blocks = len(self._steps) % 2 == 0
            begins, named = _blocks(symbols) if blocks else _pairs(symbols, len(self._steps))
            above = (np.cumsum(begins) - 1).astype(np.int32)
            self._steps.append(_Step(symbols, above, np.append(np.flatnonzero(begins), len(symbols)).astype(np.int32), blocks))
            symbols = named

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """For each two different places, how far the sequence reads alike from both.

        The two readings climb as long as both are at the beginning of a symbol of
        the next level; where they differ they descend to the first difference.
        """
        a, b = np.array(i, dtype=np.int64), np.array(j, dtype=np.int64)
        fell: list[np.ndarray] = []
        rising = np.arange(len(a))
        for step in self._steps:
            x, y = a[rising], b[rising]
            aligned = (step.first[step.above[x]] == x) & (step.first[step.above[y]] == y)
            same = step.symbols[x] == step.symbols[y]
            stuck = ~aligned & ~same
            if step.blocks:
                rest = [step.first[step.above[z] + 1] - z for z in (x, y)]
                ahead = np.minimum(*rest)
                stuck |= ~aligned & (rest[0] != rest[1])
            else:
                ahead = 1
            ahead = np.where(~aligned & same, ahead, 0)
            a[rising], b[rising] = x + ahead, y + ahead
            fell.append(rising[stuck])
            rising = rising[~stuck]
            a[rising], b[rising] = step.above[a[rising]], step.above[b[rising]]
        # Two places never climb into one symbol, so by the last step all have fallen.
        sinking = np.zeros(0, dtype=np.int64)
        for level in range(len(self._steps) - 1, -1, -1):
            step = self._steps[level]
            x, y = step.first[a[sinking]].astype(np.int64), step.first[b[sinking]].astype(np.int64)
            same = step.symbols[x] == step.symbols[y]
            ahead = np.minimum(*(step.first[z[sinking] + 1] - step.first[z[sinking]] for z in (a, b))) if step.blocks else 1
            ahead = np.where(same, ahead, 0)
            a[sinking], b[sinking] = x + ahead, y + ahead
            sinking = np.concatenate([sinking, fell[level]])
        return a - i
