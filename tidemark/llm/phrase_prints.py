"""Rabin-Karp fingerprints of the word n-grams of many texts at once.

Words and n-grams have two prefix polynomials each: one modulo 2^64, scattered,
as the fingerprint, and one modulo a prime as an independent check.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

from tidemark.llm.common import mix

# Bytes that end a piece, and those that part the words within one.
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
WORD = re.compile(rb"[^\x20\x09.,;:!?\x0a-\x0d]+")
_END = re.compile(rb"[.,;:!?\x0a-\x0d]")

BLOCK_BYTES = 1 << 18
_PRIME = (1 << 31) - 1
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # of bytes and of words, modulo 2^64
_CHECKS = (1_220_703_125, 594_156_893)  # the same, modulo the prime
_MOST_SUMMED = 1 << 23

_ENDS, _BREAKS, _LOWER = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool), np.arange(256, dtype=np.uint64)
_ENDS[list(ENDS)] = _BREAKS[list(ENDS + GAPS)] = True
_LOWER[65:91] += np.uint64(32)


class _Powers:
    """Powers of a base and of its inverse, made as far as they are needed."""

    def __init__(self, base: int, modulus: int):
        self.base, self.modulus = base, modulus
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            size = max(n + 1, BLOCK_BYTES + 1)
            self.up, self.down = (self._listed(x, size) for x in (self.base, pow(self.base, -1, self.modulus)))
        return self.up, self.down

    def _listed(self, base: int, size: int) -> np.ndarray:
        powers = np.ones(1, dtype=np.uint64)
        while len(powers) < size:
            more = powers * np.uint64(pow(base, len(powers), self.modulus))
            powers = np.concatenate([powers, more % np.uint64(self.modulus) if self.modulus < 1 << 64 else more])
        return powers[:size]


_WRAPPED = [_Powers(base, 1 << 64) for base in _BASES]
_CHECKED = [_Powers(base, _PRIME) for base in _CHECKS]


def _wrapped(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    up, down = powers(len(values))
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


def _checked(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """``values`` are below 2^31; sums of many products, or of large ones, are kept small by reducing these first."""
    up, down = powers(len(values))
    prime = np.uint64(_PRIME)
    terms = values * up[: len(values)]
    if len(values) > _MOST_SUMMED or values.max(initial=0) > 256:
        terms %= prime
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(terms, out=sums[1:])
    return ((sums[ends] - sums[starts]) % prime) * down[starts] % prime


class Words:
    """The words of texts joined by a byte that ends pieces: where each starts, its piece and its two values."""

    def __init__(self, data: bytes):
        raw = np.frombuffer(data, dtype=np.uint8)
        inside = np.zeros(len(raw) + 2, dtype=bool)
        np.logical_not(_BREAKS[raw], out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, ends = edges[::2], edges[1::2]
        self.piece = np.cumsum(_ENDS[raw])[self.starts] if len(raw) else self.starts
        values = _LOWER[raw] + np.uint64(1)
        self._prints = mix(_wrapped(values, self.starts, ends, _WRAPPED[0]))
        self._checks = _checked(values, self.starts, ends, _CHECKED[0])

    def __len__(self) -> int:
        return len(self.starts)

    def grams(self, size: int) -> np.ndarray:
        """Places of the words that begin an n-gram within their piece."""
        last = len(self) - size + 1
        return np.flatnonzero(self.piece[:last] == self.piece[size - 1 :]) if last > 0 else np.zeros(0, dtype=np.int64)

    def prints(self, at: np.ndarray, size: int, salt: np.ndarray) -> np.ndarray:
        """Fingerprints of the n-grams at these places; each has its own salt."""
        return mix(_wrapped(self._prints, at, at + size, _WRAPPED[1]) ^ salt)

    def checks(self, at: np.ndarray, size: int) -> np.ndarray:
        return _checked(self._checks, at, at + size, _CHECKED[1]).astype(np.int64)


def pieces(text: bytes) -> Iterator[tuple[int, bytes]]:
    """The text with its place, a long one cut where a piece ends."""
    start = 0
    while len(text) - start > BLOCK_BYTES:
        cut = _END.search(text, start + BLOCK_BYTES)
        if cut is None:
            break
        yield start, text[start : cut.start()]
        start = cut.end()
    yield start, text[start:] if start else text


def blocks(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Words]]:
    """Blocks of bounded size: the texts in them, where in the block and in the text they begin, and the words."""
    owners, offsets, parts, size = [], [], [], 0

    def joined():
        begins = np.cumsum([0] + [len(x) + 1 for x in parts[:-1]])
        return np.array(owners), begins, np.array(offsets), Words(b"\n".join(parts))

    for i, text in enumerate(texts):
        for offset, part in pieces(text):
            if parts and size + len(part) > BLOCK_BYTES:
                yield joined()
                owners, offsets, parts, size = [], [], [], 0
            owners.append(i)
            offsets.append(offset)
            parts.append(part)
            size += len(part) + 1
    if parts:
        yield joined()
