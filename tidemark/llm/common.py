"""What several operators need: reading, writing files, hashing words in bulk."""

from __future__ import annotations

import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemark
from tidemark.sources.shared import filesystem, new_folder

# ASCII white space: space and 0x09 to 0x0D.
SPACES = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Spark hand this package to the Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(tidemark.__file__).parent
    archive = Path(tempfile.mkdtemp()) / "tidemark.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def names_apart(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let an operator name its own columns with a first underscore, whatever columns its table has.

    Such columns of the table have other names inside, and their own again in the result.
    """

    @wraps(operator)
    def run(df: DataFrame, *args, **options) -> DataFrame:
        taken = {c.lower() for c in df.columns}
        aside: dict[str, str] = {}
        for column in df.columns:
            if column.startswith("_"):
                name = f"caller{column}"
                while name.lower() in taken:
                    name = f"caller_{name}"
                taken.add(name.lower())
                aside[column] = name

        def known(value):
            if isinstance(value, list):
                return [known(x) for x in value]
            return aside.get(value, value) if isinstance(value, str) else value

        found = operator(df.withColumnsRenamed(aside), *map(known, args), **{k: known(v) for k, v in options.items()})
        return found.withColumnsRenamed({name: column for column, name in aside.items()})

    return run


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """A key of the row's contents: also rows without an id, or with another's id, have their own."""
    return F.xxhash64(F.col(id_column), F.col(text_column))


def fold(id_column: str, folds: int) -> Column:
    """The remainder of the id's CRC-32; rows without an id are in fold 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds, F.lit(0))


def file_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared one, as a URI that tasks can open."""
    path = new_folder(spark, label)
    files, folder = filesystem(spark, path)
    files.mkdirs(folder)
    uri = files.makeQualified(folder).toUri()
    return f"file://{uri.getPath()}" if uri.getScheme() == "file" else uri.toString()


def write_file(uri: str, data: bytes) -> None:
    """Write a whole file from a task, in whatever store the folder lies."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_output_stream(path, compression=None) as out:
        out.write(data)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit integers, one to one."""
    x = np.asarray(x, dtype=np.uint64).copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    up = down = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_Powers.up) < n + 1:
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            factors = np.full(n + 1, base, dtype=np.uint64)
            factors[0] = 1
            setattr(_Powers, name, np.multiply.accumulate(factors))
    return _Powers.up, _Powers.down


_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _block_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word: a polynomial over its bytes, A-Z as a-z."""
    inside = np.empty(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(_IS_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(max(len(data), BLOCK_BYTES))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """The texts, long ones cut at white space, with their numbers."""
    for i, text in enumerate(texts):
        start = 0
        while len(text) - start > BLOCK_BYTES:
            cut = _SPACE.search(text, start + BLOCK_BYTES)
            if cut is None:
                break
            yield i, text[start : cut.start()]
            start = cut.start()
        yield i, text[start:] if start else text


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of all texts, in order, and how many each text has."""
    counts = np.zeros(len(texts), dtype=np.int64)
    found: list[np.ndarray] = []
    owners: list[int] = []
    block: list[bytes] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if not block:
            return
        lengths = np.array([len(x) + 1 for x in block])
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        starts, hashes = _block_hashes(np.frombuffer(b"\n".join(block), dtype=np.uint8))
        own = np.bincount(np.searchsorted(begins, starts, side="right") - 1, minlength=len(block))
        np.add.at(counts, np.array(owners), own)
        found.append(hashes)
        block.clear()
        owners.clear()
        size = 0

    for i, piece in _pieces(texts):
        if size + len(piece) > BLOCK_BYTES:
            flush()
        block.append(piece)
        owners.append(i)
        size += len(piece)
    flush()
    return (np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)), counts


def shingle_hashes(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and how many each text has.

    A text with fewer words has one shingle of all of them, one without words has none.
    """
    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    starts = ends - counts
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    short = (counts > 0) & (counts < width)
    sums = np.zeros(max(len(words), 1), dtype=np.uint64)
    for j in range(width):
        sums[: len(words) - j] += words[j:] * factors[j]
    shingles = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(shingles)[:-1]])
    at = np.arange(shingles.sum()) + np.repeat(starts - first, shingles)
    result = sums[at] if len(at) else np.zeros(0, dtype=np.uint64)
    for i in np.flatnonzero(short):
        own = words[starts[i] : ends[i]]
        result[first[i]] = (own * factors[: len(own)]).sum() + np.uint64(len(own))
    return mix(result), shingles


def in_slices(texts: list, most_bytes: int = 2 * BLOCK_BYTES, most: int = 4096) -> Iterator[slice]:
    """Consecutive slices of a bounded size; a longer text is a slice of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and (size + len(text) > most_bytes or i - start >= most):
            yield slice(start, i)
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield slice(start, len(texts))


def utf8(column) -> list[bytes]:
    """An Arrow column of texts as bytes; null as empty."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
