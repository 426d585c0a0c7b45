"""Token ids in files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents in blocks of 256. Of each block
the minimum is subtracted and the rest packed at a width that fits a percentile
of its values; the values that need more bits lie in an exception list. An index
has the start of every block, so that any stretch of ids can be read by itself.

    "PFOR1\\0\\0\\0" | packed blocks | exceptions: block u32, position u16, value u32
    | index: minimum u32, width u8, start u64 of each block
    | documents: id i64, id is null u8, number of ids u64
    | trailer: blocks, exceptions, documents, ids, bytes of the packed blocks (u64 each)
"""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import file_folder, write_file
from tidemark.sources.shared import materialize

MAGIC = b"PFOR1\0\0\0"
BLOCK = 256
PERCENTILE = 90
FILE_IDS = 4 << 20
_AT_ONCE = 4 << 20  # characters encoded at once, beyond the first text
_STEP = 1 << 12  # blocks packed or unpacked at once


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit lengths of 32-bit integers."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width as rows of bytes."""
    bits = (values[:, :, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8).reshape(len(values), -1), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(packed), BLOCK, width)
    out = np.zeros((len(packed), BLOCK), dtype=np.uint32)
    for i in range(width):
        out |= bits[:, :, i].astype(np.uint32) << np.uint32(i)
    return out


def pack_file(ids: np.ndarray, doc_ids: list[int | None], counts: list[int], percentile: float = PERCENTILE) -> bytes:
    """A file of the documents' ids, one document's after the other's."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, dtype=np.uint32)
    padded[:n] = ids
    if n:
        padded[n:] = ids[(blocks - 1) * BLOCK :].min()
    rows = padded.reshape(blocks, BLOCK)
    minimum = rows.min(axis=1) if blocks else np.zeros(0, dtype=np.uint32)
    widths = np.zeros(blocks, dtype=np.uint8)
    lists, payloads = [], []
    for at in range(0, blocks, _STEP):
        part = rows[at : at + _STEP] - minimum[at : at + _STEP, None]
        bits = _bits(part)
        width = np.sort(bits, axis=1)[:, int((BLOCK - 1) * percentile / 100)]
        widths[at : at + _STEP] = width
        block, position = np.nonzero(bits > width[:, None])
        lists.append((block + at, position, part[block, position]))
        sizes = width.astype(np.int64) * (BLOCK // 8)
        starts = np.cumsum(sizes) - sizes
        payload = np.zeros(sizes.sum(), dtype=np.uint8)
        for w in np.unique(width[width > 0]):
            own = np.flatnonzero(width == w)
            low = part[own] & np.uint32((1 << int(w)) - 1)
            payload[starts[own][:, None] + np.arange(sizes[own[0]])] = _pack(low, int(w))
        payloads.append(payload.tobytes())
    packed = b"".join(payloads)
    found = [np.concatenate(x) if lists else np.zeros(0) for x in zip(*lists, strict=True)] or [np.zeros(0)] * 3
    sizes = widths.astype(np.uint64) * np.uint64(BLOCK // 8)
    return b"".join(
        [
            MAGIC,
            packed,
            *(x.astype(kind).tobytes() for x, kind in zip(found, ("<u4", "<u2", "<u4"), strict=True)),
            minimum.astype("<u4").tobytes(),
            widths.tobytes(),
            (np.cumsum(sizes) - sizes).astype("<u8").tobytes(),
            np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes(),
            np.array([x is None for x in doc_ids], dtype=np.uint8).tobytes(),
            np.array(counts, dtype="<u8").tobytes(),
            np.array([blocks, len(found[0]), len(doc_ids), n, len(packed)], dtype="<u8").tobytes(),
        ]
    )


class IdFile:
    """Read a file's documents and any stretch of its ids."""

    def __init__(self, data: bytes) -> None:
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a file of id blocks")
        blocks, exceptions, docs, self.n_ids, size = (int(x) for x in np.frombuffer(data[-40:], dtype="<u8"))
        self._packed = np.frombuffer(data, dtype=np.uint8, count=size, offset=len(MAGIC))
        at = len(MAGIC) + size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, dtype=kind, count=n, offset=at)
            at += found.nbytes
            return found

        self._block, self._position, self._value = (take(k, exceptions) for k in ("<u4", "<u2", "<u4"))
        self._minimum, self._width, self._start = (take(k, blocks) for k in ("<u4", "u1", "<u8"))
        ids, null, self.counts = (take(k, docs) for k in ("<i8", "u1", "<u8"))
        self.doc_ids = [None if x else int(i) for i, x in zip(ids, null, strict=True)]
        if at + 40 != len(data) or int(self.counts.sum()) != self.n_ids:
            raise ValueError("the file's parts do not add up to its length")

    def read(self, start: int, stop: int) -> np.ndarray:
        """The ids at these places."""
        stop = min(stop, self.n_ids)
        if stop <= start:
            return np.zeros(0, dtype=np.uint32)
        first, last = start // BLOCK, -(-stop // BLOCK)
        out = np.empty((last - first, BLOCK), dtype=np.uint32)
        for at in range(first, last, _STEP):
            end = min(at + _STEP, last)
            part, width = np.zeros((end - at, BLOCK), dtype=np.uint32), self._width[at:end]
            for w in np.unique(width[width > 0]):
                own = np.flatnonzero(width == w)
                where = self._start[at:end][own].astype(np.int64)
                part[own] = _unpack(self._packed[where[:, None] + np.arange(int(w) * BLOCK // 8)], int(w))
            a, b = np.searchsorted(self._block, (at, end))
            part[self._block[a:b].astype(np.int64) - at, self._position[a:b]] = self._value[a:b]
            out[at - first : end - first] = part + self._minimum[at:end, None]
        return out.reshape(-1)[start - first * BLOCK : stop - first * BLOCK]


def write(
    df: DataFrame,
    encoder: Callable[[], Callable[[list[str]], list[np.ndarray]]],
    doc_id: str = "doc_id",
    text: str = "text",
    file_ids: int = FILE_IDS,
) -> tuple[str, DataFrame]:
    """Encode the documents and write their ids in ascending order of their ids; the folder and the list of files.

    ``encoder()`` is called once in each task and gives the function from texts
    to ids. Documents without an id come first. The list of files has one row for
    each file that counts: a task that was lost may leave others behind.
    """
    folder = file_folder(df.sparkSession, "id-blocks")

    def write_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(), TaskContext.get().partitionId()
        serial = itertools.count()
        names: list[int | None] = []
        ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            no, total = next(serial), sum(map(len, ids))
            name = f"{part:08d}-{no:06d}-{uuid.uuid4().hex}.pfor"
            joined = np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint32)
            write_file(f"{folder}/{name}", pack_file(joined, names, [len(x) for x in ids]))
            names.clear()
            ids.clear()
            row = {"name": [name], "part": [part], "no": [no], "n_ids": [total]}
            return pa.RecordBatch.from_pydict(row, schema=_FILES)

        size = 0
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
            ends = np.cumsum([len(x) for x in texts])
            groups = np.flatnonzero(np.diff(ends // _AT_ONCE)) + 1
            for low, high in itertools.pairwise([0, *groups.tolist(), len(texts)]):
                for key, own in zip(keys[low:high], encode(texts[low:high]), strict=True):
                    names.append(key)
                    ids.append(own)
                    size += len(own)
                    if size >= file_ids:
                        yield flush()
                        size = 0
        if names:
            yield flush()

    # Rows without an id, or with the same one, are told apart by their texts' hashes.
    by = [F.col(doc_id), F.xxhash64(text)]
    ordered = df.select(doc_id, text).repartitionByRange(*by).sortWithinPartitions(*by, text)
    files = ordered.mapInArrow(write_files, "name string, part int, no int, n_ids long")
    return folder, materialize(files, "id-files")


_FILES = pa.schema([("name", pa.string()), ("part", pa.int32()), ("no", pa.int32()), ("n_ids", pa.int64())])


def read(spark: SparkSession, folder: str, files: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """A row for each document: its id, ``start`` among all ids, ``n_tokens`` and ``ids_crc32``, from the files."""

    def read_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                file = IdFile(data.as_buffer().to_pybytes())
                ends = np.cumsum(file.counts.astype(np.int64))
                starts = ends - file.counts.astype(np.int64)
                sums = _checksums(file, starts, ends)
                arrays = [
                    pa.array([os.path.basename(path)] * len(ends), pa.string()),
                    pa.array(file.doc_ids, pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["name", doc_id, "_at", "n_tokens", "ids_crc32"])

    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(folder).select("path", "content")
    fields = f"name string, {doc_id} long, _at long, n_tokens long, ids_crc32 long"
    rows = stored.mapInArrow(read_files, fields)
    before = Window.orderBy("part", "no").rowsBetween(Window.unboundedPreceding, -1)
    based = files.select("name", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("_base"))
    return rows.join(based, "name").select(doc_id, (F.col("_base") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32")


def _checksums(file: IdFile, starts: np.ndarray, ends: np.ndarray) -> list[int]:
    """CRC-32 of each document's ids, some millions of ids unpacked at a time."""
    sums = []
    low = high = 0
    ids = np.zeros(0, dtype=np.uint32)
    for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
        if end > high:
            low, high = start, max(end, start + (1 << 20))
            ids = file.read(low, high)
        sums.append(zlib.crc32(ids[start - low : end - low].astype("<u4").tobytes()))
    return sums


_encoders: dict[tuple, Callable[[list[str]], list[np.ndarray]]] = {}


class TokenizerFile:
    """Encode with the tokenizers library and a tokenizer file's content, an end id after each document.

    The byte-level pattern always cuts before a space that a character follows,
    so texts are cut there, and each different unit is encoded once: one of Latin
    letters, marks and single line ends by its pre-tokens, which need no pattern,
    any other by the library as it is. Files with another normaliser or
    pre-tokeniser encode whole texts.

    The added tokens' strings are ordinary text, or, with ``added_tokens``, one id
    each, which is the library's default.
    """

    _MEMO = 400_000

    def __init__(self, spark: SparkSession, path: str, end_id: int, added_tokens: bool = False) -> None:
        with open(path, encoding="utf-8") as file:
            content = file.read()
        self._content = spark.sparkContext.broadcast(content)
        self._end, self._added = end_id, added_tokens
        parts = json.loads(content)
        split = parts.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        self._cuts = bool(plain and parts.get("normalizer") is None)

    def __call__(self) -> Callable[[list[str]], list[np.ndarray]]:
        """The function from texts to ids; a Python worker keeps the last one, and the units it knows, for its next tasks."""
        key = (self._content.value, self._end, self._added, self._MEMO)
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = self._encoder()
        return _encoders[key]

    def _encoder(self) -> Callable[[list[str]], list[np.ndarray]]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(self._content.value)
        whole.encode_special_tokens = not self._added
        end = np.array([self._end], dtype=np.uint32)

        def packed(texts: list[str]) -> list[bytes]:
            return [array("I", x.ids).tobytes() for x in whole.encode_batch_fast(texts, add_special_tokens=False)]

        def by_library(texts: list[str]) -> list[np.ndarray]:
            return [np.append(np.frombuffer(x, dtype=np.uint32), end) for x in packed(texts)]

        if not self._cuts:
            return by_library
        units = _Units(whole, packed, self._MEMO)
        added = [x["content"] for x in json.loads(self._content.value)["added_tokens"]] if self._added else []

        def encode(texts: list[str]) -> list[np.ndarray]:
            odd = [_ODD.search(x) is not None for x in texts]
            asis = [any(token in x for token in added) for x in texts]
            even = [i for i, (a, b) in enumerate(zip(odd, asis, strict=True)) if not a and not b]
            uneven = [i for i, (a, b) in enumerate(zip(odd, asis, strict=True)) if a and not b]
            whole_ones = [i for i, b in enumerate(asis) if b]
            found: list[np.ndarray] = [end] * len(texts)
            if even:
                cut = pc.split_pattern(pa.array([texts[i] for i in even], pa.large_string()), " ")
                for i, ids in zip(even, units.encode(cut), strict=True):
                    found[i] = np.append(ids, end)
            if uneven:
                cut = pa.array([_cut_at_spaces(texts[i]) for i in uneven], pa.list_(pa.large_string()))
                for i, ids in zip(uneven, units.encode(cut), strict=True):
                    found[i] = np.append(ids, end)
            for i, ids in zip(whole_ones, by_library([texts[i] for i in whole_ones]), strict=True):
                found[i] = ids
            return found

        return encode


class _Units:
    """The ids of texts that are cut at spaces, each different unit encoded once while it is remembered."""

    def __init__(self, whole, packed: Callable[[list[str]], list[bytes]], memo: int) -> None:
        from tokenizers.pre_tokenizers import ByteLevel

        bytewise = ByteLevel(add_prefix_space=False, use_regex=False)
        self._spelled = {ord(c): bytewise.pre_tokenize_str(c)[0][0] for c in (" ", "\n", *_LATIN)}
        self._space = self._spelled[ord(" ")]
        self._model, self._packed, self._memo = whole.model, packed, memo
        self._known: dict[str, bytes] = {}  # by what follows the space
        self._bare: dict[str, bytes] = {}  # pre-tokens without a space

    def _pretoken(self, value: str) -> bytes:
        """The ids of letters or marks, perhaps after a space, or of a line end."""
        plain = value.isascii() and value != "\n"
        spelled = value.replace(" ", self._space) if plain else value.translate(self._spelled)
        return array("I", [x.id for x in self._model.tokenize(spelled)]).tobytes()

    def _learn(self, units: list[str]) -> None:
        known, bare, rest = self._known, self._bare, []
        for unit in units:
            if _WORD.fullmatch(unit):
                known[unit] = self._pretoken(" " + unit)
            elif _WORDS.fullmatch(unit):
                first, *others = _PARTS.findall(unit)
                if first not in known:
                    known[first] = self._pretoken(" " + first)
                for part in others:
                    if part not in bare:
                        bare[part] = self._pretoken(part)
                known[unit] = known[first] + b"".join([bare[x] for x in others])
            else:
                rest.append(unit)
        known.update(zip(rest, self._packed([f" {x}" for x in rest]), strict=True))

    def encode(self, cut: pa.Array) -> list[np.ndarray]:
        """The ids of each list: its first element as it is, the others after a space."""
        offsets = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        codes, heads = coded.indices.to_numpy().astype(np.int64), offsets[:-1]
        different = coded.dictionary
        firsts = different.take(pa.array(codes[heads])).to_pylist()
        # Units that only begin texts are not looked up.
        times = np.bincount(codes, minlength=len(different)) - np.bincount(codes[heads], minlength=len(different))
        used = np.flatnonzero(times)
        place = np.zeros(len(different), dtype=np.int64)
        place[used] = np.arange(len(used))
        codes = place[codes]
        codes[heads] = len(used) + np.arange(len(heads))
        names = different.take(pa.array(used)).to_numpy(zero_copy_only=False).tolist()
        self._learn([x for x in names if x not in self._known])
        ids = [*map(self._known.__getitem__, names), *self._packed(firsts)]
        if len(self._known) > self._memo:  # what these texts have is likelier to come again
            self._known = {x: self._known[x] for x in names if len(x) < 64}
        if len(self._bare) > self._memo:
            self._bare = {}
        sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        begins = np.cumsum(sizes) - sizes
        lengths = sizes[codes]
        ends = np.cumsum(lengths)
        places = np.repeat(begins[codes] - (ends - lengths), lengths) + np.arange(ends[-1])
        joined = np.frombuffer(b"".join(ids), dtype=np.uint32)[places]
        return np.split(joined, ends[offsets[1:-1] - 1])


# Latin letters, and units of pre-tokens that need no pattern to be told apart: a word after the space, then marks,
# single line ends and words in turn. An apostrophe may belong to either side, so it is no such mark.
_LATIN = [chr(c) for a, b in ((0xC0, 0xD7), (0xD8, 0xF7), (0xF8, 0x250)) for c in range(a, b)]
_LETTERS, _MARKS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+", "[!-&(-/:-@\\[-`{-~]+"
_WORD = re.compile(_LETTERS)
_WORDS = re.compile(f"{_LETTERS}(?:{_MARKS})?(?:\n(?:{_LETTERS}(?:{_MARKS})?))*")
_PARTS = re.compile(f"{_LETTERS}|{_MARKS}|\n")
_SPACED = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?:\s|\Z)")


def _cut_at_spaces(text: str) -> list[str]:
    """The text cut at each space that a character follows; what stands before the first, then what follows each."""
    edges = [-1, *(m.start() for m in _SPACED.finditer(text)), len(text)]
    return [text[a + 1 : b] for a, b in itertools.pairwise(edges)]
