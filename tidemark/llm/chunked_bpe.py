"""Byte-level BPE by a rank file, long texts in overlapping chunks.

A text is cut into pre-tokens by the vocabulary's pattern, and each pre-token is
encoded by itself. A long text is spread over tasks: its chunks overlap and are
pre-tokenised on their own, beginning anywhere, perhaps inside a word. A match
depends only on the text from its start on, so as soon as two neighbours agree
on one boundary they agree on all that follow. There they are stitched, and the
pieces between the stitches are encoded in parallel. Where neighbours never
agree in their overlap (a word or a run of white space longer than that), the
rest of that text is one piece. Decoding concatenates the tokens' bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import names_apart

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 1 << 10
# A match that ends so near to a chunk's end could go on in the text that follows.
_GUARD = 3
_MEMO = 150_000


class RankCoder:
    """Encode and decode with a rank file's content; pre-tokens seen before are looked up."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        import regex
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines() if x)}
        self._encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        # White space as the encoder's own pattern engine has it: without U+001C to U+001F.
        self._match = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self._known: dict[str, bytes] = {}

    def boundaries(self, text: str) -> np.ndarray:
        """Where the pre-tokens of the text start, and its end."""
        return np.array([0, *(m.end() for m in self._match.finditer(text))], dtype=np.int64)

    def encode(self, text: str) -> bytes:
        """The ids, as packed 32-bit integers."""
        known = self._known
        out = []
        for piece in self._match.findall(text):
            ids = known.get(piece)
            if ids is None:
                if len(known) >= _MEMO:
                    known.clear()
                ids = np.array(self._encoding.encode_ordinary(piece), dtype=np.uint32).tobytes()
                if len(piece) < 64:
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return self._encoding.decode_bytes(np.frombuffer(ids, dtype=np.uint32).tolist())


@lru_cache(maxsize=2)
def _coder(ranks: bytes, pattern: str) -> RankCoder:
    return RankCoder(ranks, pattern)


class Codec:
    """What tasks need to build a RankCoder: the rank file's content, sent once to each executor."""

    def __init__(self, spark, ranks_path: str, pattern: str) -> None:
        with open(ranks_path, "rb") as file:
            self._ranks = spark.sparkContext.broadcast(file.read())
        self._pattern = pattern

    def coder(self) -> RankCoder:
        return _coder(self._ranks.value, self._pattern)


def stitch(starts: list[int], heads: list[list[int]], tails: list[list[int]], length: int) -> list[tuple[int, int, int]]:
    """For each chunk the piece it belongs to and the part of the text it gives to it.

    ``heads`` are the boundaries each chunk finds in its first stretch, ``tails``
    those it finds where it overlaps the next.
    """
    meets = [starts[0]]
    for i in range(1, len(starts)):
        common = np.intersect1d(tails[i - 1], heads[i])
        if not len(common):
            break
        meets.append(int(common[0]))
    whole = len(meets)  # chunks that have found their place
    parts = []
    for i in range(len(starts)):
        if i < whole - 1:
            parts.append((i, meets[i], meets[i + 1]))
        else:  # the last that has, and all after it
            low = meets[i] if i < whole else starts[i]
            parts.append((whole - 1, low, starts[i + 1] if i + 1 < len(starts) else length))
    # The last piece may begin behind the next chunk's start.
    return [(piece, low, max(low, high)) for piece, low, high in parts]


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """Rows of ``__key, no, length, part``: chunk ``no`` of the text and the overlap with the next."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for no, start in enumerate(range(0, len(text), chunk)):
                    row = {"__key": [key], "no": [no], "length": [len(text)], "part": [text[start : start + chunk + overlap]]}
                    kinds = [("__key", pa.string()), ("no", pa.int32()), ("length", pa.int64()), ("part", pa.string())]
                    yield pa.RecordBatch.from_pydict(row, schema=pa.schema(kinds))

    cut_up = texts.select("__key", "_text").mapInArrow(cut, "__key string, no int, length long, part string")
    return cut_up.repartition("__key", "no")


def _encode_long(texts: DataFrame, codec: Codec, chunk: int, overlap: int) -> DataFrame:
    """``__key`` and ``ids`` of different long texts (``__key, _text``)."""
    chunks = _chunks(texts, chunk, overlap)

    def pre_tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec.coder()
        for batch in batches:
            heads, tails = [], []
            for no, length, part in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                start = no * chunk
                found = coder.boundaries(part)
                sure = found if start + len(part) == length else found[found <= len(part) - _GUARD]
                heads.append((start + found[found <= overlap]).tolist())
                tails.append((start + sure[sure >= chunk]).tolist())
            arrays = [pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))]
            columns = [batch.column(i) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, *arrays], names=["__key", "no", "length", "head", "tail"])

    def meet(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("no")
        starts = [int(n) * chunk for n in rows["no"]]
        parts = stitch(starts, list(rows["head"]), list(rows["tail"]), int(rows["length"].iloc[0]))
        piece, low, high = zip(*parts, strict=True)
        return pd.DataFrame({"__key": rows["__key"], "no": rows["no"], "piece": piece, "low": low, "high": high})

    def encode(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("no")
        shares = zip(rows["part"], rows["no"], rows["low"], rows["high"], strict=True)
        text = "".join(part[low - no * chunk : high - no * chunk] for part, no, low, high in shares)
        first = rows.iloc[0]
        return pd.DataFrame({"__key": [first["__key"]], "piece": [first["piece"]], "ids": [codec.coder().encode(text)]})

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("piece")
        return pd.DataFrame({"__key": [rows["__key"].iloc[0]], "ids": [b"".join(rows["ids"])]})

    found = chunks.mapInArrow(pre_tokenise, "__key string, no int, length long, head array<long>, tail array<long>")
    parts = found.groupBy("__key").applyInPandas(meet, "__key string, no int, piece int, low long, high long")
    pieces = chunks.join(parts, ["__key", "no"]).groupBy("__key", "piece")
    encoded = pieces.applyInPandas(encode, "__key string, piece int, ids binary")
    return encoded.groupBy("__key").applyInPandas(gather, "__key string, ids binary")


@names_apart
def encode(
    df: DataFrame,
    codec: Codec,
    text: str = "text",
    chunk: int = CHUNK_CHARS,
    overlap: int = OVERLAP_CHARS,
    digests: bool = False,
) -> DataFrame:
    """Add ``ids``, the token ids as packed little-endian 32-bit integers, to each row.

    With ``digests``, add instead what an audit needs of them: n_tokens,
    ids_sha256 (of the decimal ids joined by spaces) and decoded_sha256 (of the
    bytes they decode to). A null or empty text has no ids. Repeated rows stay;
    columns with the added names are replaced.
    """
    added = DIGESTS if digests else IDS
    own = df.drop(*added)
    columns = own.columns
    fields = own.select(*[F.col(c) for c in columns]).schema
    for name, kind in added.items():
        fields = fields.add(name, kind)

    def with_ids(batch: pa.RecordBatch, ids: Iterator[bytes], coder: RankCoder) -> pa.RecordBatch:
        rows = [_digests(x, coder) if digests else (x,) for x in ids]
        found = [[row[i] for row in rows] for i in range(len(added))]
        kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
        arrays = [pa.array(x, kinds[kind]) for x, kind in zip(found, added.values(), strict=True)]
        carried = [batch.column(i) for i in range(len(columns))]
        return pa.RecordBatch.from_arrays([*carried, *arrays], names=[*columns, *added])

    def encode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, at = codec.coder(), columns.index(text)
        for batch in batches:
            yield with_ids(batch, (coder.encode(x.as_py() or "") for x in batch.column(at)), coder)

    def carry_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec.coder()
        for batch in batches:
            yield with_ids(batch, (x.as_py() for x in batch.column(len(columns))), coder)

    long = F.coalesce(F.char_length(text) > chunk, F.lit(False))
    short_rows = own.filter(~long).mapInArrow(encode_rows, fields)
    long_rows = own.filter(long).withColumn("__key", F.sha2(F.col(text), 256))
    texts = long_rows.select("__key", F.col(text).alias("_text")).dropDuplicates(["__key"])
    long_ids = _encode_long(texts, codec, chunk, overlap).withColumnRenamed("ids", "_ids")
    joined = long_rows.join(long_ids, "__key").select(*columns, "_ids")
    return short_rows.unionByName(joined.mapInArrow(carry_ids, fields))


IDS = {"ids": "binary"}
DIGESTS = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}


def _digests(ids: bytes, coder: RankCoder) -> tuple[int, str, str]:
    numbers = np.frombuffer(ids, dtype=np.uint32).tolist()
    decimal = hashlib.sha256(" ".join(map(str, numbers)).encode()).hexdigest()
    return len(numbers), decimal, hashlib.sha256(coder.decode(ids)).hexdigest()


@names_apart
def decode(df: DataFrame, codec: Codec) -> DataFrame:
    """Add ``decoded``, the concatenated bytes of the tokens in ``ids`` (null: none)."""
    own = df.drop("decoded")
    columns = own.columns
    fields = own.select(*[F.col(c) for c in columns]).schema.add("decoded", "binary")

    def decode_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec.coder()
        for batch in batches:
            out = [coder.decode(x.as_py() or b"") for x in batch.column(columns.index("ids"))]
            arrays = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(out, pa.binary())], names=[*columns, "decoded"])

    return own.mapInArrow(decode_rows, fields)
