"""WARC archives compressed with Zstandard and a shared dictionary.

An archive starts with a skippable frame that holds the dictionary, then has one
frame for each record. Of records with equal payloads only one stores it; the
others are revisit records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import file_folder, row_key, write_file
from tidemark.sources.shared import materialize

# Fixed values of the formats.
DICTIONARY_MAGIC = (0x184D2A5D).to_bytes(4, "little")
FRAME_MAGIC = (0xFD2FB528).to_bytes(4, "little")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = "WARC/1.1"
REQUIRED = ["WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"]

RECORD_ID = "urn:x-page:"
FILE_BYTES = 16 << 20
DICTIONARY_BYTES = 64 << 10
# The dictionary is trained on so many records at most, and so much of each.
SAMPLE_RECORDS = 1000
SAMPLE_CHARS = 8192
_FEED = 8192

RECORD_FIELDS = (
    "archive string, record_id string, record_type string, target_uri string, payload_bytes long, "
    "payload_digest string, refers_to_id string, payload binary, error string"
)
_RECORD = pa.schema(
    [(n, pa.int64() if n == "payload_bytes" else pa.binary() if n == "payload" else pa.string())
     for n in (x.split()[0] for x in RECORD_FIELDS.split(", "))]
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the samples; of samples too few to train on, their own text."""
    samples = [x for x in samples if x]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record: HTTP headers and payload, for a revisit the headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{RECORD_ID}{'null' if page_id is None else page_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "WARC-Block-Digest": f"sha1:{payload_digest(block)}",
        "WARC-Profile": None if refers_to is None else REVISIT_PROFILE,
        "WARC-Refers-To": None if refers_to is None else f"<{RECORD_ID}{refers_to}>",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _headers(lines: list[bytes]) -> dict[str, str]:
    pairs = (x.decode("utf-8", "replace").partition(":") for x in lines)
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


def parse_record(data: bytes) -> dict:
    """The record's fields; ``error`` says what is wrong with it, null if nothing is."""
    row = dict.fromkeys(_RECORD.names)
    head, blank, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    fields = _headers(lines)
    row["record_type"] = fields.get("warc-type")
    row["record_id"] = (fields.get("warc-record-id") or "").strip("<>") or None
    row["target_uri"] = fields.get("warc-target-uri")
    row["refers_to_id"] = (fields.get("warc-refers-to") or "").strip("<>") or None
    row["payload_digest"] = (fields.get("warc-payload-digest") or "").removeprefix("sha1:") or None
    if not blank or not re.fullmatch(rb"WARC/1\.[01]", version):
        return row | {"error": "no WARC header"}
    if missing := [x for x in REQUIRED if not fields.get(x.lower())]:
        return row | {"error": f"no {missing[0]}"}
    length = fields["content-length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        return row | {"error": "the block's length is not Content-Length"}
    block = rest[:-4]
    if (own := fields.get("warc-block-digest")) and own != f"sha1:{payload_digest(block)}":
        return row | {"error": "the block differs from its digest"}
    http, blank, payload = block.partition(b"\r\n\r\n")
    size = _headers(http.split(b"\r\n")[1:]).get("content-length", "")
    if not blank or not size.isdigit():
        return row | {"error": "no HTTP header with the payload's length"}
    row["payload_bytes"] = int(size)
    if row["record_type"] == "revisit":
        wrong = "a revisit with a payload" if payload else None if row["refers_to_id"] else "a revisit of nothing"
        return row | {"error": wrong}
    if len(payload) != int(size):
        return row | {"error": "the payload's length is not that of the HTTP header"}
    if row["payload_digest"] != payload_digest(payload):
        return row | {"error": "the payload differs from its digest"}
    return row | {"payload": payload}


def frames(data: bytes) -> Iterator[bytes]:
    """The content of each frame after the dictionary; raises ValueError where the archive is broken."""
    view = memoryview(data)
    dictionary, at = None, 0
    if data[:4] == DICTIONARY_MAGIC:
        size = int.from_bytes(data[4:8], "little")
        stored, at = data[8 : 8 + size], 8 + size
        if len(stored) != size:
            raise ValueError("the dictionary is cut off")
        if stored[:4] == FRAME_MAGIC:  # a dictionary may be compressed itself
            stored = zstandard.ZstdDecompressor().decompressobj().decompress(stored)
        dictionary = zstandard.ZstdCompressionDict(stored)
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        if data[at : at + 4] != FRAME_MAGIC:
            raise ValueError(f"no frame at byte {at}")
        frame, parts = reader.decompressobj(), []
        while not frame.eof and at < len(data):
            fed = view[at : at + _FEED]
            try:
                parts.append(frame.decompress(fed))
            except zstandard.ZstdError as error:
                raise ValueError(f"a broken frame before byte {at + len(fed)}: {error}") from error
            at += len(fed) - len(frame.unused_data)
        if not frame.eof:
            raise ValueError("the last frame is cut off")
        yield b"".join(parts)


def first_copies(df: DataFrame, page_id: str, payload: str, min_bytes: int) -> DataFrame:
    """``__key`` of each page whose payload another page with a smaller id has, and that page's id."""
    digest = F.sha1(F.col(payload).cast("binary"))
    large = df.filter(F.octet_length(payload) >= min_bytes)
    narrow = large.select("__key", F.col(page_id).alias("_id"), digest.alias("_digest"))
    groups = narrow.groupBy("_digest").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
    later = narrow.join(groups.filter("_first < _last").select("_digest", "_first"), "_digest")
    return later.filter("_id > _first").select("__key", "_first").distinct()


def write_archives(
    df: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    file_bytes: int = FILE_BYTES,
) -> tuple[str, DataFrame]:
    """Write a record for each row; the folder, and the list of the archives that count.

    A null html is an empty payload. Of equal payloads of at least ``min_bytes``
    bytes the one with the smallest id is the response and others revisit it;
    rows that share that id, and rows without an id, are responses too. A null
    url leaves the target out. An empty table makes no archive.
    """
    spark = df.sparkSession
    own = df.select(F.col(page_id).alias("_id"), F.col(url).alias("_url"), F.coalesce(html, F.lit("")).alias("_payload"))
    keyed = own.withColumn("__key", row_key("_id", "_payload"))
    chosen = keyed.select("__key").orderBy("__key").limit(SAMPLE_RECORDS).distinct()
    some = keyed.join(F.broadcast(chosen), "__key", "left_semi").select(F.substring("_payload", 1, SAMPLE_CHARS))
    samples = [x[0].encode() for x in some.limit(SAMPLE_RECORDS).collect()]
    dictionary = spark.sparkContext.broadcast(train_dictionary(samples))
    folder = file_folder(spark, "warc")
    rows = keyed.join(first_copies(keyed, "_id", "_payload", min_bytes), "__key", "left")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), itertools.count()
        head = [DICTIONARY_MAGIC, len(dictionary.value).to_bytes(4, "little"), dictionary.value] if dictionary.value else []
        shared = zstandard.ZstdCompressionDict(dictionary.value) if dictionary.value else None
        writer = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True)
        out: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            name = f"{part:08d}-{next(serial):06d}-{uuid.uuid4().hex}.warc.zst"
            write_file(f"{folder}/{name}", b"".join([*head, *out]))
            listed = pa.RecordBatch.from_pydict({"name": [name], "records": [len(out)]}, schema=_LISTED)
            out.clear()
            return listed

        for batch in batches:
            columns = [batch.column(i) for i in range(3)]
            for row in range(batch.num_rows):
                key, target, first = columns[0][row].as_py(), columns[1][row].as_py(), batch.column(3)[row].as_py()
                payload = columns[2][row].as_buffer().to_pybytes()
                out.append(writer.compress(record(key, target, payload, first, date)))
                size += len(out[-1])
                if size >= file_bytes:
                    yield flush()
                    size = 0
        if out:
            yield flush()

    written = rows.select("_id", "_url", F.col("_payload").cast("binary"), "_first").mapInArrow(write, "name string, records long")
    return folder, materialize(written, "warc-files")


_LISTED = pa.schema([("name", pa.string()), ("records", pa.int64())])


def read_archives(spark: SparkSession, folder: str, listed: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """The records of a folder's archives, those of ``listed`` only if given.

    A record that does not hold what its headers say has an ``error``, and so has
    an archive that breaks off (a row without other fields). Without ``payloads``
    that column is null.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                name, rows, size = path.rpartition("/")[2], [], 0
                for row in _records(content.as_buffer().to_pybytes()):
                    rows.append(row | {"archive": name} | ({} if payloads else {"payload": None}))
                    size += len(rows[-1]["payload"] or b"")
                    if len(rows) >= 1000 or size > FILE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    stored = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    records = stored.select("path", "content").mapInArrow(read, RECORD_FIELDS)
    if listed is None:
        return records
    return records.join(listed.select(F.col("name").alias("archive")), "archive", "left_semi")


def _records(data: bytes) -> Iterator[dict]:
    try:
        for frame in frames(data):
            yield parse_record(frame)
    except ValueError as error:
        yield dict.fromkeys(_RECORD.names) | {"error": str(error)}


def page_number(id_column: str):
    """The page's id in a record id."""
    return F.regexp_extract(id_column, f"^{RECORD_ID}(-?[0-9]+)$", 1).try_cast("long")
