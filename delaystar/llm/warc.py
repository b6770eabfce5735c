"""Zstandard WARC archives: write records one frame each, read them back frame by frame.

Archive layout (the public ``.warc.zst`` convention): a leading skippable frame
(magic 0x184D2A5D) holds the dictionary, then every record is one Zstandard frame
compressed with it.  The reader loads the dictionary from the skippable frame,
decodes one frame at a time from a buffered stream (memory is bounded by one
record, not by the archive), and checks version line, mandatory headers, block
length, record trailer, HTTP length and payload digest.  A frame must hold exactly
one record.

Writing is a map over the rows of a partition.  A task writes each archive under a
fresh name in the shared folder and reports (path, records, bytes) as rows; only
archives in the stored manifest are read, so files of failed or repeated tasks are
never seen.  Archives are rolled at ``ARCHIVE_BYTES`` so that one archive is one
bounded read task; a task fails if it wrote another number of records than it was given.

Defined results: a null html is an empty payload; a null url leaves out the target
URI; a null page_id is written and read back as null and sorts after all others;
of equal payloads every row that carries the smallest page_id is a response (so
repeated rows of one page are responses, not revisits of themselves); an empty
table gives no archive and no rows; other columns of the input are dropped.
"""

from __future__ import annotations

import hashlib
import itertools
import posixpath
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaystar.llm.tables import arrow_schema, stored, to_batch
from delaystar.session import scratch_path

#: FIXED VALUES of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1\r\n"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2024-01-01T00:00:00Z"
MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 32 << 20
MAX_READ_TASKS = 100_000
DICTIONARY_BYTES = 16 << 10
SAMPLE_BYTES = 256 << 10
LEVEL = 3
READ_BYTES = 64 << 10

MANIFEST_SCHEMA = "path string, records bigint, bytes bigint"
RECORD_SCHEMA = (
    "page_id bigint, url string, record_type string, refers_to bigint, payload binary, "
    "payload_bytes bigint, payload_digest string"
)


def mark_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, payload_digest and refers_to (null for responses).

    Equal payloads are found by digest: partial counts per task, then a join of the
    repeated digests only, so a payload that a third of all pages share costs one
    row per task before the shuffle and its side of the join can be split.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    hashed = pages.select("page_id", "url", payload.alias("payload")).withColumn("payload_digest", F.sha2("payload", 256))
    repeated = (
        hashed.where(F.octet_length("payload") >= min_bytes)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .drop("n")
    )
    joined = hashed.join(repeated, "payload_digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(again, F.col("first_id")).alias("refers_to"))


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    value = record.removeprefix("<urn:x-page:").removesuffix(">")
    return None if value == "null" else int(value)


def target_uri(url: str) -> str:
    """The URL with white space and controls percent-coded, so that it stays one header line."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id)),
               ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if url is not None:
        headers.append(("WARC-Target-URI", target_uri(url)))
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block += payload
    else:
        headers += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", REVISIT_PROFILE), ("WARC-Truncated", "length")]
    headers += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers).encode()
    return b"".join((VERSION, head, b"\r\n", block, b"\r\n\r\n"))


def _headers(text: bytes, what: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in text.decode("utf-8").split("\r\n"):
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"{what}: malformed header line {line[:80]!r}")
        if found.setdefault(name.lower(), value.strip()) != value.strip():
            raise ValueError(f"{what}: header {name} is given twice")
    return found


def _length(headers: dict[str, str], what: str) -> int:
    value = headers.get("content-length", "")
    if not (value.isascii() and value.isdigit()):
        raise ValueError(f"{what}: Content-Length is {value!r}")
    return int(value)


def decode_record(data: bytes) -> tuple:
    """One row of ``RECORD_SCHEMA`` from one decoded frame; ValueError names what is wrong."""
    if not data.startswith(VERSION):
        raise ValueError(f"no {VERSION!r} at the start of a record")
    head, gap, rest = data[len(VERSION) :].partition(b"\r\n\r\n")
    if not gap:
        raise ValueError("record headers do not end")
    headers = _headers(head, "record")
    if missing := [k for k in MANDATORY if not headers.get(k)]:
        raise ValueError(f"record without {', '.join(missing)}")
    n, kind = _length(headers, "record"), headers["warc-type"]
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError(f"record block has {len(rest) - 4} bytes, its header says {n}")
    if kind not in ("response", "revisit"):
        raise ValueError(f"record type {kind!r}")
    http, gap, payload = rest[:n].partition(b"\r\n\r\n")
    status, _, lines = http.partition(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise ValueError("no HTTP message in the block")
    full = _length(_headers(lines, "HTTP"), "HTTP")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "revisit":
        if payload or not headers.get("warc-refers-to") or not headers.get("warc-profile"):
            raise ValueError("revisit with a payload, or without WARC-Refers-To or WARC-Profile")
        payload = None
    elif len(payload) != full or hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("payload differs from its length or digest")
    refers = page_of(headers["warc-refers-to"]) if kind == "revisit" else None
    return page_of(headers["warc-record-id"]), headers.get("warc-target-uri"), kind, refers, payload, full, digest


def train_dictionary(samples: list[bytes]) -> bytes:
    """Dictionary of the samples, or nothing where they are too few or too alike to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 16 else b""
    except zstandard.ZstdError:
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=True, write_checksum=True)


def write_archive(out: BinaryIO, records: Iterator[bytes], limit: int = ARCHIVE_BYTES) -> tuple[int, int]:
    """Write records until about ``limit`` compressed bytes; returns (records, bytes).  The rest stays in ``records``.

    The first ``SAMPLE_BYTES`` of records train the dictionary of the archive.
    """
    first: list[bytes] = []
    held = 0
    while held < SAMPLE_BYTES and (record := next(records, None)) is not None:
        first.append(record)
        held += len(record)
    dictionary = train_dictionary(first)
    n = size = 0
    if dictionary:
        size += out.write(struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary)
    packer = _compressor(dictionary)
    for record in first:
        size += out.write(packer.compress(record))
        n += 1
    while size < limit and (record := next(records, None)) is not None:
        size += out.write(packer.compress(record))
        n += 1
    return n, size


def read_dictionary(source: BinaryIO) -> tuple[zstandard.ZstdCompressionDict | None, bytes]:
    """Dictionary of the leading skippable frame, and the bytes read after it."""
    head = source.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICTIONARY_MAGIC:
        return None, head
    length = struct.unpack("<I", head[4:])[0]
    data = source.read(length)
    if len(data) != length:
        raise ValueError(f"dictionary frame of {length} bytes ends after {len(data)}")
    if data[:4] == struct.pack("<I", FRAME_MAGIC):  # the convention also allows a compressed dictionary
        data = zstandard.ZstdDecompressor().decompressobj().decompress(data)
    return zstandard.ZstdCompressionDict(data), b""


def frames(source: BinaryIO) -> Iterator[bytes]:
    """Decoded frames of an archive, one at a time; ValueError on a broken or cut frame."""
    dictionary, data = read_dictionary(source)
    unpacker = zstandard.ZstdDecompressor(dict_data=dictionary)
    while data or (data := source.read(READ_BYTES)):
        frame, parts = unpacker.decompressobj(), []
        try:
            while True:
                parts.append(frame.decompress(data))
                if frame.eof:
                    data = frame.unused_data
                    break
                data = source.read(READ_BYTES)
                if not data:
                    raise ValueError("the last frame is cut off")
        except zstandard.ZstdError as e:
            raise ValueError(f"broken frame: {e}") from e
        yield b"".join(parts)


def read_archive(source: BinaryIO) -> Iterator[tuple]:
    for data in frames(source):
        yield decode_record(data)


def _open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def write_archives(marked: DataFrame, folder: str) -> DataFrame:
    """Write the rows of ``mark_revisits`` as archives under ``folder``; the manifest, not yet run."""
    schema = arrow_schema(MANIFEST_SCHEMA)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _open_folder(folder)
        store.create_dir(root, recursive=True)
        seen = written = 0

        def records() -> Iterator[bytes]:
            nonlocal seen
            for batch in batches:
                seen += batch.num_rows
                for i in range(batch.num_rows):
                    page_id, url, payload, digest, refers = (batch.column(k)[i].as_py() for k in range(5))
                    yield encode_record(page_id, url, payload, digest, refers)

        left = records()
        while (head := next(left, None)) is not None:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with store.open_output_stream(posixpath.join(root, name), compression=None) as out:
                # chain() leaves ``left`` open when an archive ends before it does; a generator around it would close it
                n, size = write_archive(out, itertools.chain((head,), left), ARCHIVE_BYTES)
            written += n
            yield to_batch({"path": [f"{folder}/{name}"], "records": [n], "bytes": [size]}, schema)
        seen += sum(batch.num_rows for batch in batches)
        if written != seen:
            raise ValueError(f"{written} of {seen} records were written")

    columns = ("page_id", "url", "payload", "payload_digest", "refers_to")
    return marked.select(*columns).mapInArrow(write, MANIFEST_SCHEMA)


def read_archives(manifest: DataFrame) -> DataFrame:
    """Records of every archive that the manifest names, about one read task per archive.

    The number of tasks is given outright: the paths are few bytes, and a partition
    size chosen by bytes would put them all in one task.
    """
    tasks = max(1, min(manifest.count(), MAX_READ_TASKS))
    schema = arrow_schema(RECORD_SCHEMA)
    names = [f.name for f in schema]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, name = _open_folder(path)
                rows, held, seen = [], 0, 0
                with store.open_input_stream(name, compression=None) as source:
                    for row in read_archive(source):
                        rows.append(row)
                        seen += 1
                        held += len(row[4] or b"")
                        if held > 8 << 20 or len(rows) >= 5000:
                            yield to_batch(dict(zip(names, zip(*rows, strict=True), strict=True)), schema)
                            rows, held = [], 0
                if rows:
                    yield to_batch(dict(zip(names, zip(*rows, strict=True), strict=True)), schema)
                if seen != n:
                    raise ValueError(f"{path} holds {seen} records, the manifest says {n}")

    return manifest.select("path", "records").repartition(tasks, "path").mapInArrow(read, RECORD_SCHEMA)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages as archives in the shared folder, then read every record back."""
    folder = scratch_path(pages.sparkSession, "warc")
    manifest = stored(write_archives(mark_revisits(pages), folder), "warc-manifest")
    return read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def oracle() -> str:
    return f"""
WITH hashed AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM hashed)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND first_id IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {MIN_REVISIT_BYTES} AND first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM firsts"""
