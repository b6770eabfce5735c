import hashlib
import io
import random
import struct

import pytest
import zstandard

from delaystar.llm import warc
from delaystar.session import scratch_path
from tests.llm.helpers import duckdb_rows

PAGE = "page_id bigint, url string, html string"


def _record(i, payload, refers=None):
    return warc.encode_record(i, f"http://a.example/{i}", payload, hashlib.sha256(payload).hexdigest(), refers)


def _archive(n=200):
    records = [_record(i, f"<p>common words of page {i}, again and again {i * 17}</p>".encode() * 3) for i in range(n)]
    out = io.BytesIO()
    assert warc.write_archive(out, iter(records))[0] == n
    return records, out.getvalue()


def test_archive_has_a_dictionary_frame_and_one_frame_per_record():
    records, data = _archive()
    assert struct.unpack("<I", data[:4])[0] == warc.DICTIONARY_MAGIC
    assert list(warc.frames(io.BytesIO(data))) == records
    plain = sum(len(warc._compressor(b"").compress(r)) for r in records)
    assert len(data) < plain  # the dictionary pays


def test_reader_takes_archives_without_and_with_a_compressed_dictionary():
    records, data = _archive()
    length = struct.unpack("<I", data[4:8])[0]
    packed = zstandard.ZstdCompressor().compress(data[8 : 8 + length])
    again = struct.pack("<II", warc.DICTIONARY_MAGIC, len(packed)) + packed + data[8 + length :]
    assert list(warc.frames(io.BytesIO(again))) == records
    bare = b"".join(warc._compressor(b"").compress(r) for r in records[:3])
    assert list(warc.frames(io.BytesIO(bare))) == records[:3]
    assert list(warc.frames(io.BytesIO(b""))) == []


@pytest.mark.parametrize("cut", [5, 20, -1, -9])
def test_cut_archives_are_refused(cut):
    _, data = _archive()
    with pytest.raises(ValueError):
        list(warc.read_archive(io.BytesIO(data[:cut])))


@pytest.mark.parametrize(
    "damage",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/9.1"),
        lambda r: r.replace(b"WARC-Date", b"X-Date"),
        lambda r: r + b"x",
        lambda r: r + r,
        lambda r: r.replace(b"payload text", b"another text"),
        lambda r: r.replace(b"Content-Type: text", b"Content-Length: 3\r\nContent-Type: text"),
        lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: other"),
        lambda r: r.replace(b"\r\n\r\n", b"\r\n", 1),
    ],
)
def test_damaged_records_are_refused(damage):
    record = _record(1, b"payload text")
    assert warc.decode_record(record)[0] == 1
    with pytest.raises(ValueError):
        warc.decode_record(damage(record))


def test_revisit_keeps_length_and_digest_of_the_full_payload():
    payload = b"x" * 500
    row = warc.decode_record(_record(9, payload, 3))
    assert row[0] == 9 and row[2:] == ("revisit", 3, None, 500, hashlib.sha256(payload).hexdigest())


def test_target_uri_stays_one_header_line():
    row = warc.decode_record(warc.encode_record(1, "http://a/b c\r\nX: y", b"", hashlib.sha256(b"").hexdigest(), None))
    assert row[1] == "http://a/b%20c%0D%0AX:%20y"


def test_pages_with_nulls_ties_repeats_and_clashing_columns(spark):
    big, small = "é" * 80, "s" * 99
    rows = [(5, "u", big), (3, None, big), (3, "u", big), (8, "u", big), (None, "u", big), (1, "u", small), (2, "u", small),
            (6, "u", None), (7, "u", ""), (10, "u", "w" * 2_000_000), (11, "u", "w" * 2_000_000), (None, None, None)]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], PAGE + ", payload string, refers_to bigint")
    got = sorted(map(tuple, warc.archive_pages(pages).collect()), key=repr)
    names, want = duckdb_rows(warc.oracle(), pages=pages.select("page_id", "url", "html").toPandas().astype({"page_id": "Int64"}))
    order = [names.index(c) for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")]
    assert got == sorted((tuple(r[i] for i in order) for r in want), key=repr)
    assert sum(r[3] == "revisit" for r in got) == 4  # 5, 8 and null refer to 3; 11 refers to 10


def test_an_archive_that_is_full_leaves_the_rest_to_the_next():
    records, _ = _archive(2000)
    left, sizes = iter(records), []
    again = []
    while True:
        out = io.BytesIO()
        n, size = warc.write_archive(out, left, 20_000)
        if not n:
            break
        sizes.append(size)
        again += list(warc.frames(io.BytesIO(out.getvalue())))
    assert again == records
    assert len(sizes) > 3


def test_pages_of_one_partition_over_several_archives(spark, monkeypatch):
    """Nothing is lost where archives roll over: thousands of pages, and 90 of one MB, in one partition each."""
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 64 << 10)
    rnd = random.Random(4)
    html = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz <>/", k=rnd.randint(90, 400))) for _ in range(3000)]
    pages = spark.createDataFrame([(i, f"u{i}", html[i // 2 if i % 3 else i]) for i in range(3000)], PAGE).coalesce(1)
    manifest = warc.write_archives(warc.mark_revisits(pages).coalesce(1), scratch_path(spark, "warc-test")).collect()
    assert len(manifest) > 5 and sum(r["records"] for r in manifest) == 3000
    got = sorted(map(tuple, warc.archive_pages(pages).collect()))
    names, want = duckdb_rows(warc.oracle(), pages=pages.toPandas())
    order = [names.index(c) for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")]
    assert got == sorted(tuple(r[i] for i in order) for r in want)
    large = spark.range(90).selectExpr("id AS page_id", "'u' AS url", "repeat(md5(string(id)), 32768) AS html").coalesce(1)
    assert sorted(r["page_id"] for r in warc.archive_pages(large).collect()) == list(range(90))


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], PAGE)).count() == 0
