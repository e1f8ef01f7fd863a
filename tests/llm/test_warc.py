import gzip
import hashlib
import io
import zipfile

import pyarrow as pa
import pytest

from touchline.llm import warc
from touchline.sources.scratch import scratch_dir

BIG = "<p>" + "shared passage " * 100 + "</p>"


def brute(rows):
    """Expected (page_id, payload_bytes, digest, type, refers_to) per row; equal ids: the later row wins."""
    out, heads = [], {}
    for i, (page_id, _, html) in enumerate(rows):
        payload = (html or "").encode()
        if len(payload) >= warc.REVISIT_BYTES:
            key = payload
            best = heads.get(key)
            rank = (page_id is not None, page_id or 0, i)
            if best is None or rank > best[0]:
                heads[key] = (rank, page_id, i)
    for i, (page_id, _, html) in enumerate(rows):
        payload = (html or "").encode()
        head = heads.get(payload)
        revisit = head is not None and head[2] != i
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", head[1] if revisit else None))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/x", BIG), (9, "http://b/y", BIG), (5, None, BIG), (None, "http://n/", BIG),
    (2, "http://a/\r\nX-Injected: 1", "short"), (3, None, None), (4, "http://é/ü", ""), (6, "http://a/x", "short"),
    (7, "u", "é" * 600), (8, "u", "é" * 600), (10, "long", "x" * 300_000), (11, "long", "x" * 300_000 + "y"),
]


def test_round_trip_equals_brute_force(spark):
    # Repeated rows and clashing names: the same id twice with one payload, and columns called like outputs.
    rows = ROWS + [(9, "http://b/y", BIG)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, record_type string, refers_to string")
    got = warc.archive_round_trip(pages.repartition(3), scratch_dir(spark, "warc-test"))
    got = sorted((tuple(r[:5]) for r in got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)
    want = brute(rows)
    # The two rows of id 9 tie; exactly one of them is the response.
    assert [r for r in got if r[0] != 9] == [r for r in want if r[0] != 9]
    nines = sorted(r[3:] for r in got if r[0] == 9)
    assert nines == [("response", None), ("revisit", 9)]


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_round_trip(pages, scratch_dir(spark, "warc-empty")).count() == 0


def test_archives_are_zip_files_with_an_index(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1)
    written = warc.write_archives(warc.decide(pages), scratch_dir(spark, "warc-zip")).collect()
    assert len(written) == 1 and written[0].records == len(ROWS)
    with zipfile.ZipFile(written[0].path) as archive:
        assert archive.namelist() == [warc.WARC_MEMBER, warc.INDEX_MEMBER]
        body = gzip.decompress(archive.read(warc.WARC_MEMBER))
        index = archive.read(warc.INDEX_MEMBER).decode().split()
    assert body.count(b"WARC/1.1\r\n") >= len(ROWS) and len(index) == 2 * len(ROWS)
    assert b"\r\nX-Injected" not in body and b"%0D%0AX-Injected" in body


@pytest.mark.parametrize("zip64", [False, True])
def test_reader_parses_other_writers(monkeypatch, zip64):
    if zip64:  # make the standard writer emit ZIP64 end records and fields
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED) as archive:
        archive.writestr("a.txt", b"hello world")
        archive.writestr("b/c.bin", bytes(range(256)) * 3)
    data = buffer.getvalue()
    members = warc.zip_members(pa.BufferReader(data))
    at, size = members["b/c.bin"]
    assert data[at : at + size] == bytes(range(256)) * 3
    at, size = members["a.txt"]
    assert data[at : at + size] == b"hello world"


def test_record_parse_round_trip():
    payload = "<html>ü</html>".encode()
    digest = hashlib.sha1(payload).hexdigest()
    record = warc.warc_record("response", "id", "2020-01-01T00:00:00Z", 3, "http://x", payload, len(payload), digest)
    assert warc.parse_record(record) == {"page_id": 3, "record_type": "response", "payload_bytes": len(payload), "payload_digest": digest, "refers_to": None}
    record = warc.warc_record("revisit", "id", "2020-01-01T00:00:00Z", None, None, None, 5000, digest, 7, "http://y")
    assert warc.parse_record(record) == {"page_id": None, "record_type": "revisit", "payload_bytes": 5000, "payload_digest": digest, "refers_to": 7}
