"""Web pages as WARC records in ZIP archives, and a reader that range-reads them without extraction.

Writing. Each task writes its rows as archives below a shared folder: a ZIP
file with two stored members, ``records.warc.gz`` with one WARC/1.1 record per
row, each record its own gzip member (as in ``.warc.gz`` files), and
``records.cdx`` with one line ``offset length`` per record (offsets inside the
WARC member). The ZIP layer compresses nothing, so a record is read by its
range alone and decompressed by itself. Archives always carry ZIP64 fields and the
ZIP64 end records, so they may outgrow 4 GiB and 65,535 members. The names of
the archives a job wrote come back as rows; only they are read, so files of
failed task attempts never count.

Reading. From the end of an archive: the end-of-central-directory record, the
ZIP64 locator and record, then the central directory; each member's local
header gives where its bytes start. The index member is read whole (bounded:
one short line per record), then each record is read by its byte range alone.

Duplicates. Among rows whose payloads are equal and at least
``REVISIT_BYTES`` long, the one with the largest page_id is a ``response``
record; the others are ``revisit`` records that hold only the HTTP header,
the payload digest and the page_id they refer to. Shorter payloads are all
responses. The choice is made in Spark: one aggregate per digest (combined
before the shuffle) and a join on the digest, which adaptive execution splits
when one payload has very many copies.
"""

from __future__ import annotations

import base64
import binascii
import gzip
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.sources.scratch import staged

# Values fixed by the contract of the query.
REVISIT_BYTES = 1000
RESPONSE, REVISIT = "response", "revisit"
#: A task starts a new archive once the current one holds this many bytes.
ARCHIVE_BYTES = 256 << 20
#: Rows per Arrow batch the reader hands back.
BATCH_ROWS = 2048
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_MEMBER, INDEX_MEMBER = "records.warc.gz", "records.cdx"
GZIP_LEVEL = 6

_LOCAL, _DESCRIPTOR, _CENTRAL = 0x04034B50, 0x08074B50, 0x02014B50
_END, _END64, _LOCATOR64 = 0x06054B50, 0x06064B50, 0x07064B50
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_ZIP64_EXTRA = 0x0001


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class ZipWriter:
    """Stored members written one after the other to a stream, with ZIP64 fields throughout."""

    def __init__(self, stream) -> None:
        self._out, self._at, self._members = stream, 0, []
        self._open: tuple[str, int] | None = None
        self._crc = self._size = 0

    def _put(self, data: bytes) -> None:
        self._out.write(data)
        self._at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        extra = struct.pack("<HHQQ", _ZIP64_EXTRA, 16, 0, 0)
        # Flag 8: sizes and crc follow the data in a descriptor.
        self._put(struct.pack("<IHHHHHIIIHH", _LOCAL, 45, 8, 0, 0, 0x21, 0, _FULL32, _FULL32, len(raw), len(extra)) + raw + extra)
        self._open, self._crc, self._size = (name, self._at - 30 - len(raw) - len(extra)), 0, 0

    def write(self, data: bytes) -> int:
        """Append to the open member; returns the offset inside it where ``data`` starts."""
        start = self._size
        self._put(data)
        self._crc, self._size = zlib.crc32(data, self._crc), self._size + len(data)
        return start

    def end(self) -> None:
        name, header = self._open
        self._put(struct.pack("<IIQQ", _DESCRIPTOR, self._crc, self._size, self._size))
        self._members.append((name, header, self._crc, self._size))
        self._open = None

    @property
    def size(self) -> int:
        return self._at

    def close(self) -> None:
        start = self._at
        for name, header, crc, size in self._members:
            raw = name.encode()
            extra = struct.pack("<HHQQQ", _ZIP64_EXTRA, 24, size, size, header)
            self._put(
                struct.pack("<IHHHHHHIIIHHHHHII", _CENTRAL, 45, 45, 8, 0, 0, 0x21, crc, _FULL32, _FULL32, len(raw), len(extra), 0, 0, 0, 0, _FULL32)
                + raw + extra
            )
        central, count, end64 = self._at - start, len(self._members), self._at
        self._put(struct.pack("<IQHHIIQQQQ", _END64, 44, 45, 45, 0, 0, count, count, central, start))
        self._put(struct.pack("<IIQI", _LOCATOR64, 0, end64, 1))
        self._put(struct.pack("<IHHHHIIH", _END, 0, 0, _FULL16, _FULL16, _FULL32, _FULL32, 0))
        self._out.close()


def zip_members(source) -> dict[str, tuple[int, int]]:
    """Stored members of an open random-access file: name -> (offset of the data, size).

    Reads the end records, the ZIP64 ones where present, the central directory
    and the local headers; nothing else. Compressed members are refused.
    """
    length = source.size()
    tail_at = max(0, length - (22 + 65_535))
    tail = source.read_at(length - tail_at, tail_at)
    end = tail.rfind(struct.pack("<I", _END))
    if end < 0:
        raise ValueError("not a ZIP archive: no end of central directory")
    _, _, _, _, count, central_size, central_at, _ = struct.unpack_from("<IHHHHIIH", tail, end)
    locator = end - 20
    if locator >= 0 and struct.unpack_from("<I", tail, locator)[0] == _LOCATOR64:
        (end64_at,) = struct.unpack_from("<Q", tail, locator + 8)
        record = source.read_at(56, end64_at)
        if struct.unpack_from("<I", record)[0] != _END64:
            raise ValueError("ZIP64 locator points at no ZIP64 end record")
        count, _, central_size, central_at = struct.unpack_from("<QQQQ", record, 24)
    directory = source.read_at(central_size, central_at)
    members, at = {}, 0
    for _ in range(count):
        fields = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, at)
        if fields[0] != _CENTRAL:
            raise ValueError("broken central directory")
        method, compressed, size, name_len, extra_len, comment_len, header_at = fields[4], fields[8], fields[9], fields[10], fields[11], fields[12], fields[16]
        name = directory[at + 46 : at + 46 + name_len].decode()
        extra = directory[at + 46 + name_len : at + 46 + name_len + extra_len]
        wide = _zip64_values(extra)
        if size == _FULL32:
            size = wide.pop(0)
        if compressed == _FULL32:
            wide.pop(0)
        if header_at == _FULL32:
            header_at = wide.pop(0)
        if method != 0:
            raise ValueError(f"member {name} is compressed; only stored members are read in place")
        local = source.read_at(30, header_at)
        if struct.unpack_from("<I", local)[0] != _LOCAL:
            raise ValueError(f"no local header for {name}")
        skip_name, skip_extra = struct.unpack_from("<HH", local, 26)
        members[name] = (header_at + 30 + skip_name + skip_extra, size)
        at += 46 + name_len + extra_len + comment_len
    return members


def _zip64_values(extra: bytes) -> list[int]:
    at = 0
    while at + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, at)
        if kind == _ZIP64_EXTRA:
            return list(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
        at += 4 + size
    return []


def _clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def warc_record(kind: str, record_id: str, date: str, page_id: int | None, url: str | None, payload: bytes | None,
                size: int, digest_hex: str, refers_to: int | None = None, refers_url: str | None = None) -> bytes:
    """One WARC/1.1 record; a revisit keeps only the HTTP header of the payload it stands for."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload if kind == RESPONSE else b"")
    digest = base64.b32encode(binascii.unhexlify(digest_hex)).decode()
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    if page_id is not None:
        head.append(("WARC-Page-ID", str(page_id)))
    head += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if kind == REVISIT:
        head.append(("WARC-Profile", PROFILE))
        if refers_url is not None:
            head.append(("WARC-Refers-To-Target-URI", _clean(refers_url)))
        if refers_to is not None:
            head.append(("WARC-Refers-To-Page-ID", str(refers_to)))
    head.append(("Content-Length", str(len(block))))
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Type, page ids, payload size and bare hex SHA-1 of one record; a response's payload is hashed as read."""
    stop = data.index(b"\r\n\r\n")
    lines = data[:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = dict(line.split(": ", 1) for line in lines[1:])
    block = data[stop + 4 : stop + 4 + int(head["Content-Length"])]
    http_end = block.index(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in block[:http_end].decode().split("\r\n")[1:])
    kind = head["WARC-Type"]
    if kind == RESPONSE:
        payload = block[http_end + 4 :]
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    else:
        size = int(http["Content-Length"])
        digest = binascii.hexlify(base64.b32decode(head["WARC-Payload-Digest"].split(":", 1)[1])).decode()
    refers = head.get("WARC-Refers-To-Page-ID")
    page = head.get("WARC-Page-ID")
    return {
        "page_id": None if page is None else int(page), "record_type": kind, "payload_bytes": size, "payload_digest": digest,
        "refers_to": None if refers is None else int(refers),
    }


def decide(pages: DataFrame) -> DataFrame:
    """Rows with their payload, its size and digest, record type and the page a revisit refers to.

    Payload: the html in UTF-8, null as empty. Of equal payloads of at least
    ``REVISIT_BYTES``, the row with the largest page_id (null the smallest;
    equal ids: the one read last) is the response. Extra columns are dropped.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.monotonically_increasing_id().alias("__llm_row"),
    ).select("*", F.length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    long = rows.where(F.col("payload_bytes") >= REVISIT_BYTES)
    heads = long.groupBy(F.col("payload_digest").alias("__llm_digest"), F.col("payload_bytes").alias("__llm_bytes")).agg(
        F.max(F.struct("page_id", "__llm_row", "url")).alias("__llm_head")
    )
    matched = long.join(heads, (F.col("payload_digest") == F.col("__llm_digest")) & (F.col("payload_bytes") == F.col("__llm_bytes")))
    is_head = F.col("__llm_row") == F.col("__llm_head.__llm_row")
    kind = F.when(is_head, F.lit(RESPONSE)).otherwise(F.lit(REVISIT))
    keep = ["page_id", "url", "payload_bytes", "payload_digest"]
    long = matched.select(
        *keep, F.when(is_head, F.col("payload")).alias("payload"), kind.alias("record_type"),
        F.when(~is_head, F.col("__llm_head.page_id")).alias("refers_to"), F.when(~is_head, F.col("__llm_head.url")).alias("refers_url"),
    )
    short = rows.where(F.col("payload_bytes") < REVISIT_BYTES).select(
        *keep, "payload", F.lit(RESPONSE).alias("record_type"), F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_url")
    )
    return long.unionByName(short)


def write_archives(decided: DataFrame, folder: str) -> DataFrame:
    """Write every row of ``decide`` as a record; returns the archives written (path, records, bytes), stored."""
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        filesystem, base = _filesystem(folder)
        filesystem.create_dir(base, recursive=True)
        written: list[tuple[str, int, int]] = []
        state: dict = {}

        def close() -> None:
            if state:
                zipper = state["zip"]
                zipper.end()
                zipper.begin(INDEX_MEMBER)
                zipper.write("".join(f"{a} {n}\n" for a, n in state["index"]).encode())
                zipper.end()
                zipper.close()
                written.append((state["path"], len(state["index"]), zipper.size))
                state.clear()

        for batch in batches:
            for row in batch.to_pylist():
                if not state:
                    name = f"part-{task.partitionId():05d}-{task.attemptNumber()}-{len(written):04d}.zip"
                    state.update(path=f"{folder.rstrip('/')}/{name}", zip=ZipWriter(filesystem.open_output_stream(f"{base.rstrip('/')}/{name}")), index=[])
                    state["zip"].begin(WARC_MEMBER)
                record_id = str(uuid.uuid5(uuid.NAMESPACE_URL, f"{state['path']}#{len(state['index'])}"))
                data = warc_record(
                    row["record_type"], record_id, date, row["page_id"], row["url"], row["payload"], row["payload_bytes"],
                    row["payload_digest"], row["refers_to"], row["refers_url"],
                )
                data = gzip.compress(data, compresslevel=GZIP_LEVEL, mtime=0)
                state["index"].append((state["zip"].write(data), len(data)))
                if state["zip"].size >= ARCHIVE_BYTES:
                    close()
        close()
        yield pa.RecordBatch.from_pylist(
            [{"path": p, "records": n, "bytes": b} for p, n, b in written], schema=pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
        )

    return staged(decided.mapInArrow(archives, "path string, records long, bytes long"), "warc-archives")


READ_SCHEMA = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, archive string, offset long, length long"


def read_archives(written: DataFrame) -> DataFrame:
    """Every record of the archives named in ``written``, one task per archive, each record read by its range."""
    fields = [f.name for f in written.sparkSession.createDataFrame([], READ_SCHEMA).schema.fields]
    arrow = pa.schema([(n, pa.string() if n in ("record_type", "payload_digest", "archive") else pa.int64()) for n in fields])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for path in batch.column("path").to_pylist():
                filesystem, name = _filesystem(path)
                with filesystem.open_input_file(name) as source:
                    members = zip_members(source)
                    warc_at, _ = members[WARC_MEMBER]
                    index_at, index_size = members[INDEX_MEMBER]
                    for line in source.read_at(index_size, index_at).decode().splitlines():
                        offset, length = map(int, line.split())
                        row = parse_record(gzip.decompress(source.read_at(length, warc_at + offset)))
                        rows.append(row | {"archive": path, "offset": offset, "length": length})
                        if len(rows) >= BATCH_ROWS:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    count = written.count()
    spread = written.repartitionByRange(max(1, count), "path")
    return spread.mapInArrow(records, READ_SCHEMA)


def archive_round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` as WARC archives below ``folder`` and read every record back.

    Returns per row: page_id, payload_bytes, payload_digest (bare hex SHA-1),
    record_type, refers_to, and where the record lies (archive, offset,
    length). Null html counts as empty; a null url writes no target header;
    null page ids stay null (and never win a tie of payloads if another id is
    there). Repeated rows each get a record. Empty table: no archives, no rows.
    """
    return read_archives(write_archives(decide(pages), folder))
