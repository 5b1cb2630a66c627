"""WARC records in ZIP-packaged web archives, read by byte ranges.

A package is a ZIP file of stored (not deflated) members: `archive/data.warc.gz`,
one gzip member a record, and `indexes/index.cdxj`, one line a record with its
place in the archive. A reader goes to the end of the file, takes the central
directory from there (its ZIP64 form too), finds the members, and then reads
single records by range. Nothing is extracted.

Pages with equal payloads are written once: the one with the smallest id is a
response, the others revisit it. Which is which comes from a join on the
payload's digest, in which a frequent payload is split like any skewed key.

Packages close after `PACKAGE_BYTES`, and an index is read in steps, so memory is
bounded by one batch of pages and the index of one package.

Defined results: a null html is an empty payload. A page without id is a revisit where any page
with an id has the same payload, else a response. Rows that repeat the smallest
id are responses each. Payloads under `least` bytes are all responses.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.llm.files import new_file, store_of
from rankloom.staging import fresh_folder, stage

PACKAGE_BYTES = 64 << 20
LEAST_BYTES = 0
WARC, CDX = "archive/data.warc.gz", "indexes/index.cdxj"

# Signatures and layouts of the ZIP format.
_LOCAL, _CENTRAL, _END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06"
_END64, _LOCATOR64 = b"PK\x06\x06", b"PK\x06\x07"
_LOCAL_HEAD = "<4sHHHHHIIIHH"
_CENTRAL_HEAD = "<4sHHHHHHIIIHHHHHII"
_END_RECORD = "<4sHHHHIIH"
_END64_RECORD = "<4sQHHIIQQQQ"
_LOCATOR_RECORD = "<4sIQI"
_ZIP64_EXTRA = 1
_MAX32, _MAX16 = 0xFFFFFFFF, 0xFFFF


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """A response, or a revisit that has the response's HTTP head and no payload."""
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Content-Length: %d\r\n\r\n" % len(payload)
    )
    block = http if refers_to is not None else http + payload
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    head += [
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    # URLs are text of any kind: line ends in them are no line ends of the head.
    lines = [line.replace("\r", "%0D").replace("\n", "%0A") for line in head]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], int, bytes]:
    """Head of a record, the Content-Length its HTTP head names, and the payload in it."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    return fields, int(named["Content-Length"]), payload


class PackageWriter:
    """One ZIP package, written front to back as records come."""

    def __init__(self, folder: str, zip64: bool = False) -> None:
        store, self.path = new_file(folder, "pages.wacz")
        self.out = store.open_output_stream(self.path)
        self.at = 0
        self.zip64 = zip64
        self.members: list[tuple[bytes, int, int, int]] = []
        self.index: list[bytes] = []
        self.crc = self.size = 0
        self.start = self._open(WARC)

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _open(self, name: str) -> int:
        """Head of a member whose size is not known yet: it follows in a descriptor."""
        start = self.at
        raw = name.encode()
        self._write(struct.pack(_LOCAL_HEAD, _LOCAL, 45, 8, 0, 0, 33, 0, 0, 0, len(raw), 0) + raw)
        self.crc = self.size = 0
        return start

    def _data(self, data: bytes) -> None:
        self.crc = zlib.crc32(data, self.crc)
        self.size += len(data)
        self._write(data)

    def _close(self, name: str, start: int) -> None:
        wide = self.zip64 or self.size >= _MAX32
        kind = "<4sIQQ" if wide else "<4sIII"
        self._write(struct.pack(kind, b"PK\x07\x08", self.crc, self.size, self.size))
        self.members.append((name.encode(), self.crc, self.size, start))

    def add(self, page_id: int | None, record: bytes) -> None:
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        entry = {"page": page_id, "offset": self.size, "length": len(packed)}
        self.index.append(json.dumps(entry).encode() + b"\n")
        self._data(packed)

    def close(self) -> None:
        self._close(WARC, self.start)
        start = self._open(CDX)
        for line in self.index:
            self._data(line)
        self._close(CDX, start)
        central = self.at
        for name, crc, size, at in self.members:
            wide = self.zip64 or max(size, at) >= _MAX32
            extra = struct.pack("<HHQQQ", _ZIP64_EXTRA, 24, size, size, at) if wide else b""
            small = (_MAX32, _MAX32) if wide else (size, size)
            head = struct.pack(
                _CENTRAL_HEAD, _CENTRAL, 45, 45, 8, 0, 0, 33, crc, *small, len(name), len(extra),
                0, 0, 0, 0, _MAX32 if wide else at,
            )
            self._write(head + name + extra)
        size, count = self.at - central, len(self.members)
        if self.zip64 or self.at >= _MAX32:
            end = self.at
            self._write(
                struct.pack(_END64_RECORD, _END64, 44, 45, 45, 0, 0, count, count, size, central)
            )
            self._write(struct.pack(_LOCATOR_RECORD, _LOCATOR64, 0, end, 1))
            count, size, central = _MAX16, _MAX32, _MAX32
        self._write(struct.pack(_END_RECORD, _END, 0, 0, count, count, size, central, 0))
        self.out.close()


class Package:
    """Members of a ZIP file, found by its central directory and read by range."""

    def __init__(self, folder: str, path: str) -> None:
        self.file = store_of(folder).open_input_file(path)
        self.members = {name: place for name, *place in self._central()}

    def _at(self, start: int, count: int) -> bytes:
        data = self.file.read_at(count, start)
        if len(data) < count:
            raise ValueError("the archive ends early")
        return data

    def _directory(self) -> tuple[int, int]:
        """Offset and size of the central directory."""
        size = self.file.size()
        # The end record is the last thing but for a comment of up to 64 KiB.
        tail = self._at(max(0, size - 65557), min(size, 65557))
        at = tail.rfind(_END)
        if at < 0:
            raise ValueError("no ZIP archive")
        record = struct.unpack_from(_END_RECORD, tail, at)
        length, offset = record[5], record[6]
        if _MAX32 in (length, offset) or record[4] == _MAX16:
            start = size - len(tail) + at - struct.calcsize(_LOCATOR_RECORD)
            locator = struct.unpack(_LOCATOR_RECORD, self._at(start, 20))
            if locator[0] != _LOCATOR64:
                raise ValueError("no ZIP64 locator")
            wide = struct.unpack(_END64_RECORD, self._at(locator[2], 56))
            length, offset = wide[8], wide[9]
        return offset, length

    def _central(self) -> Iterator[tuple[str, int, int, int]]:
        """Name, offset of the local head, stored size and method of each member."""
        offset, length = self._directory()
        directory, at = self._at(offset, length), 0
        fixed = struct.calcsize(_CENTRAL_HEAD)
        while at < length:
            head = struct.unpack_from(_CENTRAL_HEAD, directory, at)
            if head[0] != _CENTRAL:
                raise ValueError("broken central directory")
            method, packed, size, start = head[4], head[8], head[9], head[16]
            names, extras, comments = head[10:13]
            at += fixed
            name = directory[at : at + names].decode()
            extra = directory[at + names : at + names + extras]
            at += names + extras + comments
            packed, start = _widened(extra, size, packed, start)
            yield name, start, packed, method

    def locate(self, name: str) -> tuple[int, int]:
        """Where a stored member's bytes start, and how many there are."""
        start, size, method = self.members[name]
        if method:
            raise ValueError(f"{name} is not stored")
        head = struct.unpack(_LOCAL_HEAD, self._at(start, struct.calcsize(_LOCAL_HEAD)))
        if head[0] != _LOCAL:
            raise ValueError(f"no local head of {name}")
        return start + struct.calcsize(_LOCAL_HEAD) + head[9] + head[10], size

    def read(self, name: str, step: int = 1 << 20) -> Iterator[bytes]:
        start, size = self.locate(name)
        for at in range(0, size, step):
            yield self._at(start + at, min(step, size - at))

    def index(self) -> Iterator[dict]:
        rest = b""
        for part in self.read(CDX):
            *lines, rest = (rest + part).split(b"\n")
            yield from map(json.loads, lines)

    def record(self, entry: dict) -> bytes:
        start, size = self.locate(WARC)
        if entry["offset"] + entry["length"] > size:
            raise ValueError("an index entry lies outside its archive")
        return zlib.decompress(self._at(start + entry["offset"], entry["length"]), 31)


def _widened(extra: bytes, size: int, packed: int, start: int) -> tuple[int, int]:
    """Stored size and offset, from the ZIP64 field where the head has no room for them."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == _ZIP64_EXTRA:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            if size == _MAX32:
                next(wide)
            packed = next(wide) if packed == _MAX32 else packed
            start = next(wide) if start == _MAX32 else start
        at += 4 + length
    return packed, start


def with_references(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """`page_id`, `url`, `html`, and `refers_to`: the page that has the same payload first."""
    rows = pages.select(
        "page_id",
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    digest = F.sha1(F.encode("html", "UTF-8"))
    long_enough = F.octet_length("html") >= least
    narrow = rows.where(long_enough).select("page_id", digest.alias("_digest"))
    shared = narrow.groupBy("_digest").agg(
        F.min("page_id").alias("_first"), F.count("*").alias("_copies")
    )
    shared = shared.where("_copies > 1 AND _first IS NOT NULL").drop("_copies")
    # Rows that nothing is to be looked up for get a key of their own.
    key = F.when(long_enough, digest).otherwise(F.concat(F.lit("short"), F.xxhash64("page_id", "html")))
    joined = rows.withColumn("_digest", key).join(shared, "_digest", "left")
    refers = F.when(~F.col("_first").eqNullSafe(F.col("page_id")), F.col("_first"))
    return joined.select("page_id", "url", "html", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write all pages of `with_references`; the paths of the packages."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            for page_id, url, html, refers_to in zip(*batch.columns):
                if writer is None:
                    writer = PackageWriter(folder)
                page = page_id.as_py()
                payload = html.as_py().encode("utf-8", "surrogatepass")
                writer.add(page, warc_record(page, url.as_py(), payload, refers_to.as_py()))
                if writer.at >= package_bytes:
                    writer.close()
                    yield _one("path", writer.path)
                    writer = None
        if writer is not None:
            writer.close()
            yield _one("path", writer.path)

    return stage(pages.mapInArrow(pack, "path string"), "warc-packages")


def _one(name: str, value: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([value])], names=[name])


_READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def read(packages: DataFrame, folder: str) -> DataFrame:
    """Per record what its heads and payload say; a response's payload is digested anew."""

    def page_of(urn: str | None) -> int | None:
        number = (urn or "")[len("<urn:page:") : -1]
        return int(number) if number else None

    def rows(path: str) -> Iterator[tuple]:
        package = Package(folder, path)
        for entry in package.index():
            fields, length, payload = parse_record(package.record(entry))
            digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if fields["WARC-Type"] == "response":
                if (len(payload), payload_digest(payload)) != (length, digest):
                    raise ValueError(f"a payload of {path} does not fit its digest")
            yield (
                page_of(fields["WARC-Record-ID"]),
                length,
                digest,
                fields["WARC-Type"],
                page_of(fields.get("WARC-Refers-To")),
            )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                waiting = []
                for row in rows(path):
                    waiting.append(row)
                    if len(waiting) == 5_000:
                        yield _table(waiting)
                        waiting = []
                if waiting:
                    yield _table(waiting)

    cores = packages.sparkSession.sparkContext.defaultParallelism
    return packages.repartition(max(1, 4 * cores), "path").mapInArrow(unpack, _READ)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=names)


def write_and_read(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    folder = fresh_folder(pages.sparkSession, "warc")
    return read(write(with_references(pages, least), folder), folder)
