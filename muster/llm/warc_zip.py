"""ZIP-packaged web archives: written with a stored WARC member and its index, read by range without extraction.

Writing: each task streams its records, one gzip member each, into the stored member `archive/data.warc.gz` of a ZIP file in
the shared folder, and closes it with `indexes/index.cdxj` (offset and length of every record) before it grows over a bound. Names are
drawn anew for each attempt and only those of finished tasks are in the returned table, so a lost executor leaves at most a
file that nobody reads.

Reading: the end record, its ZIP64 locator and record where sizes need them, and the central directory are range-read and parsed; stored members
`archive/*.warc[.gz]` are located by their local headers. Index lines become ranges of whole records, and ranges, not
archives, are dealt to the tasks that read them. An uncompressed member without index is walked by the records' own lengths; a compressed one
is one range, read as a stream. A task holds one record and a read buffer.

Of records with equal payloads (by SHA-1 and size, at least `least` bytes) the one with the largest id is a response and the others are
revisits of it, without payload. Their digest and size are those that the revisit record states; a response's are taken from the payload read.

Defined cases: a null payload is empty. A null id is smaller than all others; equal payloads without any id are all responses, and so are
repeated rows of the largest id. Without a URL the record has none. Extra columns are not read; an empty table gives no archives and no records.
Files are reached through pyarrow's file systems, so the folder's store must be one of those (local or mounted, HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.llm.common import staged

ARCHIVE_BYTES, ARCHIVE_RECORDS = 256 << 20, 100_000
RANGE_BYTES, READ_BYTES, TASK_BYTES = 4 << 20, 1 << 20, 64 << 20
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the ZIP format: signatures and the all-ones marks that point to ZIP64 fields.
_END, _LOCATOR, _END64, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x07", b"PK\x06\x06", b"PK\x01\x02", b"PK\x03\x04"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF
_MEMBER, _INDEX = re.compile(r"archive/.+\.warc(\.gz)?"), re.compile(r"indexes/.+\.cdxj")
_FIELDS = "id string, record_type string, target_uri string, payload_bytes long, payload_digest string, refers_to string, intact boolean"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith(("/", "file:")):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    return fs.FileSystem.from_uri(path)


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _urn(name: str | None) -> str:
    return "<urn:record>" if name is None else f"<urn:record:{quote(name, safe='')}>"


def _id(urn: str | None) -> str | None:
    found = re.fullmatch(r"<urn:record:(.*)>", urn or "")
    return unquote(found[1]) if found else None


def record(name: str | None, uri: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": _urn(name), "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{base32(hashlib.sha1(payload).digest())}",
        "Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block)),
    }
    if uri is not None:
        head["WARC-Target-URI"] = quote(uri, safe="!#$%&'()*+,/:;=?@[]~")
    if refers_to is not None:
        head |= {"WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", "WARC-Refers-To": _urn(refers_to)}
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in head.items()), "\r\n"]).encode() + block + b"\r\n\r\n"


class _Archive:
    """A ZIP file being written as a stream: the records' member first, then its index."""

    def __init__(self, folder: str, compress: bool):
        self.path = f"{folder}/{uuid.uuid4().hex}.zip"
        store, path = _store(self.path)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.out, self.compress = store.open_output_stream(path), compress
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED)
        self.name = "archive/data.warc.gz" if compress else "archive/data.warc"
        self.member = self.zip.open(self.name, "w", force_zip64=True)
        self.index: list[str] = []
        self.size = 0

    def add(self, name: str | None, raw: bytes) -> None:
        stored = gzip.compress(raw, 6, mtime=0) if self.compress else raw
        self.member.write(stored)
        self.index.append(f"{_urn(name)[1:-1]} {json.dumps({'filename': self.name.split('/')[1], 'offset': self.size, 'length': len(stored)})}\n")
        self.size += len(stored)

    def full(self) -> bool:
        return self.size >= ARCHIVE_BYTES or len(self.index) >= ARCHIVE_RECORDS

    def close(self) -> tuple[str, int, int]:
        self.member.close()
        self.zip.writestr("indexes/index.cdxj", "".join(self.index))
        self.zip.close()
        length = self.out.tell()
        self.out.close()
        return self.path, length, len(self.index)


def written(records: DataFrame, folder: str, compress: bool = True) -> DataFrame:
    """(path, length, records) of the archives made of rows (id, uri, payload, refers_to)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, archive = [], None
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                archive = archive or _Archive(folder, compress)
                archive.add(row[0], record(row[0], row[1], row[2] or b"", row[3]))
                if archive.full():
                    done.append(archive.close())
                    archive = None
        if archive:
            done.append(archive.close())
        yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*done)], names=["path", "length", "records"]) if done else pa.RecordBatch.from_pylist([], pa.schema([("path", pa.string()), ("length", pa.int64()), ("records", pa.int64())]))

    rows = records.select(F.col("id").cast("string"), F.col("uri").cast("string"), F.col("payload").cast("binary"), F.col("refers_to").cast("string"))
    return staged(rows.mapInArrow(run, "path string, length long, records long"), "archives-written")


def with_revisits(records: DataFrame, least: int = 0) -> DataFrame:
    """Rows (id, uri, payload) with refers_to: the largest id among equal payloads of at least `least` bytes, null for that one."""
    rows = records.select("id", "uri", F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "bytes": F.octet_length("payload")})
    again = rows.where(F.col("bytes") >= least).groupBy("sha1", "bytes").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("times"))
    again = staged(again.where("times > 1 AND last IS NOT NULL").select("sha1", "bytes", "last"), "equal-payloads")
    return rows.join(again, ["sha1", "bytes"], "left").select("id", "uri", "payload", F.when(~F.col("id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


class _File:
    """Range reads of one file."""

    def __init__(self, path: str):
        store, inner = _store(path)
        self.file = store.open_input_file(inner)

    def at(self, start: int, length: int) -> bytes:
        self.file.seek(start)
        found = self.file.read(length)
        if len(found) != length:
            raise ValueError(f"the archive ends at {start + len(found)}, {length} bytes were to be read from {start}")
        return found

    def chunks(self, start: int, length: int) -> Iterator[bytes]:
        for k in range(0, length, READ_BYTES):
            yield self.at(start + k, min(READ_BYTES, length - k))


def _zip64(extra: bytes, wanted: list[bool]) -> list[int]:
    """The 8-byte values of the ZIP64 extra field, which has one for each wanted field, in order."""
    k = 0
    while k + 4 <= len(extra):
        kind, size = struct.unpack_from("<HH", extra, k)
        if kind == 1:
            return list(struct.unpack_from(f"<{sum(wanted)}Q", extra, k + 4))
        k += 4 + size
    raise ValueError("a size needs a ZIP64 field that is not there")


def members(file: _File, length: int) -> Iterator[tuple[str, int, int, int]]:
    """(name, method, start, stored size) of every member, from the central directory; the start is behind its local header."""
    tail_at = max(0, length - 22 - _FULL16)
    tail = file.at(tail_at, length - tail_at)
    k = tail.rfind(_END)
    while k >= 0 and (k + 22 > len(tail) or k + 22 + struct.unpack_from("<H", tail, k + 20)[0] != len(tail)):
        k = tail.rfind(_END, 0, k)
    if k < 0:
        raise ValueError("no end of a central directory")
    entries, size, start = struct.unpack_from("<HII", tail, k + 10)
    end = tail_at + k
    if entries == _FULL16 or _FULL32 in (size, start):
        locator = file.at(end - 20, 20)
        if locator[:4] != _LOCATOR:
            raise ValueError("no ZIP64 locator")
        end = struct.unpack_from("<Q", locator, 8)[0]
        last = file.at(end, 56)
        if last[:4] != _END64:
            raise ValueError("no ZIP64 end of a central directory")
        entries, size, start = struct.unpack_from("<QQQ", last, 32)
    shift = end - size - start  # bytes put before the archive
    held, at, rest = b"", 0, file.chunks(start + shift, size)
    for _ in range(entries):
        while len(held) < at + 46 or len(held) < at + 46 + sum(struct.unpack_from("<HHH", held, at + 28)):
            held, at = held[at:] + next(rest, b"\0" * 46), 0
        if held[at : at + 4] != _ENTRY:
            raise ValueError("the central directory is broken")
        flags, method = struct.unpack_from("<HH", held, at + 8)
        stored, full, n, m, c = struct.unpack_from("<IIHHH", held, at + 20)
        offset = struct.unpack_from("<I", held, at + 42)[0]
        name, extra = held[at + 46 : at + 46 + n].decode("utf-8", "replace"), held[at + 46 + n : at + 46 + n + m]
        at += 46 + n + m + c
        wanted = [full == _FULL32, stored == _FULL32, offset == _FULL32]
        if any(wanted):
            values = iter(_zip64(extra, wanted))
            full, stored, offset = (next(values) if w else x for w, x in zip(wanted, (full, stored, offset)))
        local = file.at(offset + shift, 30)
        if local[:4] != _LOCAL:
            raise ValueError(f"no local header of {name}")
        if not flags & 1:
            yield name, method, offset + shift + 30 + sum(struct.unpack_from("<HH", local, 26)), stored


def _lines(chunks: Iterator[bytes]) -> Iterator[bytes]:
    rest = b""
    for c in chunks:
        *whole, rest = (rest + c).split(b"\n")
        yield from whole
    if rest:
        yield rest


def _plain(chunks: Iterator[bytes], method: int) -> Iterator[bytes]:
    """An index's bytes; indexes may be deflated, unlike archive members."""
    if method == 0:
        yield from chunks
        return
    d = zlib.decompressobj(-15)
    for c in chunks:
        yield d.decompress(c)
    yield d.flush()


def _walked(file: _File, start: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of the records of an uncompressed member, from their headers alone."""
    k = 0
    while k < size:
        head = b""
        while b"\r\n\r\n" not in head:
            more = min(4096, size - k - len(head))
            if more <= 0:
                raise ValueError("a record's header does not end")
            head += file.at(start + k + len(head), more)
        named = _headers(head.split(b"\r\n\r\n", 1)[0])
        length = head.index(b"\r\n\r\n") + 4 + int(named["content-length"]) + 4
        yield k, length
        k += length


def _located(file: _File, length: int) -> Iterator[tuple[str, bool, int, int]]:
    """(member, gzipped, start, length) of ranges of whole records, of RANGE_BYTES or a little more or one record."""
    archives, indexes = {}, []
    for name, method, start, size in members(file, length):
        if method == 0 and _MEMBER.fullmatch(name):
            archives[name.split("/", 1)[1]] = (name, start, size)
        elif method in (0, 8) and _INDEX.fullmatch(name):
            indexes.append((method, start, size))

    def records() -> Iterator[tuple[str, int, int]]:
        indexed = set()
        for method, start, size in indexes:
            for line in _lines(_plain(file.chunks(start, size), method)):
                if b"{" in line:
                    entry = json.loads(line[line.index(b"{") :])
                    if entry["filename"] in archives:
                        indexed.add(entry["filename"])
                        yield entry["filename"], int(entry["offset"]), int(entry["length"])
        for short in archives.keys() - indexed:
            name, start, size = archives[short]
            spans = [(0, size)] if name.endswith(".gz") else _walked(file, start, size)
            for offset, n in spans:
                yield short, offset, n

    held: tuple[str, int, int] | None = None
    for short, offset, n in records():
        if held and held[0] == short and held[1] + held[2] == offset and held[2] < RANGE_BYTES:
            held = (short, held[1], held[2] + n)
            continue
        if held:
            yield _range(archives, *held)
        held = (short, offset, n)
    if held and held[2]:
        yield _range(archives, *held)


def _range(archives: dict[str, tuple[str, int, int]], short: str, offset: int, n: int) -> tuple[str, bool, int, int]:
    name, start, size = archives[short]
    if offset + n > size:
        raise ValueError(f"the index points behind the end of {name}")
    return name, name.endswith(".gz"), start + offset, n


def _unzipped(chunks: Iterator[bytes]) -> Iterator[bytes]:
    d = zlib.decompressobj(31)
    for c in chunks:
        while c:
            yield d.decompress(c)
            c = d.unused_data
            if d.eof:
                d = zlib.decompressobj(31)


def _headers(raw: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in raw.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def records_of(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each WARC record of a byte stream."""
    held = bytearray()

    def until(n: int) -> bool:
        while len(held) < n:
            c = next(chunks, None)
            if c is None:
                return False
            held.extend(c)
        return True

    while until(1):
        looked = 0
        while (k := held.find(b"\r\n\r\n", looked)) < 0:
            looked = max(0, len(held) - 3)
            if not until(len(held) + 1):
                raise ValueError("a record's header does not end")
        head = _headers(bytes(held[:k]))
        n = int(head["content-length"])
        if not until(k + 4 + n + 4):
            raise ValueError("a record is cut short")
        if held[k + 4 + n : k + 8 + n] != b"\r\n\r\n":
            raise ValueError("a record does not end where it says")
        yield head, bytes(held[k + 4 : k + 4 + n])
        del held[: k + 4 + n + 4]


def _row(head: dict[str, str], block: bytes) -> tuple:
    """The output fields of a record, and its payload."""
    http, _, payload = block.partition(b"\r\n\r\n") if head.get("content-type", "").startswith("application/http") else (b"", b"", block)
    stated = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
    kind, name, uri = head.get("warc-type"), _id(head.get("warc-record-id")), head.get("warc-target-uri")
    if kind == "revisit":
        size = _headers(http).get("content-length")
        return name, kind, uri, None if size is None else int(size), stated, _id(head.get("warc-refers-to")), True, None
    found = base32(hashlib.sha1(payload).digest())
    return name, kind, uri, len(payload), found, None, stated in (None, found), payload


def _tasks(archives: DataFrame) -> int:
    total = archives.agg(F.sum("length")).first()[0] or 0
    return max(archives.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))


def ranges(archives: DataFrame, tasks: int) -> DataFrame:
    """(path, member, gz, start, length): where records lie in the archives (path, length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, length in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = [(path, *x) for x in _located(_File(path), length)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in zip(*found)], names=["path", "member", "gz", "start", "length"])

    listed = archives.select("path", "length").repartition(tasks, "path")
    return listed.mapInArrow(run, "path string, member string, gz boolean, start long, length long")


def read(archives: DataFrame, payload: bool = False) -> DataFrame:
    """(id, record_type, target_uri, payload_bytes, payload_digest, refers_to, intact[, payload]) of every record of the archives (path,
    length). intact: the payload read has the stated digest."""
    names = [x.split()[0] for x in _FIELDS.split(", ")] + ["payload"] * payload
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_()] + [pa.binary()] * payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(zip(*rows), kinds)], names=names)

        for b in batches:
            for path, gz, start, length in zip(*(b.column(c).to_pylist() for c in ("path", "gz", "start", "length"))):
                chunks = _File(path).chunks(start, length)
                for head, block in records_of(_unzipped(chunks) if gz else chunks):
                    rows.append(_row(head, block)[: len(names)])
                    size += 200 + payload * len(block)
                    if size > READ_BYTES:
                        yield batch()
                        rows, size = [], 0
        if rows:
            yield batch()

    tasks = _tasks(archives)
    dealt = ranges(archives, tasks).repartition(tasks, "path", "start")
    return dealt.mapInArrow(run, _FIELDS + ", payload binary" * payload)
