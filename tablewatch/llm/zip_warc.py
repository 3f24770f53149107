"""WARC records in ZIP packages: writing, and reading by range without extraction.

A package is a ZIP file with two *stored* members: ``archive/data.warc.gz``, WARC records each
gzipped on its own, and ``indexes/index.tsv``, one line per record (page id, offset and length
in the archive member, record type). ``ZipDirectory`` finds members by the end record and the central
directory, with ZIP64 sizes and offsets, and where their bytes lie; a record is then one range read.

Of records with equal payloads (of at least ``min_bytes``) the one with the smallest page id is a
response and the others are revisits that refer to it, without the payload. Payloads are hashed where
they are read; only (page id, digest) is shuffled to pair them, with partial minima per digest, and
the pages themselves are shuffled once, by page id and digest, so no group of equal pages meets in one
task.

Defined results: a null or empty html is a payload of 0 bytes. Rows that repeat a page id and payload
are all response (or all revisit). A null page id never is the smallest: such rows are
revisits if an equal payload has an id, else responses. Extra columns are ignored; an
empty table gives no package and an empty result.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import filesystem, new_file, stored
from tablewatch.session import scratch_path

PACKAGE_BYTES = 256 << 20  # a package is closed at about this size
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.tsv"
_BIG16, _BIG32 = 0xFFFF, 0xFFFFFFFF
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- ZIP -----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    offset: int  # of the local header
    size: int


class ZipDirectory:
    """The members of a ZIP file, read from its end. ``read_at(length, offset)`` fetches bytes."""

    def __init__(self, read_at, size: int):
        self.read_at = read_at
        tail_at = max(0, size - (22 + _BIG16))
        tail = read_at(size - tail_at, tail_at)
        end = tail.rfind(b"PK\x05\x06")
        while end >= 0 and (end + 22 > len(tail) or end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail)):
            end = tail.rfind(b"PK\x05\x06", 0, end)  # a comment may hold the signature
        if end < 0:
            raise ValueError("no end-of-central-directory record")
        count, length, start = struct.unpack_from("<HII", tail, end + 10)
        if _BIG16 == count or _BIG32 in (length, start):
            locator = read_at(20, tail_at + end - 20)
            if locator[:4] != b"PK\x06\x07":
                raise ValueError("no ZIP64 locator")
            record = read_at(56, struct.unpack_from("<Q", locator, 8)[0])
            if record[:4] != b"PK\x06\x06":
                raise ValueError("no ZIP64 end record")
            count, length, start = struct.unpack_from("<QQQ", record, 32)
        self.members = {m.name: m for m in self._entries(read_at(length, start), count)}

    @staticmethod
    def _entries(data: bytes, count: int) -> Iterator[Member]:
        at = 0
        for _ in range(count):
            if data[at : at + 4] != b"PK\x01\x02":
                raise ValueError("central directory is damaged")
            method = struct.unpack_from("<H", data, at + 10)[0]
            packed, size, name_n, extra_n, comment_n = struct.unpack_from("<IIHHH", data, at + 20)
            offset = struct.unpack_from("<I", data, at + 42)[0]
            name = data[at + 46 : at + 46 + name_n].decode("utf-8")
            extra, place = data[at + 46 + name_n : at + 46 + name_n + extra_n], 0
            while place + 4 <= len(extra):
                kind, n = struct.unpack_from("<HH", extra, place)
                if kind == 1:  # ZIP64: those of size, packed size and offset that did not fit, in this order
                    wide = list(struct.unpack_from(f"<{n // 8}Q", extra, place + 4))
                    size = wide.pop(0) if size == _BIG32 else size
                    packed = wide.pop(0) if packed == _BIG32 else packed
                    offset = wide.pop(0) if offset == _BIG32 else offset
                place += 4 + n
            yield Member(name, method, offset, size)
            at += 46 + name_n + extra_n + comment_n

    def locate(self, name: str) -> tuple[int, int]:
        """(offset, length) of a stored member's bytes in the file."""
        m = self.members[name]
        if m.method != 0:
            raise ValueError(f"{name} is compressed: it cannot be read by range")
        head = self.read_at(30, m.offset)
        if head[:4] != b"PK\x03\x04":
            raise ValueError(f"{name}: local header is damaged")
        name_n, extra_n = struct.unpack_from("<HH", head, 26)
        return m.offset + 30 + name_n + extra_n, m.size


class ZipWriter:
    """Stored members written in one pass: checksum and sizes follow each member's bytes, in ZIP64 width."""

    def __init__(self, out):
        self.out, self.at, self.entries = out, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def start(self, name: str) -> None:
        raw = name.encode()
        self.open = [raw, self.at, 0, 0]
        # Flag 3: sizes follow; flag 11: names are UTF-8. The extra field announces 8-byte sizes.
        self._put(struct.pack("<4sHHHHHIIIHH", b"PK\x03\x04", 45, 0x0808, 0, 0, 0x21, 0, _BIG32, _BIG32, len(raw), 20) + raw + struct.pack("<HHQQ", 1, 16, 0, 0))

    def write(self, data: bytes) -> None:
        self.open[2] = zlib.crc32(data, self.open[2])
        self.open[3] += len(data)
        self._put(data)

    def end(self) -> None:
        self._put(struct.pack("<4sIQQ", b"PK\x07\x08", self.open[2], self.open[3], self.open[3]))
        self.entries.append(tuple(self.open))

    def close(self) -> None:
        start = self.at
        for raw, offset, crc, size in self.entries:
            self._put(struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\x01\x02", 45, 45, 0x0808, 0, 0, 0x21, crc, _BIG32, _BIG32, len(raw), 28, 0, 0, 0, 0, _BIG32) + raw + struct.pack("<HHQQQ", 1, 24, size, size, offset))
        length, end = self.at - start, self.at
        n = len(self.entries)
        self._put(struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, length, start))
        self._put(struct.pack("<4sIQI", b"PK\x06\x07", 0, end, 1))
        self._put(struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, min(n, _BIG16), min(n, _BIG16), _BIG32, _BIG32, 0))


# --- WARC ----------------------------------------------------------------------------------------


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response with its payload, or a revisit (``refers_to`` given) without."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c for c in url or "" if c not in "\r\n")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Target-URI: {target}"]
    lines += [] if page_id is None else [f"WARC-Record-ID: <urn:page:{page_id}>"]
    lines += ["WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_REVISIT}"] if revisit else []
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode()
    return head + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC headers, HTTP headers, HTTP body) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    warc = dict(line.split(": ", 1) for line in lines if ": " in line)
    n = int(warc["Content-Length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise ValueError("record is cut off")
    http_head, _, body = rest[:n].partition(b"\r\n\r\n")
    http = dict(line.split(": ", 1) for line in http_head.decode().split("\r\n")[1:] if ": " in line)
    return warc, http, body


def _page(text: str | None) -> int | None:
    return int(text.removeprefix("<urn:page:").removesuffix(">")) if text else None


# --- Spark ---------------------------------------------------------------------------------------


def revisits(pages: DataFrame, min_bytes: int) -> DataFrame:
    """(page_id, sha1, refers_to) of the distinct rows to write as revisits; ``pages`` has sha1."""
    rows = stored(pages.where(F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes).select("page_id", "sha1"), "page-digests")
    first = rows.groupBy("sha1").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("_n")).where("_n > 1 and refers_to is not null").drop("_n")
    return rows.join(first, "sha1").where("page_id is null or page_id > refers_to").select("page_id", "sha1", "refers_to").distinct()


def write_packages(pages: DataFrame, min_bytes: int = 0, folder: str | None = None) -> tuple[str, DataFrame]:
    """(folder, stored list of the packages: file, records). ``pages``: page_id, url, html."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    pages = pages.select("page_id", "url", "html", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha1"))
    same = revisits(pages, min_bytes).select(F.col("page_id").alias("_id"), F.col("sha1").alias("_sha1"), "refers_to")
    rows = pages.join(same, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("sha1") == F.col("_sha1")), "left")
    rows = rows.select("page_id", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        row = next(pending, None)
        while row is not None:
            index, name = [], ""
            with new_file(folder, f"pages-{uuid.uuid4().hex[:8]}", ".wacz") as (out, name):
                package = ZipWriter(out)
                package.start(ARCHIVE)
                begin = package.at
                while row is not None and package.at < PACKAGE_BYTES:
                    page_id, url, html, target = row
                    payload = (html or "").encode("utf-8", "surrogatepass")
                    digest = payload_digest(payload)
                    data = gzip.compress(warc_record(page_id, url, payload, digest, target), 5, mtime=0)
                    kind = "response" if target is None else "revisit"
                    index.append(f"{'' if page_id is None else page_id}\t{package.at - begin}\t{len(data)}\t{kind}")
                    package.write(data)
                    row = next(pending, None)
                package.end()
                package.start(INDEX)
                package.write("\n".join(index).encode())
                package.end()
                package.close()
            yield pa.record_batch({"file": [name], "records": pa.array([len(index)], pa.int64())})

    return folder, stored(rows.mapInArrow(run, "file string, records long"), "packages")


def read_packages(packages: DataFrame, folder: str) -> DataFrame:
    """One row per record: (page_id, payload_bytes, payload_digest, record_type, refers_to). Records are
    fetched by the ranges that the package's index names; a response's digest is checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        for b in batches:
            for file in b.column(0).to_pylist():
                with fs.open_input_file(f"{root}/{file}") as f:
                    package = ZipDirectory(f.read_at, f.size())
                    (data_at, _), (index_at, index_n) = package.locate(ARCHIVE), package.locate(INDEX)
                    rows = []
                    for line in f.read_at(index_n, index_at).decode().split("\n"):
                        page, offset, length, kind = line.split("\t")
                        warc, http, body = parse_warc(gzip.decompress(f.read_at(int(length), data_at + int(offset))))
                        digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
                        if warc["WARC-Type"] != kind or (kind == "response" and payload_digest(body) != digest):
                            raise ValueError(f"{file}: record of page {page} is damaged")
                        rows.append((_page(warc.get("WARC-Record-ID")), int(http["Content-Length"]), digest, kind, _page(warc.get("WARC-Refers-To"))))
                for k in range(0, len(rows), 10_000):
                    columns = list(zip(*rows[k : k + 10_000]))
                    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    # Dealt in turn, as many tasks as packages: by the file, Spark would merge the few names into one task.
    files = packages.select("file").distinct()
    spread = files.repartition(max(1, min(files.count(), 10_000)))
    return spread.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    folder, packages = write_packages(pages, min_bytes)
    return read_packages(packages, folder)
