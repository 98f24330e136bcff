"""Web archives in ZIP packages: written per task, read by range without extraction.

A package holds WARC members, stored and not deflated, each record its own gzip
member, and indexes of the records' places. A reader takes the ZIP directory
(with its 64-bit form) from the end of the file, finds where each stored member
begins, reads the index, and then only the byte ranges of records, so one large
package is shared by many tasks. Files are reached through the file system of
their address, never as local paths.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.staging import stage, staging_path

#: Bytes of compressed records after which a task begins another package.
PACKAGE_BYTES = 64 << 20
#: Bytes that one reading step takes at most, if no single record is longer.
RANGE_BYTES = 4 << 20
#: Packages whose directories one task reads, and ranges whose records one task reads.
PACKAGES_A_TASK, RANGES_A_TASK = 16, 4

_END, _END64, _LOCATOR64, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"


def _open_system(address: str) -> tuple[pa.fs.FileSystem, str]:
    if re.match(r"file:/[^/]", address):
        address = "file://" + address[len("file:"):]
    return pa.fs.FileSystem.from_uri(address)


# Writing

def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC response, or a revisit that holds the HTTP head alone; Content-Length of the head is that of the full payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = head if refers_to is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
             f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", "WARC-Date: 1970-01-01T00:00:00Z",
             "WARC-Target-URI: " + re.sub(r"[\r\n]", " ", url), f"WARC-Payload-Digest: sha1:{payload_digest(payload)}"]
    if refers_to is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _write_packages(folder: str, package_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _open_system(folder)
        stream = package = member = None
        path, index, at = "", [], 0

        def close() -> pa.RecordBatch:
            member.close()
            with package.open("indexes/index.cdxj", "w") as out:
                for line in index:
                    out.write(line.encode())
            package.close()
            stream.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [len(index)]})

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                if package is None:  # an attempt's files are its own; only the successful attempt's are in the result
                    name = f"package-{uuid.uuid4().hex}.wacz"
                    path = f"{folder}/{name}"
                    system.create_dir(base, recursive=True)
                    stream = system.open_output_stream(f"{base}/{name}")
                    package = zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED)
                    member = package.open("archive/data.warc.gz", "w", force_zip64=True)
                    index, at = [], 0
                data = _gzip(_record(page_id, url or "", (html or "").encode(), refers_to))
                member.write(data)
                index.append(json.dumps({"url": url, "filename": "data.warc.gz", "offset": at, "length": len(data)}) + "\n")
                at += len(data)
                if at >= package_bytes:
                    yield close()
                    package = None
        if package is not None:
            yield close()

    return write


def write_packages(pages: DataFrame, folder: str, least_bytes: int = 0, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write a record per row of `pages` (page_id, url, html) and return path and records of the packages.

    The payload is the html in UTF-8, a null is empty. Of equal payloads of at least `least_bytes` the one with the
    smallest page_id is a response, the others revisit it; smaller ones are all responses. Rows without a page_id are
    responses, as are further rows with the page_id of a response. An empty table gives no package.
    """
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    payload = F.coalesce("html", F.lit("")).cast("binary")
    digests = stage(pages.select("page_id", F.sha1(payload).alias("digest"))
                    .filter(F.octet_length(payload) >= least_bytes), "payload-digests")
    first = digests.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
    first = first.filter("refers_to < last").select("digest", "refers_to")
    revisits = digests.join(first, "digest").filter("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()
    marked = (pages.withColumn("digest", F.sha1(payload)).join(revisits, ["page_id", "digest"], "left")
              .select("page_id", "url", "html", "refers_to"))
    return stage(marked.mapInArrow(_write_packages(folder, package_bytes), "path string, records long"), "packages")


# Reading

def _read_at(file: pa.NativeFile, at: int, length: int) -> bytes:
    data = file.read_at(length, at)
    if len(data) != length:
        raise ValueError("the package ends early")
    return data


def directory(file: pa.NativeFile) -> dict[str, tuple[int, int, int]]:
    """Member names with compression method, place of their data and stored size, from the central directory."""
    size = file.size()
    tail_at = max(0, size - 65_557)  # the end record and the longest comment
    tail = file.read_at(size - tail_at, tail_at)
    end = tail.rfind(_END)
    while end >= 0 and (len(tail) - end < 22 or struct.unpack_from("<H", tail, end + 20)[0] != len(tail) - end - 22):
        end = tail.rfind(_END, 0, end)  # the comment may hold the same bytes
    if end < 0:
        raise ValueError("not a ZIP package")
    length, begin = struct.unpack_from("<II", tail, end + 12)
    entries = struct.unpack_from("<H", tail, end + 10)[0]
    locator = end - 20
    if 0xFFFFFFFF in (length, begin) or entries == 0xFFFF:
        if locator < 0 or tail[locator:locator + 4] != _LOCATOR64:
            raise ValueError("the 64-bit directory is missing")
        record = _read_at(file, struct.unpack_from("<Q", tail, locator + 8)[0], 56)
        if record[:4] != _END64:
            raise ValueError("the 64-bit directory is missing")
        length, begin = struct.unpack_from("<QQ", record, 40)
    data, at, members = _read_at(file, begin, length), 0, {}
    while at < len(data):
        if data[at:at + 4] != _ENTRY:
            raise ValueError("the directory is damaged")
        method, = struct.unpack_from("<H", data, at + 10)
        packed, full = struct.unpack_from("<II", data, at + 20)
        name_length, extra_length, comment_length = struct.unpack_from("<HHH", data, at + 28)
        local, = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46:at + 46 + name_length].decode("utf-8", "replace")
        extra, x = data[at + 46 + name_length:at + 46 + name_length + extra_length], 0
        while x + 4 <= len(extra):
            tag, n = struct.unpack_from("<HH", extra, x)
            if tag == 1:  # only fields that are full in the entry, in this order
                wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, x + 4))
                full = next(wide) if full == 0xFFFFFFFF else full
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                local = next(wide) if local == 0xFFFFFFFF else local
            x += 4 + n
        head = _read_at(file, local, 30)
        if head[:4] != _LOCAL:
            raise ValueError(f"member {name} is not where the directory says")
        members[name] = method, local + 30 + sum(struct.unpack_from("<HH", head, 26)), packed
        at += 46 + name_length + extra_length + comment_length
    return members


def _lines(file: pa.NativeFile, method: int, at: int, length: int) -> Iterator[bytes]:
    unpacker, rest = zlib.decompressobj(-15) if method else None, b""
    for begin in range(at, at + length, RANGE_BYTES):
        data = _read_at(file, begin, min(RANGE_BYTES, at + length - begin))
        *lines, rest = (rest + (unpacker.decompress(data) if unpacker else data)).split(b"\n")
        yield from lines
    if rest:
        yield rest


def _ranges(path: str) -> Iterator[tuple[str, int, int, bool]]:
    """(path, begin, end, gzip) of stretches of whole records."""
    system, place = _open_system(path)
    with system.open_input_file(place) as file:
        members = directory(file)
        archives = {n.rpartition("/")[2]: m for n, m in members.items() if n.startswith("archive/") and n.endswith((".warc", ".warc.gz"))}
        for name, (method, *_) in archives.items():
            if method:
                raise ValueError(f"member {name} of {path} is compressed by the package; its records have no byte ranges")
        open_ranges: dict[str, tuple[int, int]] = {}
        for name, (method, at, length) in members.items():
            if not name.startswith("indexes/") or not name.endswith((".cdxj", ".cdx")):
                continue
            for line in filter(None, _lines(file, method, at, length)):
                entry = json.loads(line[line.index(b"{"):])  # a sort key and a time may stand before the fields
                archive = entry["filename"]
                begin = archives[archive][1] + int(entry["offset"])
                end = begin + int(entry["length"])
                last = open_ranges.get(archive)
                if last and last[1] == begin and end - last[0] <= RANGE_BYTES:
                    open_ranges[archive] = last[0], end
                else:
                    if last:
                        yield path, *last, archive.endswith(".gz")
                    open_ranges[archive] = begin, end
        for archive, last in open_ranges.items():
            yield path, *last, archive.endswith(".gz")
        for archive, (_, at, length) in archives.items():
            if archive not in open_ranges and length:  # without an index the member is read in one go
                yield path, at, at + length, archive.endswith(".gz")


def _split_records(data: bytes, zipped: bool) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, in lower case, and block of each record."""
    while data:
        if zipped:
            unpacker = zlib.decompressobj(31)
            record = unpacker.decompress(data)
            if not unpacker.eof:
                raise ValueError("a record ends early")
            data = unpacker.unused_data
        else:
            record = data
        head, _, rest = record.partition(b"\r\n\r\n")
        first, *lines = head.decode("utf-8", "replace").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = int(headers["content-length"])
        if len(rest) < length:
            raise ValueError("a record ends early")
        if not zipped:
            data = rest[length + 4:]
        yield headers, rest[:length]


def _page(value: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
    return int(found[1]) if found else None


_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def read_packages(packages: DataFrame, payloads: bool = True) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload of all responses and revisits.

    `packages` has the column path. Size and digest are those of the full payload, also of revisits, whose payload is
    null, as all are without `payloads`. A response whose payload does not have its digest is an error, as are files that
    are no packages and members that the package compresses. Null paths are left out; an empty list gives no record.
    """
    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                columns = list(zip(*_ranges(path), strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    columns, (pa.string(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], ["path", "begin", "end", "zipped"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, begin, end, zipped in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                system, place = _open_system(path)
                with system.open_input_file(place) as file:
                    data = _read_at(file, begin, end - begin)
                rows = []
                for headers, block in _split_records(data, zipped):
                    kind = headers.get("warc-type")
                    if kind not in ("response", "revisit"):
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    length = len(payload)
                    if kind == "revisit":
                        length, payload = int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)[1]), None
                    elif payload_digest(payload) != digest:
                        raise ValueError(f"a payload in {path} does not have its digest")
                    rows.append((_page(headers["warc-record-id"]), headers.get("warc-target-uri"), kind,
                                 _page(headers.get("warc-refers-to")), length, digest, payload if payloads else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(list(zip(*rows, strict=True)) or [()] * len(_RECORD), _RECORD, strict=True)], schema=_RECORD)

    # Names and ranges are a few bytes each, what they stand for is not: tasks are counted by that
    paths = stage(packages.filter("path IS NOT NULL").select("path"), "package-names")
    tasks = max(1, -(-paths.count() // PACKAGES_A_TASK))
    ranges = stage(paths.repartition(tasks, "path").mapInArrow(
        locate, "path string, begin long, end long, zipped boolean"), "package-ranges")
    size = ranges.agg(F.coalesce(F.sum(F.col("end") - F.col("begin")), F.lit(0))).first()[0]
    tasks = max(1, -(-size // (RANGES_A_TASK * RANGE_BYTES)))
    return ranges.repartition(tasks, "path", "begin").mapInArrow(
        read, "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary")


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages to packages in the shared folder and read the records back."""
    packages = write_packages(pages, staging_path(spark, "web-packages"))
    return read_packages(packages, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
