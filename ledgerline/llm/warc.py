"""WARC records in ZIP-packaged archives: written by tasks, read by range.

An archive is a ZIP file that stores, without compressing them again, a member
``archive/data.warc.gz`` (one gzip member for each record) and an index
``indexes/index.cdxj`` with the place of each record. A reader parses the end of the
file, the central directory and, where present, their ZIP64 forms, finds the stored
members and the index, and then reads the bytes of single records; nothing is unpacked
to disk. Records are dealt out to tasks by their places, not by archive.

Each task writes archives of bounded size under names that no other attempt uses and
returns the names; a lost or repeated attempt leaves a file that nothing refers to.
Files lie in the folder that all executors share, through ``pyarrow.fs``.

Defined results: a null payload is an empty one, a null url an empty one; line ends in a
url are percent-encoded. Records with
equal payloads of at least ``LEAST_REVISIT`` bytes are revisits of the one with the
smallest page_id; without any page_id in such a group all are responses. Rows that
repeat with their page_id are records each. An empty table gives no archive.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, read, scratch_path

LEAST_REVISIT = 100
#: An archive is closed after so many bytes or records, whichever is reached first.
ARCHIVE_BYTES, ARCHIVE_RECORDS = 256_000_000, 100_000
#: Archived bytes that a reading task gets.
TASK_BYTES = 64_000_000
#: More payloads with copies than this are joined by a shuffle.
BROADCAST_GROUPS = 100_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# Writing


def with_types(pages: DataFrame) -> DataFrame:
    """page_id, url, html, digest, record_type and refers_to of each row."""
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html")).withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256))
    groups = rows.filter(F.octet_length("html") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = materialise(groups.filter("n > 1 and first is not null").select("digest", "first"))
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(groups, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to")
    )


def record(page_id, url: str, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC record, gzipped."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if kind == "response" else head
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {url}".replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_archives(typed: DataFrame, folder: str) -> DataFrame:
    """Writes ``with_types`` rows to archives under ``folder``; a row (path, bytes) for each."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        rows = (row for batch in batches for row in zip(*(batch.column(c) for c in range(6)), strict=True))
        row = next(rows, None)
        while row is not None:
            path = f"{root}/{uuid.uuid4().hex}.wacz"
            index, at = [], 0
            with store.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as archive:
                with archive.open("archive/data.warc.gz", "w", force_zip64=True) as member:
                    while row is not None and at < ARCHIVE_BYTES and len(index) < ARCHIVE_RECORDS:
                        page_id, url, html, digest, kind, refers_to = (x.as_py() for x in row)
                        made = record(page_id, url, html.encode(), digest, kind, refers_to)
                        member.write(made)
                        index.append(f"{(url.split('://')[-1].split() or ['-'])[0]} 20240101000000 {json.dumps({'url': url, 'filename': 'data.warc.gz', 'offset': str(at), 'length': str(len(made))})}\n")
                        at += len(made)
                        row = next(rows, None)
                archive.writestr("indexes/index.cdxj", "".join(sorted(index)))
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [at]})

    return materialise(typed.select("page_id", "url", "html", "digest", "record_type", "refers_to").mapInArrow(write, "path string, bytes bigint"))


# Reading

Read = Callable[[int, int], bytes]


def end_of_directory(read: Read, size: int) -> tuple[int, int, int]:
    """Where the central directory starts, its length, and what to add to its offsets
    (not 0 if something stands before the archive)."""
    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    at = len(tail)
    while True:
        at = tail.rfind(b"PK\5\6", 0, at)
        if at < 0:
            raise ValueError("no end of central directory: not a ZIP file")
        if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
            break
    disk, start_disk, here, entries, length, offset, _ = struct.unpack_from("<4H2LH", tail, at + 4)
    end = tail_at + at
    if 0xFFFF in (disk, start_disk, here, entries) or 0xFFFFFFFF in (length, offset):
        locator = read(end - 20, 20) if end >= 20 else b""
        if locator[:4] == b"PK\6\7":
            _, where, _ = struct.unpack_from("<LQL", locator, 4)
            body = read(where, 56)
            if body[:4] != b"PK\6\6":  # something stands before the archive
                where = end - 20 - 56
                body = read(where, 56)
            if body[:4] != b"PK\6\6":
                raise ValueError("no ZIP64 end of central directory")
            disk, start_disk, _, _, length, offset = struct.unpack_from("<2L4Q", body, 16)
            end = where
    if disk or start_disk:
        raise ValueError("archives of several disks are not supported")
    if end - length < 0:
        raise ValueError("the central directory is cut off")
    return end - length, length, end - length - offset


def members(read: Read, size: int) -> Iterator[tuple[str, int, int, int, int]]:
    """Name, method, place of the data, packed and plain size of each member."""
    start, length, shift = end_of_directory(read, size)
    at, buffer, base = 0, b"", 0
    while at < length:
        if at - base + 46 > len(buffer) or at - base + 46 + sum(struct.unpack_from("<3H", buffer, at - base + 28)) > len(buffer):
            buffer, base = read(start + at, min(1_000_000, length - at)), at
        if buffer[at - base : at - base + 4] != b"PK\1\2":
            raise ValueError("a broken central directory")
        flags, method = struct.unpack_from("<2H", buffer, at - base + 8)
        packed, plain, n, x, c = struct.unpack_from("<2L3H", buffer, at - base + 20)
        (local,) = struct.unpack_from("<L", buffer, at - base + 42)
        name = buffer[at - base + 46 : at - base + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra = buffer[at - base + 46 + n : at - base + 46 + n + x]
        while len(extra) >= 4:
            tag, width = struct.unpack_from("<2H", extra)
            if tag == 1:  # ZIP64: only the fields that don't fit, in this order
                needed = (plain, packed, local).count(0xFFFFFFFF)
                if width > len(extra) - 4 or width < 8 * needed:
                    raise ValueError(f"the ZIP64 field of {name} is cut off")
                values = iter(struct.unpack_from(f"<{needed}Q", extra, 4))
                plain, packed, local = (next(values) if v == 0xFFFFFFFF else v for v in (plain, packed, local))
            extra = extra[4 + width :]
        if flags & 1:
            raise ValueError(f"{name} is encrypted")
        head = read(local + shift, 30)
        if head[:4] != b"PK\3\4":
            raise ValueError(f"{name} has no local header")
        yield name, method, local + shift + 30 + sum(struct.unpack_from("<2H", head, 26)), packed, plain
        at += 46 + n + x + c


def places(read: Read, size: int) -> Iterator[tuple[int, int]]:
    """Place and length of each record of an archive, by its indexes; members of an
    archive without an index are walked through."""
    found = list(members(read, size))
    stores = {}
    for name, method, at, packed, _ in found:
        if name.startswith("archive/") and name.endswith((".warc", ".warc.gz")):
            if method:
                raise ValueError(f"{name} is not stored, so its records can't be read by range")
            stores[name.removeprefix("archive/")] = (at, packed)
    indexed = set()
    for name, method, at, packed, _ in found:
        if name.startswith("indexes/") and name.endswith((".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz")):
            for line in _lines(read, at, packed, method, name.endswith(".gz")):
                where = json.loads(line[line.index(b"{") :])
                base, length = stores[where["filename"]]
                if int(where["offset"]) + int(where["length"]) > length:
                    raise ValueError(f"{name} points beyond {where['filename']}")
                indexed.add(where["filename"])
                yield base + int(where["offset"]), int(where["length"])
    for name, (at, length) in stores.items():
        if name not in indexed and name.endswith(".gz"):
            yield from _walk(read, at, length)


def _parts(read: Read, at: int, length: int, width: int = 1_000_000) -> Iterator[bytes]:
    for k in range(0, length, width):
        yield read(at + k, min(width, length - k))


def _lines(read: Read, at: int, packed: int, method: int, gzipped: bool) -> Iterator[bytes]:
    deflated = zlib.decompressobj(-15) if method == 8 else None
    unzip = zlib.decompressobj(47) if gzipped else None
    left = b""
    for part in _parts(read, at, packed):
        part = deflated.decompress(part) if deflated else part
        *full, left = (left + (unzip.decompress(part) if unzip else part)).split(b"\n")
        yield from (x for x in full if x.strip())
    if left.strip():
        yield left


def _walk(read: Read, at: int, length: int) -> Iterator[tuple[int, int]]:
    begin, passed, unzip = 0, 0, zlib.decompressobj(31)
    for part in _parts(read, at, length):
        while part:
            unzip.decompress(part)
            rest = unzip.unused_data
            passed += len(part) - len(rest)
            if unzip.eof:
                yield at + begin, passed - begin
                begin, unzip = passed, zlib.decompressobj(31)
            part = rest


def parse(raw: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of a record."""
    plain = zlib.decompress(raw, 47) if raw[:2] == b"\x1f\x8b" else raw
    head, _, rest = plain.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:])}
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest, kind = fields["warc-payload-digest"].removeprefix("sha256:"), fields["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['warc-record-id']} doesn't match its digest")

    def number(urn: str | None) -> int | None:
        digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    return {
        "page_id": number(fields["warc-record-id"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
        "refers_to": number(fields.get("warc-refers-to")), "url": fields["warc-target-uri"], "payload": payload if kind == "response" else None,
    }


def _opened(store: fs.FileSystem, path: str) -> tuple[Read, int]:
    file = store.open_input_file(path)
    return (lambda at, n: file.read_at(n, at)), file.size()


RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def read_archives(archives: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of archives (path, bytes), one row each; with ``payloads`` also url and
    payload (null for a revisit, whose response has it)."""

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                run: list[tuple[int, int]] = []
                for place in places(*_opened(store, path)):
                    run.append(place)
                    if len(run) == 10_000:
                        yield pa.RecordBatch.from_pydict({"path": [path] * len(run), "at": [p[0] for p in run], "length": [p[1] for p in run]})
                        run = []
                if run:
                    yield pa.RecordBatch.from_pydict({"path": [path] * len(run), "at": [p[0] for p in run], "length": [p[1] for p in run]})

    schema = _RECORD.append(pa.field("url", pa.string())).append(pa.field("payload", pa.binary())) if payloads else _RECORD

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        name, reader, rows, held = None, None, [], 0
        for batch in batches:
            for path, at, length in zip(*(batch.column(c).to_pylist() for c in ("path", "at", "length")), strict=True):
                if path != name:
                    name, (reader, _) = path, _opened(store, path)
                rows.append(parse(reader(at, length)))
                held += length if payloads else 100
                if held > 4_000_000:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    found = archives.select("path").mapInArrow(locate, "path string, at bigint, length bigint")
    # Records go to tasks in runs of 4 MB or so. The number of tasks follows the bytes in
    # the archives, of which the few bytes that are shuffled tell nothing.
    total = archives.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    tasks = max(2 * archives.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    dealt = found.repartition(tasks, "path", F.floor(F.col("at") / 4_000_000)).sortWithinPartitions("path", "at")
    return dealt.mapInArrow(fetch, RECORD + ", url string, payload binary" * payloads)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the pages to archives, reads these back and tells what each record is."""
    folder = scratch_path(spark, "warc")
    archives = write_archives(with_types(read(spark, sf_dir, "pages", "page_id", "url", "html")), folder)
    return read_archives(archives, folder)


OP10_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest)
SELECT p.page_id, p.n AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN g.first IS NOT NULL AND p.page_id IS DISTINCT FROM g.first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.first IS NOT NULL AND p.page_id IS DISTINCT FROM g.first THEN g.first END AS refers_to
FROM p LEFT JOIN g ON p.digest = g.digest
"""
