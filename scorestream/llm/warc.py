"""Web archive records inside ZIP files, read by ranges.

Writing: tasks stream gzip-compressed records into stored members of ZIP files
in the shared folder, each member followed by an index member with one line per
record.  A file carries the name of one task attempt, and only files named by
attempts that succeeded are listed, so that retries leave no double records.

Reading: the end record, its ZIP64 form and the central directory are parsed;
stored members are located through their local headers; index members give the
range of every record; records are then read by ranges, nothing is extracted.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorestream.workspace import materialize, scratch_path

MEMBER_BYTES = 16 << 20
ARCHIVE_BYTES = 256 << 20
RANGE_BYTES = 4 << 20
PIECE = 1 << 20

# Fixed values of the published ZIP format: signatures, sizes and the ZIP64 field's tag.
END, END_SIZE, LONGEST_COMMENT = b"PK\x05\x06", 22, 65_535
END64_LOCATOR, END64_LOCATOR_SIZE = b"PK\x06\x07", 20
END64 = b"PK\x06\x06"
ENTRY, ENTRY_SIZE = b"PK\x01\x02", 46
LOCAL, LOCAL_SIZE = b"PK\x03\x04", 30
ZIP64_TAG, FULL16, FULL32 = 1, 0xFFFF, 0xFFFFFFFF


class Member(NamedTuple):
    name: str
    start: int
    size: int


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a location that driver and executors share."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def directory_bounds(file, size: int) -> tuple[int, int, int]:
    """Where the central directory begins, how long it is and how many entries it has."""
    tail_start = max(0, size - END_SIZE - LONGEST_COMMENT)
    tail = file.read_at(size - tail_start, tail_start)
    at = tail.rfind(END)
    while at >= 0:
        end = tail[at : at + END_SIZE]
        if len(end) == END_SIZE and at + END_SIZE + struct.unpack_from("<H", end, 20)[0] == len(tail):
            break
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end record: not a ZIP archive")
    entries, length, start = struct.unpack_from("<HII", end, 10)
    if entries == FULL16 or FULL32 in (length, start):
        locator_at = tail_start + at - END64_LOCATOR_SIZE
        locator = file.read_at(END64_LOCATOR_SIZE, locator_at) if locator_at >= 0 else b""
        if locator[:4] == END64_LOCATOR:
            (end64_at,) = struct.unpack_from("<Q", locator, 8)
            end64 = file.read_at(56, end64_at)
            if end64[:4] != END64:
                raise ValueError("broken ZIP64 end record")
            entries, length, start = struct.unpack_from("<QQQ", end64, 32)
    return start, length, entries


def _wide_fields(extra: bytes, values: list[int]) -> list[int]:
    """Values that did not fit 32 bits, from the ZIP64 field, in the order of the format."""
    at = 0
    while at + 4 <= len(extra):
        tag, size = struct.unpack_from("<HH", extra, at)
        if tag == ZIP64_TAG:
            wide = iter(struct.unpack_from(f"<{size // 8}Q", extra, at + 4))
            return [next(wide) if value == FULL32 else value for value in values]
        at += 4 + size
    return values


def stored_members(file) -> Iterator[Member]:
    """Stored, unencrypted members of an open archive, in the directory's order.

    The directory is read piece by piece; compressed members are passed over,
    since no range of theirs can be read.
    """
    size = file.size()
    at, length, entries = directory_bounds(file, size)
    end, held = at + length, b""
    for _ in range(entries):
        while len(held) < ENTRY_SIZE or len(held) < ENTRY_SIZE + sum(struct.unpack_from("<HHH", held, 28)):
            more = file.read_at(min(PIECE, end - at), at)
            if not more:
                raise ValueError("central directory ends early")
            held, at = held + more, at + len(more)
        if held[:4] != ENTRY:
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", held, 8)
        packed, full = struct.unpack_from("<II", held, 20)
        name_size, extra_size, note_size = struct.unpack_from("<HHH", held, 28)
        (local_at,) = struct.unpack_from("<I", held, 42)
        name = held[ENTRY_SIZE : ENTRY_SIZE + name_size]
        extra = held[ENTRY_SIZE + name_size : ENTRY_SIZE + name_size + extra_size]
        held = held[ENTRY_SIZE + name_size + extra_size + note_size :]
        full, packed, local_at = _wide_fields(extra, [full, packed, local_at])
        if method or flags & 1:
            continue
        local = file.read_at(LOCAL_SIZE, local_at)
        if local[:4] != LOCAL:
            raise ValueError("broken local header")
        skip = sum(struct.unpack_from("<HH", local, 26))
        yield Member(name.decode("utf-8", "replace"), local_at + LOCAL_SIZE + skip, full)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record_bytes(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One record; a revisit keeps the response's headers and leaves its payload out."""
    name = "" if page_id is None else page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode("ascii") + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "WARC-Target-URI: " + (url or "").replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines.insert(2, f"WARC-Refers-To: <urn:page:{refers_to}>")
        lines.insert(3, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join([*lines, "", ""]).encode("utf-8") + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by lower-case name, and payload of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record begins here")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    block = rest[: int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


class ArchiveWriter:
    """Streams records into stored members of ZIP files, beginning new ones at the given sizes."""

    def __init__(self, folder: str, member_bytes: int = MEMBER_BYTES, archive_bytes: int = ARCHIVE_BYTES):
        self.folder, self.member_bytes, self.archive_bytes = folder, member_bytes, archive_bytes
        self.archives: list[tuple[str, int]] = []
        self.zip = self.member = None

    def _begin(self) -> None:
        if self.zip is None:
            self.uri = f"{self.folder}/{uuid.uuid4().hex}.zip"
            store, path = open_store(self.uri)
            store.create_dir(path.rpartition("/")[0], recursive=True)
            self.stream = store.open_output_stream(path, compression=None)
            self.zip = zipfile.ZipFile(self.stream, "w", zipfile.ZIP_STORED, allowZip64=True)
            self.written = self.records = self.members = 0
        self.member = self.zip.open(f"records-{self.members:05d}.warc.gz", "w", force_zip64=True)
        self.lines: list[str] = []
        self.at = 0

    def add(self, record: bytes, entry: dict) -> None:
        if self.member is None:
            self._begin()
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        packed = packer.compress(record) + packer.flush()
        self.member.write(packed)
        self.lines.append(json.dumps(entry | {"offset": self.at, "length": len(packed)}))
        self.at += len(packed)
        self.records += 1
        if self.at >= self.member_bytes:
            self._end_member()
            if self.written >= self.archive_bytes:
                self.close()

    def _end_member(self) -> None:
        if self.member is not None:
            self.member.close()
            index = "".join(line + "\n" for line in self.lines).encode("utf-8")
            self.zip.writestr(f"records-{self.members:05d}.cdxj", index)
            self.written += self.at + len(index)
            self.members += 1
            self.member = None

    def close(self) -> None:
        self._end_member()
        if self.zip is not None:
            self.zip.close()
            self.stream.close()
            self.archives.append((self.uri, self.records))
            self.zip = None


def member_ranges(file, member: Member) -> Iterator[tuple[int, int]]:
    """Offset and length of each gzip-compressed record of a member without an index."""
    at, end = member.start, member.start + member.size
    begin, packer = at, zlib.decompressobj(31)
    while at < end:
        piece = file.read_at(min(PIECE, end - at), at)
        at += len(piece)
        while piece:
            packer.decompress(piece)
            piece = b""
            if packer.eof:
                piece = packer.unused_data
                stop = at - len(piece)
                yield begin, stop - begin
                begin, packer = stop, zlib.decompressobj(31)


def record_ranges(uri: str) -> Iterator[tuple[int, int]]:
    """Absolute offset and length of each record of an archive, through its indexes where it has them."""
    store, path = open_store(uri)
    with store.open_input_file(path) as file:
        members = {m.name: m for m in stored_members(file)}
        for name, member in members.items():
            if not name.endswith(".warc.gz"):
                continue
            index = members.get(name.removesuffix(".warc.gz") + ".cdxj")
            if index is None:
                yield from member_ranges(file, member)
                continue
            for line in file.read_at(index.size, index.start).splitlines():
                entry = json.loads(line)
                yield member.start + entry["offset"], entry["length"]


def _qualified(spark: SparkSession, path: str) -> str:
    """The location with its scheme, so that executors resolve it as the driver does."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write (page_id, url, payload) rows as records; (archive, records) of each file.

    Of rows with equal payloads of at least ``least_bytes`` those with the
    smallest id are responses, the others revisits of it; smaller payloads are
    all responses.  A null payload is empty.  Repeated rows with the smallest id
    are each a response; a null id comes after every other.
    """
    rows = pages.select("page_id", "url", F.coalesce("payload", F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    lowest = rows.groupBy("sha1").agg(F.min("page_id").alias("first_id"))
    rows = rows.join(lowest, "sha1").select(
        "page_id",
        "url",
        "payload",
        "first_id",
        ((F.octet_length("payload") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id"))).alias("revisit"),
    )
    target = _qualified(pages.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = ArchiveWriter(target)
        for batch in batches:
            for row in zip(*(batch.column(name) for name in ("page_id", "url", "payload", "first_id", "revisit"))):
                page_id, url, payload, first_id, revisit = (value.as_py() for value in row)
                digest = base32_sha1(payload)
                record = record_bytes(page_id, url, payload, digest, first_id, revisit)
                writer.add(record, {"page_id": page_id, "type": "revisit" if revisit else "response", "sha1": digest})
        writer.close()
        yield pa.RecordBatch.from_pydict(
            {
                "archive": pa.array([uri for uri, _ in writer.archives], pa.string()),
                "records": pa.array([n for _, n in writer.archives], pa.int64()),
            }
        )

    return materialize(rows.mapInArrow(write, "archive string, records long"), "archives")


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("archive").to_pylist():
            found = list(record_ranges(uri))
            yield pa.RecordBatch.from_pydict(
                {
                    "archive": pa.array([uri] * len(found), pa.string()),
                    "at": pa.array([at for at, _ in found], pa.int64()),
                    "length": pa.array([length for _, length in found], pa.int64()),
                }
            )


RECORD = "page_id long, url string, record_type string, refers_to long, header_digest string"
WHOLE = f"{RECORD}, payload binary"
DIGESTED = f"{RECORD}, payload_bytes long, payload_digest string"


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _read(batches: Iterator[pa.RecordBatch], digests: bool) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    kinds += [pa.int64(), pa.string()] if digests else [pa.binary()]
    names = [part.split()[0] for part in (DIGESTED if digests else WHOLE).split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    uri, file = None, None
    for batch in batches:
        rows, held = [], 0
        for archive, at, length in zip(*(batch.column(name).to_pylist() for name in ("archive", "at", "length"))):
            if archive != uri:
                store, path = open_store(archive)
                uri, file = archive, store.open_input_file(path)
            headers, payload = parse_record(zlib.decompress(file.read_at(length, at), 31))
            told = headers["warc-payload-digest"].removeprefix("sha1:")
            kind = headers["warc-type"]
            digest = base32_sha1(payload)
            if kind == "response" and digest != told:
                raise ValueError(f"payload of {headers['warc-record-id']} does not have its digest")
            record = (
                _page(headers["warc-record-id"]),
                headers["warc-target-uri"],
                kind,
                _page(headers.get("warc-refers-to")),
                told,
            )
            rows.append(record + ((len(payload), digest) if digests else (payload,)))
            held += 0 if digests else len(payload)
            if held >= RANGE_BYTES:
                yield batch_of(rows)
                rows, held = [], 0
        if rows:
            yield batch_of(rows)


def read_archives(archives: DataFrame, digests: bool = False, tasks: int | None = None) -> DataFrame:
    """Records of the archives listed in column ``archive``: with payloads, or their lengths and digests.

    Archives are dealt to tasks for their directories, then ranges are dealt
    anew, so that one large archive is read by many tasks.  A response whose
    payload does not have the digest in its header is an error.
    """
    tasks = tasks or int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = archives.select("archive").repartition(tasks).mapInArrow(_ranges, "archive string, at long, length long")
    ranges = ranges.repartition(tasks, "archive", F.floor(F.col("at") / RANGE_BYTES))
    ranges = ranges.sortWithinPartitions("archive", "at")
    return ranges.mapInArrow(lambda batches: _read(batches, digests), DIGESTED if digests else WHOLE)


def archive_round_trip(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", least_bytes: int = 0
) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) read back from archives.

    Length and digest of a response are those of the payload that was read; a
    revisit has those of the responses with the digest it names.
    """
    rows = pages.select(
        F.col(id_column).alias("page_id"), F.col(url_column).alias("url"), F.encode(html_column, "UTF-8").alias("payload")
    )
    archives = write_archives(rows, scratch_path(pages.sparkSession, "warc"), least_bytes)
    records = materialize(read_archives(archives, digests=True), "warc-records")
    responses = records.where(F.col("record_type") == "response")
    full = responses.groupBy("payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    revisits = (
        records.where(F.col("record_type") == "revisit")
        .drop("payload_bytes", "payload_digest")
        .join(full, F.col("header_digest") == F.col("payload_digest"))
    )
    wanted = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(wanted).union(revisits.select(wanted))
