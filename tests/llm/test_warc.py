import base64
import hashlib
import io
import struct
import zipfile

import pyarrow as pa
import pytest

from scorestream.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, sha1 int"


def expected(rows, least=0):
    payloads = [(r[0], (r[2] or "").encode()) for r in rows]
    lowest = {}
    for page, payload in payloads:
        if page is not None:
            lowest[payload] = min(page, lowest.get(payload, page))
    out = []
    for page, payload in payloads:
        first = lowest.get(payload)
        revisit = page != first and len(payload) >= least
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(map(str, out))


ROWS = [
    (3, "http://a/", "same", "x", 1), (1, "http://b/\r\nX: y", "same", "x", 1), (2, None, "same", "x", 1), (4, "http://c/é", "naïve\r\n\r\n<b>", "x", 1),
    (5, "u", None, "x", 1), (6, "u", "", "x", 1), (7, "u", "long " * 200_000, "x", 1), (1, "http://b/", "same", "x", 1), (None, "u", "same", "x", 1), (None, "u", "only here", "x", 1),
]


@pytest.mark.parametrize("least", [0, 5])
def test_pages_come_back_with_their_payloads(spark, least):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    found = warc.archive_round_trip(pages, least_bytes=least).collect()
    assert sorted(str(tuple(r)) for r in found) == expected(ROWS, least)


def test_an_empty_table_gives_no_record(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0


def test_payloads_themselves_are_read_back(spark, tmp_path):
    rows = [(1, "u", b"one"), (2, "v", b"one"), (3, "w", b"\x00\xff" * 10)]
    archives = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, payload binary"), f"file://{tmp_path}/z")
    found = {r["page_id"]: r for r in warc.read_archives(archives).collect()}
    assert bytes(found[1]["payload"]) == b"one" and bytes(found[2]["payload"]) == b""
    assert (found[2]["record_type"], found[2]["refers_to"]) == ("revisit", 1)
    assert bytes(found[3]["payload"]) == b"\x00\xff" * 10 and found[3]["url"] == "w"
    assert archives.groupBy().sum("records").first()[0] == 3


def archive(tmp_path, records, **limits):
    writer = warc.ArchiveWriter(str(tmp_path), **limits)
    for i in range(records):
        body = f"page {i}".encode()
        writer.add(warc.record_bytes(i, "u", body, warc.base32_sha1(body), None, False), {"page_id": i})
    writer.close()
    return writer.archives


def pages_of(uri):
    store, path = warc.open_store(uri)
    with store.open_input_file(path) as file:
        return [
            warc.parse_record(warc.zlib.decompress(file.read_at(length, at), 31))[1] for at, length in warc.record_ranges(uri)
        ]


def test_members_and_archives_are_cut_at_their_sizes(tmp_path):
    made = archive(tmp_path, 200, member_bytes=2_000, archive_bytes=12_000)
    assert len(made) > 1 and sum(n for _, n in made) == 200
    assert sorted(p for uri, _ in made for p in pages_of(uri)) == sorted(f"page {i}".encode() for i in range(200))
    with zipfile.ZipFile(made[0][0]) as plain:
        assert plain.testzip() is None and len(plain.namelist()) > 2


def test_more_members_than_sixteen_bits_count(tmp_path):
    path = tmp_path / "many.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as out:
        for i in range(65_600):
            out.writestr(f"m{i}", b"x")
    with pa.OSFile(str(path)) as file:
        members = list(warc.stored_members(file))
    assert len(members) == 65_600 and members[-1].name == "m65599" and members[-1].size == 1


def test_offsets_and_sizes_from_the_wide_fields():
    extra = struct.pack("<HHI", 7, 4, 1) + struct.pack("<HHQQ", 1, 16, 1 << 33, 1 << 34)
    assert warc._wide_fields(extra, [warc.FULL32, 12, warc.FULL32]) == [1 << 33, 12, 1 << 34]


def test_compressed_members_are_passed_over_and_comments_allowed(tmp_path):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as out:
        out.writestr("packed.txt", b"a" * 100, zipfile.ZIP_DEFLATED)
        out.writestr("plain.txt", b"hello", zipfile.ZIP_STORED)
        out.comment = b"PK\x05\x06 a comment that looks like an end record" * 3
    file = pa.BufferReader(raw.getvalue())
    (member,) = warc.stored_members(file)
    assert member.name == "plain.txt" and file.read_at(member.size, member.start) == b"hello"
    with pytest.raises(ValueError):
        list(warc.stored_members(pa.BufferReader(b"no archive")))


def test_members_without_an_index_are_scanned(tmp_path):
    path = tmp_path / "bare.zip"
    bodies = [b"one", b"two" * 1000, b""]
    packed = [
        warc.zlib.compressobj(6, warc.zlib.DEFLATED, 31) for _ in bodies
    ]
    records = [warc.record_bytes(i, "u", b, warc.base32_sha1(b), None, False) for i, b in enumerate(bodies)]
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as out:
        out.writestr("x.warc.gz", b"".join(p.compress(r) + p.flush() for p, r in zip(packed, records)))
    assert pages_of(str(path)) == bodies
