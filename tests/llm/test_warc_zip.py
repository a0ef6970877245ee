import hashlib
import io
import json
import struct
import tempfile
import zipfile

import pytest

from reelstat.llm import warc_zip
from reelstat.llm.warc_zip import (DATA, INDEX, archived_pages, page_records, parse_record, read_archives, record_bytes,
                                   write_archives, zip_members)

SCHEMA = "page_id long, url string, html string, record_type string, payload string, same string"
BIG, LARGE = "é" * 600, "<p>x</p>" * 200


def pages():
    rows = [(1, "http://a.example/ b\r\nc", BIG), (9, "http://a.example/2", BIG), (5, None, BIG), (2, "u", "small"), (3, "u", "small"),
            (4, "u", None), (6, "u", ""), (7, "u", LARGE), (8, "u", LARGE + "!"), (10, "u", "z" * 200_000), (9, "http://a.example/2", BIG),
            (None, "u", BIG), (None, "u", "only nulls " * 100)]
    return [(*r, "a", "b", "c") for r in rows]


def want():
    out, best = [], {}
    for r in pages():
        best[r[2] or ""] = max(best.get(r[2] or "", -1), -1 if r[0] is None else r[0])
    for r in pages():
        data = (r[2] or "").encode()
        revisit = len(data) >= 1000 and best[r[2] or ""] not in (-1, r[0])
        out.append((r[0], len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    best[r[2]] if revisit else None))
    return sorted(out, key=str)


def test_written_and_read_back(spark):
    got = archived_pages(spark, spark.createDataFrame(pages(), SCHEMA).repartition(2))
    rows = got.collect()
    assert sorted(((r["record_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows),
                  key=str) == want()
    texts = {(p[0], (p[2] or "").encode()) for p in pages()}
    for r in rows:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
        assert r["payload"] is None or (r["record_id"], bytes(r["payload"])) in texts
    assert {r["url"] for r in rows if r["record_id"] == 1} == {"http://a.example/%20b%0D%0Ac"}


@pytest.mark.parametrize("indexed", [True, False])
def test_many_small_packages_and_ranges(spark, monkeypatch, indexed):
    folder = tempfile.mkdtemp(prefix="reelstat-warc-")
    manifest = write_archives(page_records(spark.createDataFrame(pages(), SCHEMA)), folder, archive_bytes=700)
    assert manifest.count() > 3
    if not indexed:                                     # packages of other writers may lack the index
        for path in [r["path"] for r in manifest.collect()]:
            with zipfile.ZipFile(path) as old:
                data = old.read(DATA)
            with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as new:
                new.writestr(DATA, data)
    rows = read_archives(manifest, folder, range_bytes=300, task_bytes=500).collect()
    assert sorted(((r["record_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows),
                  key=str) == want()


def reader(data):
    return lambda start, length: data[start:start + length]


def test_directory_with_comment_and_many_members():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for i in range(70_000):                         # more than 16 bits can count: ZIP64 end record
            z.writestr(zipfile.ZipInfo(f"é{i}"), b"")
        z.writestr("last", b"payload", zipfile.ZIP_STORED)
        z.comment = b"PK a comment"
    members = zip_members(reader(out.getvalue()), len(out.getvalue()))
    assert len(members) == 70_001
    method, local, size = members["last"]
    at = warc_zip.member_data(reader(out.getvalue()), local)
    assert method == 0 and out.getvalue()[at:at + size] == b"payload"


def test_zip64_sizes(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)    # writes 64-bit fields as for huge members
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", b"1" * 300)
        z.writestr("b", b"2" * 300)
    data = out.getvalue()
    members = zip_members(reader(data), len(data))
    assert b"PK\x06\x06" in data and [m[2] for m in members.values()] == [300, 300]
    for name, byte in (("a", b"1"), ("b", b"2")):
        at = warc_zip.member_data(reader(data), members[name][1])
        assert data[at:at + 300] == byte * 300


def test_records_round_trip():
    row = {"record_id": 3, "url": "http://x/", "record_type": "response", "payload": b"a\r\n\r\nb", "refers_to": None,
           "payload_digest": hashlib.sha1(b"a\r\n\r\nb").hexdigest()}
    assert parse_record(record_bytes(row, "d")) == row | {"payload_bytes": 6}
    revisit = row | {"record_type": "revisit", "refers_to": 9}
    assert parse_record(record_bytes(revisit, "d")) == revisit | {"payload_bytes": 6, "payload": None}
    with pytest.raises(ValueError):
        parse_record(b"HTTP/1.1 200 OK\r\n\r\n")


def test_comment_that_holds_the_end_signature():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", b"payload")
        z.comment = b"see PK\x05\x06 and PK\x05\x06" + bytes(30)
    assert list(zip_members(reader(out.getvalue()), len(out.getvalue()))) == ["a"]


def test_compressed_index_is_refused(spark, tmp_path):
    manifest = write_archives(page_records(spark.createDataFrame([(1, "u", "x" * 50)], "page_id long, url string, html string")), str(tmp_path))
    path = manifest.first()["path"]
    with zipfile.ZipFile(path) as old:
        members = {i.filename: old.read(i) for i in old.infolist()}
    with zipfile.ZipFile(path, "w") as new:
        for name, data in members.items():
            new.writestr(name, data, zipfile.ZIP_DEFLATED if name == INDEX else zipfile.ZIP_STORED)
    with pytest.raises(Exception, match="is compressed"):
        read_archives(manifest, str(tmp_path)).collect()


def test_not_a_zip():
    with pytest.raises(ValueError):
        zip_members(reader(b"nothing"), 7)


def test_index_lines(spark):
    folder = tempfile.mkdtemp(prefix="reelstat-warc-")
    (path,) = [r["path"] for r in write_archives(page_records(
        spark.createDataFrame(pages(), SCHEMA).coalesce(1)).coalesce(1), folder).collect()]
    with zipfile.ZipFile(path) as z:
        lines = [json.loads(x) for x in z.read(INDEX).decode().splitlines()]
        assert [i.compress_type for i in z.infolist()] == [zipfile.ZIP_STORED] * 2
    assert len(lines) == len(pages()) and lines[0]["offset"] == 0
    assert struct.calcsize("<HII") == 10


def test_empty_table(spark):
    assert archived_pages(spark, spark.createDataFrame([], SCHEMA)).collect() == []
