"""Web archives (WARC records in ZIP packages), written and range-read by tasks.

An archive is a ZIP file whose members are *stored*: ``archive/data.warc.gz`` holds
one gzip member per record, ``indexes/index.cdxj`` one JSON line per record with its
offset and length.  The reader opens a package at its end, parses the central
directory (with the ZIP64 records where sizes or counts need them), finds the data
of the stored members and reads records by byte range, without extracting anything.
A package without an index is scanned from record to record.

A writing task gives its packages names of its own attempt and reports them; the
reported names are a written table (the manifest), so packages of lost or repeated
tasks are never read.  Packages are read through ``pyarrow.fs``, by ranges that are
dealt to tasks by size.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zipfile
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm.common import stored, text_of
from reelstat.session import shared_dir

#: Bytes after which a task begins its next package.
ARCHIVE_BYTES = 64 << 20
#: Bytes of neighbouring records that one read fetches.
RANGE_BYTES = 1 << 20
#: Bytes that one reading task handles.
TASK_BYTES = 8 << 20
#: Payloads below this size are never deduplicated.
REVISIT_BYTES = 1000

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
MANIFEST = "path string, records long, bytes long"
RANGE = "path string, start long, lengths array<long>"
RECORD = ("record_id long, url string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to long, payload binary")
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- records ---------------------------------------------------------------------------------

def record_bytes(row: dict, date: str) -> bytes:
    """One WARC record: a response with its payload, or a revisit without it."""
    def urn(x):
        return f"<urn:page:{'' if x is None else x}>"

    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(row['payload'])}\r\n\r\n".encode()
    block = http + (b"" if row["record_type"] == "revisit" else row["payload"])
    digest = base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()
    head = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {urn(row['record_id'])}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if row["url"] is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"]))
    if row["record_type"] == "revisit":
        head += [f"WARC-Profile: {IDENTICAL}", f"WARC-Refers-To: {urn(row['refers_to'])}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The row of one record; a response's size and digest come from its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    http, _, payload = rest[:int(fields["content-length"])].partition(b"\r\n\r\n")
    page = lambda x: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", x or "")) else None
    kind = fields["warc-type"]
    if kind == "revisit":
        size = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
        digest, payload = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex(), None
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return {"record_id": page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"), "record_type": kind,
            "payload_bytes": size, "payload_digest": digest, "refers_to": page(fields.get("warc-refers-to")),
            "payload": payload}


# ---- packages --------------------------------------------------------------------------------

def zip_members(read_at, size: int) -> dict[str, tuple[int, int, int]]:
    """Members of a ZIP file: name -> (method, offset of the data, stored size).
    ``read_at(start, length)`` reads bytes."""
    tail_at = max(0, size - 65_557 - 20)            # the end record, its comment, the ZIP64 locator
    tail = read_at(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    # a comment may hold the signature: the record's comment ends the file
    while end >= 0 and tail[end + 20:end + 22] != struct.pack("<H", (len(tail) - end - 22) & 0xFFFF):
        end = tail.rfind(b"PK\x05\x06", 0, end + 3)
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, offset = struct.unpack_from("<HII", tail, end + 10)
    if (count == 0xFFFF or length == 0xFFFFFFFF or offset == 0xFFFFFFFF) and tail[max(0, end - 20):end][:4] == b"PK\x06\x07":
        (at,) = struct.unpack_from("<Q", tail, end - 12)
        record = read_at(at, 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, offset = struct.unpack_from("<QQQ", record, 32)
    directory, at, out = read_at(offset, length), 0, {}
    for _ in range(count):
        if directory[at:at + 4] != b"PK\x01\x02":
            raise ValueError("bad central directory")
        flags, method = struct.unpack_from("<HH", directory, at + 8)
        packed, plain, names, extras, comments = struct.unpack_from("<IIHHH", directory, at + 20)
        (local,) = struct.unpack_from("<I", directory, at + 42)
        raw, extra = directory[at + 46:at + 46 + names], directory[at + 46 + names:at + 46 + names + extras]
        while len(extra) >= 4:
            kind, n = struct.unpack_from("<HH", extra)
            if kind == 1:                           # ZIP64: only the fields that are full, in this order
                wide, field = extra[4:4 + n], 0
                values = []
                for value in (plain, packed, local):
                    if value == 0xFFFFFFFF:
                        (value,) = struct.unpack_from("<Q", wide, field)
                        field += 8
                    values.append(value)
                plain, packed, local = values
            extra = extra[4 + n:]
        name = raw.decode("utf-8" if flags & 0x800 else "cp437")
        out[name] = (method, local, packed)
        at += 46 + names + extras + comments
    return out


def member_data(read_at, local: int) -> int:
    """Where a member's bytes begin, from its local header."""
    header = read_at(local, 30)
    if header[:4] != b"PK\x03\x04":
        raise ValueError("bad local header")
    names, extras = struct.unpack_from("<HH", header, 26)
    return local + 30 + names + extras


def _write(folder: str, date: str, archive_bytes: int):
    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        rows = (row for batch in batches for row in batch.to_pylist())
        row, n = next(rows, None), 0
        while row is not None:
            path = f"{base}/part-{task.partitionId():05d}-{task.taskAttemptId()}-{n:04d}.zip"
            index, at = io.StringIO(), 0
            with store.open_output_stream(path) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
                with package.open(zipfile.ZipInfo(DATA), "w", force_zip64=True) as data:
                    while row is not None and at < archive_bytes:
                        member = gzip.compress(record_bytes(row, date), 6, mtime=0)
                        data.write(member)
                        index.write(json.dumps({"offset": at, "length": len(member), "type": row["record_type"],
                                                "digest": row["payload_digest"], "url": row["url"]}) + "\n")
                        at, row = at + len(member), next(rows, None)
                package.writestr(zipfile.ZipInfo(INDEX), index.getvalue())
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [index.getvalue().count("\n")], "bytes": [at]})
            n += 1
    return run


def write_archives(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z",
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write records (record_id, url, record_type, payload, payload_digest, refers_to) as
    packages in ``folder``; returns the written manifest (path, records, bytes)."""
    columns = ["record_id", "url", "record_type", "payload", "payload_digest", "refers_to"]
    return stored(records.select(*columns).mapInArrow(_write(folder, date, archive_bytes), MANIFEST), "warc-manifest")


def _ranges(folder: str, range_bytes: int):
    """Packages -> runs of neighbouring records, from their indexes."""

    def run(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.open_input_file(path) as file:
                    read_at = lambda start, length: file.read_at(length, start)
                    members = zip_members(read_at, file.size())
                    method, local, size = members[DATA]
                    if method != 0:
                        raise ValueError(f"{path}: {DATA} is compressed; only stored members can be read by range")
                    data = member_data(read_at, local)
                    if INDEX in members:
                        method, at, length = members[INDEX]
                        if method != 0:
                            raise ValueError(f"{path}: {INDEX} is compressed; only stored members can be read by range")
                        lines = read_at(member_data(read_at, at), length).decode().splitlines()
                        places = [(x["offset"], x["length"]) for x in map(json.loads, lines)]
                    else:
                        places = list(_scan(read_at, data, size))
                rows, start, lengths, total = [], 0, [], 0
                for offset, length in places:
                    if lengths and (total + length > range_bytes or offset != start + total):
                        rows.append({"path": path, "start": data + start, "lengths": lengths})
                        lengths, total = [], 0
                    start = start if lengths else offset
                    lengths, total = [*lengths, length], total + length
                if lengths:
                    rows.append({"path": path, "start": data + start, "lengths": lengths})
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                    [("path", pa.string()), ("start", pa.int64()), ("lengths", pa.list_(pa.int64()))]))
    return run


def _scan(read_at, data: int, size: int):
    """Offsets and lengths of the gzip members of a data member without an index."""
    at = 0
    while at < size:
        member, used = zlib.decompressobj(31), 0
        while not member.eof and at + used < size:
            block = read_at(data + at + used, min(1 << 16, size - at - used))
            member.decompress(block)
            used += len(block) - len(member.unused_data)
        yield at, used
        at += used


def _fetch(folder: str):
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in RECORD.split(", "))])

    def run(batches):
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with store.open_input_file(r["path"]) as file:
                    data, at, rows = file.read_at(sum(r["lengths"]), r["start"]), 0, []
                for n in r["lengths"]:
                    rows.append(parse_record(gzip.decompress(data[at:at + n])))
                    at += n
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def read_archives(manifest: DataFrame, folder: str, range_bytes: int = RANGE_BYTES,
                  task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records of the manifest's packages, as rows of RECORD (payload is null for revisits)."""
    total = manifest.agg(F.sum("bytes")).first()[0] or 0
    ranges = manifest.select("path").mapInArrow(_ranges(folder, range_bytes), RANGE)
    return ranges.repartition(max(1, -(-total // task_bytes)), "path", "start").mapInArrow(_fetch(folder), RECORD)


# ---- pages -----------------------------------------------------------------------------------

def page_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """A record per page: of equal payloads of at least ``revisit_bytes`` the one with the
    largest id is the response, the others revisit it.

    Null html is an empty payload.  A null id is smaller than any other; rows that
    repeat the largest id with the same payload are all responses.  A null url gives
    a record without target.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("record_id"), F.col(url_col).cast("string").alias("url"),
                        text_of(html_col).cast("binary").alias("payload")).withColumns(
        {"payload_digest": F.sha1("payload"), "same": F.when(F.octet_length("payload") >= revisit_bytes, F.sha2("payload", 256))})
    groups = rows.where(F.col("same").isNotNull()).groupBy("same").agg(
        F.max("record_id").alias("largest"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    # written, so that the join has exchanges of its own and splits a hot payload; small pages
    # have no key and stay out of it
    joined = rows.where(F.col("same").isNotNull()).join(stored(groups, "warc-groups"), "same", "left").unionByName(
        rows.where(F.col("same").isNull()).withColumn("largest", F.lit(None).cast("long")))
    revisit = F.col("largest").isNotNull() & ~F.col("largest").eqNullSafe(F.col("record_id"))
    return joined.select("record_id", "url", "payload", "payload_digest",
                         F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("largest")).alias("refers_to"))


def archived_pages(spark: SparkSession, pages: DataFrame, folder: str | None = None, **columns) -> DataFrame:
    """Write all pages as packages in ``folder`` (default: a new one in the shared
    checkpoint directory) and read them back.  An empty table writes no package and
    gives an empty result; other columns are not read."""
    folder = folder or shared_dir(spark, f"llm/warc-{uuid.uuid4().hex}")
    return read_archives(write_archives(page_records(pages, **columns), folder), folder)
