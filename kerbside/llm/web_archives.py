"""Legacy archive converter: ARC files to WARC files.

An ARC file opens with a version block that names the fields of its record headers: version 1 has five,
version 2 ten. Each record is a header line and as many bytes as it declares. The converter reads both
versions, plain or gzipped, and synthesises what WARC adds: record ids, ISO timestamps, record types and
digests. A record whose payload occurs elsewhere becomes a revisit of the response with the largest page id.

Defined results: a null html is an empty payload; a null or blank url is written as ``about:blank``, and
characters that would break a header line are percent-encoded; rows with the same page id are records of
their own, and of equal payloads with equal largest page ids all are responses; a row without page id has
no page header and is never chosen as response while another row can be.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from typing import BinaryIO, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm import files
from kerbside.llm.common import ready, staged
from kerbside.session import scratch_dir

# The header fields of the two ARC versions, in order.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code",
        "Checksum", "Location", "Offset", "Filename", "Archive-length",
    ),
}
WARC_VERSION = b"WARC/1.0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

SPACE_ID = uuid.uuid5(uuid.NAMESPACE_URL, "urn:converted-arc-record")
ARCHIVE_BYTES = 64 << 20  # an archive is closed once it is longer
ARCHIVE_RECORDS = 20_000
LEVEL = 1  # of gzip: each record is a member of its own
CAPTURED = "20240101000000"  # pages carry no time of their own
PAGE_HEADER = "X-Page-Id"


class ArcRecord(NamedTuple):
    fields: dict[str, str]
    block: bytes


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def safe_url(url: str | None) -> str:
    raw = (url or "").strip().encode("utf-8", "surrogatepass")
    return "".join(chr(b) if 33 <= b <= 126 else f"%{b:02X}" for b in raw) or "about:blank"


# ARC

def arc_header(version: int, name: str) -> bytes:
    body = f"{version} 0 converter\n{' '.join(ARC_FIELDS[version])}\n\n".encode()
    rest = "" if version == 1 else f"200 - - 0 {name} "
    return f"filedesc://{name} 0.0.0.0 {CAPTURED} text/plain {rest}{len(body)}\n".encode() + body


def arc_record(version: int, name: str, offset: int, page_id: int | None, url: str | None, payload: bytes) -> bytes:
    page = "" if page_id is None else f"{PAGE_HEADER}: {page_id}\r\n"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{page}Content-Length: {len(payload)}\r\n\r\n".encode()
    middle = "" if version == 1 else f"200 {payload_digest(payload)} - {offset} {name} "
    line = f"{safe_url(url)} 0.0.0.0 {CAPTURED} text/html {middle}{len(head) + len(payload)}\n".encode()
    return b"".join((line, head, payload, b"\n"))


def read_arc(stream: BinaryIO) -> Iterator[ArcRecord]:
    """The records of an ARC file. A damaged header line or a short block is an error, never skipped."""
    line = stream.readline()
    if not line:
        return
    if not line.startswith(b"filedesc://"):
        raise ValueError("no ARC version block")
    body = _exactly(stream, int(line.split()[-1]))
    described = body.split(b"\n")
    version = int(described[0].split()[0])
    names = tuple(described[1].decode().split())
    if ARC_FIELDS.get(version) != names:
        raise ValueError(f"unknown ARC version {version} or fields {names}")
    while line := stream.readline():
        if line == b"\n":
            continue
        values = line.decode().rstrip("\r\n").split(" ")
        if len(values) != len(names):
            raise ValueError(f"{len(values)} fields in an ARC header line of version {version}")
        fields = dict(zip(names, values, strict=True))
        yield ArcRecord(fields, _exactly(stream, int(fields["Archive-length"])))


def _exactly(stream: BinaryIO, length: int) -> bytes:
    data = stream.read(length)
    if len(data) != length:
        raise ValueError("a block is shorter than declared")
    return data


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header (with its blank line) and payload of a block; without a header all is payload."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    end = block.find(b"\r\n\r\n")
    return (block, b"") if end < 0 else (block[: end + 4], block[end + 4 :])


def page_of(head: bytes) -> int | None:
    found = re.search(rb"^X-Page-Id: (-?\d+)\r$", head, re.MULTILINE)
    return int(found[1]) if found else None


# WARC

def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE_ID, f'{page_id}:{digest}')}>"


def warc_date(arc_date: str) -> str:
    """14 digits, or the 12 and 8 digits of older files, as an ISO timestamp."""
    d = arc_date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(arc: ArcRecord, digest: str, revisits: bool, refers_to: int | None) -> bytes:
    """The WARC record for an ARC record: a response with its whole block, or a revisit with the HTTP header."""
    head, _ = split_http(arc.block)
    page = page_of(head)
    block = head if revisits else arc.block
    lines = [
        ("WARC-Type", "revisit" if revisits else "response" if head else "resource"),
        ("WARC-Record-ID", record_id(page, digest)),
        ("WARC-Date", warc_date(arc.fields["Archive-date"])),
        ("WARC-Target-URI", arc.fields["URL"]),
        ("WARC-IP-Address", arc.fields["IP-address"]),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"),
    ]
    if revisits:
        lines += [
            ("WARC-Profile", REVISIT_PROFILE),
            ("WARC-Refers-To", record_id(refers_to, digest)),
            ("X-Refers-To-Page", "" if refers_to is None else str(refers_to)),
        ]
    lines += [
        ("Content-Type", "application/http; msgtype=response" if head else arc.fields["Content-type"]),
        ("Content-Length", str(len(block))),
    ]
    text = "".join(f"{name}: {value}\r\n" for name, value in lines).encode()
    return b"".join((WARC_VERSION, b"\r\n", text, b"\r\n", block, b"\r\n\r\n"))


def read_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of each record; lengths and block digests are checked."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError("no WARC record")
        fields = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(":")
            fields[name] = value.strip()
        block = _exactly(stream, int(fields["Content-Length"]))
        if _exactly(stream, 4) != b"\r\n\r\n":
            raise ValueError("a WARC record does not end where declared")
        if fields.get("WARC-Block-Digest") != f"sha1:{payload_digest(block)}":
            raise ValueError("a WARC block does not match its digest")
        yield fields, block


# Spark jobs

def _member(data: bytes) -> bytes:
    return gzip.compress(data, compresslevel=LEVEL, mtime=0)


ARCHIVES = pa.schema([("path", pa.string()), ("records", pa.int64())])


def _opened(path: str) -> BinaryIO:
    """An archive as a stream of plain bytes."""
    raw = files.open_file(path)
    return gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw


def write_arcs(pages: DataFrame, folder: str, versions: tuple[int, ...] = (1, 2)) -> DataFrame:
    """Writes pages as gzipped ARC files, the versions in turn. Returns the archives: path, records."""
    ready(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, rows = TaskContext.get().partitionId(), 0, _pages(batches)
        row = next(rows, None)
        while row is not None:
            version = versions[(part + made) % len(versions)]
            made += 1
            with files.new_file(folder, ".arc.gz") as (path, stream):
                name = path.rsplit("/", 1)[-1].removesuffix(".gz")
                at = stream.write(_member(arc_header(version, name)))
                records = 0
                while row is not None and at < ARCHIVE_BYTES and records < ARCHIVE_RECORDS:
                    page_id, url, payload = row
                    at += stream.write(_member(arc_record(version, name, at, page_id, url, payload)))
                    records += 1
                    row = next(rows, None)
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [records]}, schema=ARCHIVES)

    return staged(pages.select("page_id", "url", "html").mapInArrow(run, "path string, records bigint"), "arcs")


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str | None, bytes]]:
    for batch in batches:
        for page_id, url, html in zip(*(c for c in batch.columns), strict=True):
            yield page_id.as_py(), url.as_py(), (html.as_py() or "").encode("utf-8", "surrogatepass")


RECORDS = pa.schema([
    ("path", pa.string()), ("nth", pa.int64()), ("page_id", pa.int64()), ("digest", pa.string()), ("bytes", pa.int64()),
])


def _spread(archives: DataFrame) -> DataFrame:
    """One task for each archive; adaptive execution would merge such small rows."""
    return archives.repartition(max(1, archives.count()))


def scan_arcs(archives: DataFrame) -> DataFrame:
    """path, nth (place in its archive), page_id, digest and bytes (of the payload) of every ARC record."""
    ready(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with _opened(path) as stream:
                    for nth, arc in enumerate(read_arc(stream)):
                        head, payload = split_http(arc.block)
                        rows.append((path, nth, page_of(head), payload_digest(payload), len(payload)))
                columns = zip(*rows, strict=True) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind.type) for c, kind in zip(columns, RECORDS, strict=True)], schema=RECORDS
                )

    schema = "path string, nth bigint, page_id bigint, digest string, bytes bigint"
    return staged(_spread(archives.select("path")).mapInArrow(run, schema), "arc-records")


def decide(records: DataFrame, least_bytes: int) -> DataFrame:
    """path, nth, revisits and refers_to of every record.

    The largest page id of a payload is found by a combined aggregation, which is stored, so that only
    exchanges stand below the join: adaptive execution then splits the partition of a payload that a third of all
    records share. Below an aggregation it could not.
    """
    digests = records.filter(F.col("bytes") >= least_bytes).groupBy("digest").agg(F.max("page_id").alias("last"))
    digests = staged(digests, "payloads")
    known = digests.select(F.col("digest").alias("of"), "last", F.lit(True).alias("shared"))
    revisits = F.coalesce(F.col("shared"), F.lit(False)) & ~F.col("page_id").eqNullSafe(F.col("last"))
    return records.join(known, F.col("digest") == F.col("of"), "left").select(
        "path", "nth", revisits.alias("revisits"), F.when(revisits, F.col("last")).alias("refers_to")
    )


def convert(archives: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Converts ARC files to gzipped WARC files, one for one. Returns the archives: path, records.

    Payloads of at least ``least_bytes`` that occur more than once become revisits. The decisions for one
    archive, which holds at most ``ARCHIVE_RECORDS`` records, travel together; payloads are not shuffled.
    """
    decided = decide(scan_arcs(archives), least_bytes)
    wanted = decided.groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("nth", "revisits", "refers_to"))).alias("decisions")
    )
    wanted = staged(wanted, "warc-decisions")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, decisions in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with files.new_file(folder, ".warc.gz") as (made, out), _opened(path) as stream:
                    for arc, choice in zip(read_arc(stream), decisions, strict=True):
                        digest = payload_digest(split_http(arc.block)[1])
                        out.write(_member(warc_record(arc, digest, choice["revisits"], choice["refers_to"])))
                yield pa.RecordBatch.from_pydict({"path": [made], "records": [len(decisions)]}, schema=ARCHIVES)

    return staged(_spread(wanted).mapInArrow(run, "path string, records bigint"), "warcs")


PAGES = pa.schema([
    ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("record_id", pa.string()), ("url", pa.string()), ("date", pa.string()),
])


def read_warcs(archives: DataFrame) -> DataFrame:
    """What WARC files hold, by record. A response's digest is computed from its block and must match."""
    ready(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with _opened(path) as stream:
                    for fields, block in read_warc(stream):
                        head, payload = split_http(block)
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        kind, target = fields["WARC-Type"], fields.get("X-Refers-To-Page")
                        if kind == "revisit":
                            length = int(re.search(rb"^Content-Length: (\d+)\r$", head, re.MULTILINE)[1])
                        elif payload_digest(payload) != digest:
                            raise ValueError("a payload does not match its digest")
                        else:
                            length = len(payload)
                        rows.append((
                            page_of(head), length, digest, kind, int(target) if target else None,
                            fields["WARC-Record-ID"], fields["WARC-Target-URI"], fields["WARC-Date"],
                        ))
                columns = zip(*rows, strict=True) if rows else [[]] * len(PAGES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind.type) for c, kind in zip(columns, PAGES, strict=True)], schema=PAGES
                )

    schema = (
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, record_id string, url string, date string"
    )
    return _spread(archives.select("path")).mapInArrow(run, schema)


def pages_through_archives(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages to ARC files, those to WARC files, and what is read from these."""
    spark = pages.sparkSession
    arcs = write_arcs(pages, scratch_dir(spark, "arc-files"))
    return read_warcs(convert(arcs, scratch_dir(spark, "warc-files"), least_bytes))
