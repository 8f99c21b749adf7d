"""ARC to WARC: the formats, and pages through files."""

import base64
import gzip
import hashlib
import io

import pytest
from conftest import *  # noqa: F403

from kerbside.llm import web_archives as archives
from kerbside.session import scratch_dir

PAGES = "page_id bigint, url string, html string, path string, records int"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def arc_file(version, pages):
    name = "some.arc"
    return archives.arc_header(version, name) + b"".join(archives.arc_record(version, name, 0, *p) for p in pages)


@pytest.mark.parametrize("version", [1, 2])
def test_arc_records_are_read_by_their_lengths(version):
    # Payloads that look like headers, and line ends of all kinds.
    payloads = [b"", b"\n\nhttp://x 0.0.0.0 20240101000000 text/html 5\nabcde", b"a\r\n\r\nb" * 3]
    data = arc_file(version, [(n, f"http://a/{n}", p) for n, p in enumerate(payloads)])
    for stream in (io.BytesIO(data), gzip.GzipFile(fileobj=io.BytesIO(gzip.compress(data[:50]) + gzip.compress(data[50:])))):
        found = list(archives.read_arc(stream))
        assert [archives.split_http(a.block)[1] for a in found] == payloads
        assert [a.fields["URL"] for a in found] == ["http://a/0", "http://a/1", "http://a/2"]
        assert all(tuple(a.fields) == archives.ARC_FIELDS[version] for a in found)


@pytest.mark.parametrize("damage", [lambda d: d[:-9], lambda d: d[20:], lambda d: d.replace(b"Archive-length", b"Length"), lambda d: d.replace(b"text/html", b"text html")])
def test_damaged_arc_files_are_errors(damage):
    with pytest.raises(ValueError):
        list(archives.read_arc(io.BytesIO(damage(arc_file(1, [(1, "http://a", b"abc")])))))


def test_warc_records():
    arc = next(archives.read_arc(io.BytesIO(arc_file(2, [(7, "http://a b", b"abc")]))))
    name = archives.payload_digest(b"abc")
    data = archives.warc_record(arc, name, False, None) + archives.warc_record(arc, name, True, 9)
    (whole, block), (revisit, short) = archives.read_warc(io.BytesIO(data))
    assert whole["WARC-Type"] == "response" and block == arc.block
    assert whole["WARC-Date"] == "2024-01-01T00:00:00Z" and whole["WARC-Target-URI"] == "http://a%20b"
    assert whole["WARC-Payload-Digest"] == "sha1:" + digest("abc")
    assert revisit["WARC-Type"] == "revisit" and short == archives.split_http(arc.block)[0]
    # The record referred to has just this id.
    assert revisit["WARC-Refers-To"] == archives.record_id(9, name) != whole["WARC-Record-ID"]
    with pytest.raises(ValueError):
        list(archives.read_warc(io.BytesIO(data.replace(b"charset", b"CHARSET"))))


ROWS = [
    (1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, "<p>x</p>"), (4, "", None), (5, "http://c\nd", ""),
    (6, "http://ü", "ü漢" * 10), (None, "http://n", "<p>x</p>"), (None, None, "alone"), (8, "u", "z" * 300_000), (9, "u", "twice"), (9, "u", "twice"),
]


def plain(rows, least):
    last = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= least:
            last[html or ""] = max(page, last.get(html or "", page))
    out = []
    for page, _, html in rows:
        text = html or ""
        shared = len(text.encode()) >= least and last.get(text) != page
        refers = last.get(text) if shared else None
        out.append((page, len(text.encode()), digest(html), "revisit" if shared and text in last else "response", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 6])
def test_pages_through_archives(spark, least):
    pages = spark.createDataFrame([(*r, "extra", 1) for r in ROWS], PAGES).repartition(3)
    found = archives.pages_through_archives(pages, least).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str)
    assert got == plain(ROWS, least)


def test_small_archives_and_no_pages(spark, monkeypatch):
    monkeypatch.setattr(archives, "ARCHIVE_RECORDS", 2)
    pages = spark.createDataFrame([(*r, "extra", 1) for r in ROWS], PAGES).coalesce(1)
    arcs = archives.write_arcs(pages, scratch_dir(spark, "arc-files"))
    assert sorted(r.records for r in arcs.collect()) == [1, 2, 2, 2, 2, 2]
    assert archives.pages_through_archives(spark.createDataFrame([], PAGES)).collect() == []


def test_a_payload_of_most_records_is_joined_by_many_tasks(spark):
    """Nothing but exchanges and sorts stands below the join, so that large partitions can be split; they are."""
    records = spark.range(60_000).selectExpr(
        "'a' AS path", "id AS nth", "id AS page_id", "IF(id % 3 > 0, 'same', concat('d', id)) AS digest", "10L AS bytes"
    )
    records = archives.staged(records.repartition(8), "skewed-records")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        decided = archives.decide(records, 0)
        found = {row.nth: row.refers_to for row in decided.collect()}
        text = decided._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "isSkewJoin=true" in text or "skew=true" in text
    last = max(n for n in range(60_000) if n % 3)
    assert found == {n: last if n % 3 and n != last else None for n in range(60_000)}
