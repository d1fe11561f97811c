from __future__ import annotations

import gzip
import hashlib

import pytest

from branchyard.llm import arc_archives as A
from branchyard.session import work_folder
from tests.llm.helpers import frame

BIG = "x" * 150
PAGES = [
    (5, "http://a.net/1", BIG), (3, "http://a.net/2", BIG), (3, "http://a.net/2", BIG), (9, None, BIG), (None, "http://a.net/none", BIG), (7, "http://a.net/small", "tiny"), (8, "http://a.net/small2", "tiny"),
    (10, "http://a.net/with space\u2003\n", None), (11, "", ""), (12, "http://é.net/", "é\r\n\r\nWARC/1.0\r\n\nHTTP/1.1 200 OK\r\n\r\n" * 20), (13, "http://long.net/", "y" * 3_000_000), (14, "http://z.net/", "z" * 99), (15, "http://z.net/", "z" * 99),
]


def archived(spark, pages, **options):
    arc, warc = work_folder(spark, "arc"), work_folder(spark, "warc")
    A.write_arc(pages, arc)
    A.convert(spark, arc, warc, **options)
    return A.read_warc(spark, warc)


@pytest.mark.parametrize("parts", [1, 5])
def test_pages_come_back(spark, parts):
    rows = archived(spark, frame(spark, PAGES, "page_id long, url string, html string").repartition(parts)).collect()
    text = {p: (h or "").encode() for p, _, h in PAGES}
    assert sorted(str(r.source_id) for r in rows) == sorted(str(p) for p, _, _ in PAGES)
    for r in rows:
        data = text[r.source_id]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest())
        same = [p for p, _, h in PAGES if p is not None and (h or "").encode() == data]
        first = min(same, default=None)
        revisit = len(data) >= 100 and r.source_id is not None and r.source_id > first
        assert (r.record_type, r.refers_to) == (("revisit", first) if revisit else ("response", None))
        assert r.payload == (b"" if revisit else data)
    by_id = {r.record_id: r for r in rows}
    assert len(by_id) == len(rows) and all(by_id[r.refers_to_record].source_id == r.refers_to for r in rows if r.refers_to is not None)
    assert {r.url for r in rows if r.source_id in (9, 10)} == {"urn:source:9", "http://a.net/with%20space%E2%80%83%0A"}


def test_no_pages(spark):
    assert archived(spark, frame(spark, [], "page_id long, url string, html string")).collect() == []


def arc(version, records):
    about = f"{version} 0 someone\n{A.FIELDS[version]}\n".encode()
    extra = " 200 - - 0 a.arc" if version == 2 else ""
    return f"filedesc://a.arc 0.0.0.0 19970101 text/plain{extra} {len(about)}\n".encode() + about + b"".join(b"\n" + r for r in records)


def test_both_versions_are_read_by_their_declared_lengths():
    http = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\nbody\nwith lines\n"
    one = arc(1, [b"http://a/ 1.2.3.4 19970203040506 text/html %d\n" % len(http) + http, b"dns:a 1.2.3.4 199702 text/dns 3\nabc"])
    two = arc(2, [b"http://a/ 1.2.3.4 19970203040506 text/html 200 sum - 77 a.arc %d\n" % len(http) + http])
    for content in (one, gzip.compress(one)):
        first, second = A.arc_records(content)
        assert (first.url, first.payload, first.source) == ("http://a/", b"body\nwith lines\n", None) and first.head.endswith(b"\r\n\r\n")
        assert (second.head, second.payload, A.iso_date(second.date)) == (b"", b"abc", "1997-02-01T00:00:00Z")
        assert b"WARC-Type: resource" in A.warc_record("a.arc", second, None)
    assert [r.payload for r in A.arc_records(two)] == [b"body\nwith lines\n"]
    with pytest.raises(ValueError, match="fields expected"):
        list(A.arc_records(arc(2, [b"http://a/ 1.2.3.4 19970203040506 text/html 0\n"])))
    with pytest.raises(ValueError, match="ends after"):
        list(A.arc_records(arc(1, [b"http://a/ 1.2.3.4 19970203040506 text/html 9\nabc"])))
