import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import queries
from tessera.llm import warc as W
from tessera.llm.warc import arc_records, convert, iso_date, read_arc, read_warc, record_id, resolved, warc_record, warc_records, write_arc
from tests.llm.helpers import rows_of

SCHEMA = "page_id long, url string, html string"
V1_BLOCK = b"1 0 Someone\nURL IP-address Archive-date Content-type Archive-length\n"
V1 = b"filedesc://old.arc 0.0.0.0 19960923142103 text/plain %d\n" % len(V1_BLOCK) + V1_BLOCK + b"\n"


def sha(data):
    return hashlib.sha256(data).hexdigest()


def arc1(*records):
    out = V1
    for url, date, mime, body in records:
        out += f"{url} 1.2.3.4 {date} {mime} {len(body)}\n".encode() + body + b"\n"
    return out


def arc2(*records):
    block = b"2 0 Someone\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    out = f"filedesc://new.arc 0.0.0.0 20010101 text/plain 200 - - 0 new.arc {len(block)}\n".encode() + block + b"\n"
    for url, date, mime, body in records:
        out += f"{url} 1.2.3.4 {date} {mime} 200 abc - {len(out)} new.arc {len(body)}\n".encode() + body + b"\n"
    return out


def test_header_lines_of_both_versions():
    http = b"HTTP/1.0 200 OK\nContent-Type: text/html\n\n<p>\n\nhttp://x 1 2 3 4\n</p>"
    rows = [("http://a/b c d", "19970101", "text/html", http), ("dns:a", "1997", "text/dns", b"a. 5 IN A 1.2.3.4"), ("http://a/empty", "bad", "-", b"")]
    for data, archive, since in ((arc1(*rows), "old.arc", "1996-09-23T14:21:03Z"), (arc2(*rows), "new.arc", "2001-01-01T00:00:00Z")):
        found = list(arc_records(data))
        assert [r["kind"] for r in found] == ["warcinfo", "response", "resource", "resource"]
        assert {r["archive"] for r in found} == {archive}
        assert found[1]["url"] == "http://a/b c d" and found[1]["payload"] == b"<p>\n\nhttp://x 1 2 3 4\n</p>" and found[1]["mime"] == "text/html"
        assert [r["date"] for r in found[1:]] == ["1997-01-01T00:00:00Z", "1997-01-01T00:00:00Z", since]
        assert data[found[1]["offset"]:].startswith(b"http://a/b c d ")
        assert found[3]["payload"] == b""


@pytest.mark.parametrize("tail", [b"http://x 1.2.3.4 19970101 text/html 99999\nshort", b"http://x 1.2.3.4 19970101 text/html many\nx", b"nonsense\n"])
def test_damaged_rest_of_an_archive(tail):
    found = list(arc_records(arc1(("http://a", "1997", "text/plain", b"whole")) + tail))
    assert [r["kind"] for r in found] == ["warcinfo", "resource", "damaged"] and found[-1]["payload"] == tail


def test_dates_and_identifiers():
    assert iso_date("20240229235959") == "2024-02-29T23:59:59Z" and iso_date("1996") == "1996-01-01T00:00:00Z" and iso_date("199613") is None and iso_date("x") is None
    assert record_id("a.arc", 7) == record_id("a.arc", 7) != record_id("a.arc", 8) and record_id("a", 1).startswith("<urn:uuid:")


def test_warc_record_round_trip():
    r = {"kind": "response", "record_id": record_id("a", 1), "url": "http://é/", "ip": "-", "date": "1996-01-01T00:00:00Z", "mime": "x", "digest": sha(b"a\r\n\r\nWARC/1.0\r\n"),
         "head": b"HTTP/1.1 200 OK\r\nX-Key: -12\r\n\r\n", "payload": b"a\r\n\r\nWARC/1.0\r\n"}
    again = {**r, "kind": "revisit", "record_id": record_id("a", 2), "first_id": r["record_id"], "first_url": "http://é/", "first_date": r["date"], "payload": None}
    found = list(warc_records(warc_record(r) + b"\r\n\r\n" + warc_record(again) + b"\r\n\r\n", "X-Key"))
    assert [x["kind"] for x in found] == ["response", "revisit"] and all(x["intact"] for x in found) and [x["key"] for x in found] == [-12, -12]
    assert found[0]["payload"] == r["payload"] and found[0]["size"] == 15 and found[0]["url"] == "http://é/"
    assert found[1]["refers_to"] == r["record_id"] and found[1]["size"] is None and found[1]["digest"] == r["digest"]
    assert not next(warc_records(warc_record({**r, "digest": sha(b"other")})))["intact"]


def through(spark, pages, path):
    write_arc(pages, f"{path}/arc", url=F.col("url"), payload=F.col("html"), key=F.col("page_id"), key_field="X-Page-Id")
    convert(spark, f"{path}/arc", f"{path}/warc", key_field="X-Page-Id")
    return read_warc(spark, f"{path}/warc", key_field="X-Page-Id")


def plain(rows):
    first, out = {}, []
    for i, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100:
            first.setdefault(body, []).append((i is None, i or 0))
    for body, ids in first.items():
        first[body] = min(ids)
    kept = set()
    for i, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        body = (html or "").encode()
        if len(body) < 100 or body not in kept:
            kept.add(body)
            out.append((i, len(body), sha(body), "response", None))
        else:
            out.append((i, len(body), sha(body), "revisit", None if first[body][0] else first[body][1]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("archive_bytes", [8 << 20, 300])
def test_odd_pages(spark, tmp_dir, monkeypatch, archive_bytes):
    monkeypatch.setattr(W, "ARCHIVE_BYTES", archive_bytes)
    long, edge = "été \r\n\r\n WARC/1.0\r\n" * 20_000, "x" * 100
    rows = [(1, "http://a/ b\nc", long), (2, None, long), (3, "", None), (4, "http://a", ""), (5, "http://a", edge), (0, "http://a", edge), (6, "http://b", "x" * 99), (7, "http://b", "x" * 99),
            (8, "http://c", "HTTP/1.1 200 OK\r\n\r\nfiledesc://x 1 2 3 4\n" * 9), (8, "http://c", "HTTP/1.1 200 OK\r\n\r\nfiledesc://x 1 2 3 4\n" * 9), (None, "http://d", "y" * 200),
            (9, "http://d", "y" * 200), (None, "http://d", "z" * 200), (None, "http://d", "z" * 200), (-5, "http://e", "你" * 60)]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "2 AS digest", "'x' AS payload", "'y' AS kind").repartition(3)
    found = through(spark, pages, tmp_dir).persist()
    assert all(r["intact"] for r in found.collect())
    assert rows_of(resolved(found).select("key", "size", "digest", "kind", "first_key")) == plain(rows)
    bodies = {r["key"]: r["payload"] for r in found.filter("kind = 'response' AND key IS NOT NULL").collect()}
    assert bytes(bodies[1]) == long.encode() and bytes(bodies[0]) == edge.encode()
    assert {r["url"] for r in found.filter("key = 1").collect()} == {"http://a/%20b%0Ac"} and found.filter("key = 2 AND url IS NULL").count() == 1
    if archive_bytes == 300:
        versions = {r["value"].split("\n")[1][0] for r in spark.read.text(f"{tmp_dir}/arc", wholetext=True).collect()}
        assert versions == {"1", "2"}


def test_no_pages_and_foreign_archives(spark, tmp_dir):
    empty = spark.createDataFrame([], SCHEMA)
    assert through(spark, empty, f"{tmp_dir}/none").count() == 0
    data = arc1(("dns:a", "1997", "text/dns", b"a"), ("http://a", "1997", "text/html", b"HTTP/1.0 200 OK\n\n" + b"\xff\x00" * 80)) + b"broken\n"
    import os
    os.makedirs(f"{tmp_dir}/foreign")
    with open(f"{tmp_dir}/foreign/a.arc", "wb") as f:
        f.write(data)
    assert [r["kind"] for r in read_arc(spark, f"{tmp_dir}/foreign").orderBy("offset").collect()] == ["warcinfo", "resource", "response", "damaged"]
    convert(spark, f"{tmp_dir}/foreign", f"{tmp_dir}/foreign-warc")
    found = {r["kind"]: r for r in read_warc(spark, f"{tmp_dir}/foreign-warc").collect()}
    assert set(found) == {"warcinfo", "resource", "response"} and bytes(found["response"]["payload"]) == b"\xff\x00" * 80
    assert all(r["intact"] for r in found.values())


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()]
    assert rows_of(queries.op13_warc(spark, "/root/testdata/sf0.01")) == plain(rows)
