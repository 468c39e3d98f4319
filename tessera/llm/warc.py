"""ARC archives of both versions converted to WARC, and both read and written as Spark tables.

An ARC file begins with a version block, whose lines name the version and the
fields of the header lines that follow; each record is one such line and as
many bytes as it declares.  The converter reads the lines by the fields of
their version and synthesises what WARC wants besides: a record identifier
from the archive's name and the record's offset (the same in every run), the
date in ISO form, the type (``response`` for HTTP messages, ``warcinfo`` for
the version block, else ``resource``), payload and block digests.  A response
whose payload another record holds becomes a ``revisit`` of the first one.

Archives are files of a bounded size, each written from one row and read as one row.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialise, text_slices

#: Bytes of records after which an archive is closed; one longer record still fits whole.
ARCHIVE_BYTES = 8 << 20
#: Payloads of at least this many bytes are looked for among the others.
LEAST_BYTES = 100

# The formats' field names, header values and media types.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
HTTP_RESPONSE, WARC_FIELDS = "application/http; msgtype=response", "application/warc-fields"

_RECORD = ("archive string, offset long, kind string, record_id string, url string, ip string, date string, mime string, key long, "
           "digest string, size long, head binary, payload binary")
_WARC = "record_id string, kind string, url string, date string, digest string, size long, key long, refers_to string, intact boolean, payload binary"


# ---- records

def iso_date(digits: str) -> str | None:
    """An ARC date of 4 to 14 digits (year to second) in ISO form; None if it is no date."""
    if not re.fullmatch(r"\d{4}(\d\d){0,5}", digits):
        return None
    try:
        return datetime.strptime(digits + "00000101000000"[len(digits):], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return None


def record_id(archive: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{archive}|{offset}'.encode()).digest()[:16], version=5)}>"


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """The header of an HTTP message with its blank line, and the body."""
    end = min(((i, n) for mark, n in ((b"\r\n\r\n", 4), (b"\n\n", 2)) if (i := block.find(mark)) >= 0), default=None)
    return (block, b"") if end is None else (block[:sum(end)], block[sum(end):])


def http_field(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found.group(1).decode("utf-8", "replace").strip() if found else None


def arc_records(data: bytes) -> Iterator[dict]:
    """The records of an ARC file in turn.

    A header line that has too few fields or a length that is no number or
    reaches beyond the file ends it with one record of the kind ``damaged``,
    whose payload is the rest.
    """
    at, version, fields, archive, since = 0, 1, ARC_FIELDS[1], "", "1970-01-01T00:00:00Z"
    while True:
        while at < len(data) and data[at] in b"\r\n":
            at += 1
        if at >= len(data):
            return
        end = data.find(b"\n", at)
        end = len(data) if end < 0 else end
        line = data[at:end].rstrip(b"\r").decode("utf-8", "replace")
        first = line.startswith("filedesc://")
        # A version block stands before its version is known; its line has the fields of one of them.
        names = ARC_FIELDS[2 if line.count(" ") >= len(ARC_FIELDS[2]) - 1 else 1] if first else fields
        values = dict(zip(names, line.rsplit(" ", len(names) - 1)))
        length = values.get(names[-1], "")
        if len(values) < len(names) or not re.fullmatch("[0-9]{1,18}", length) or end + 1 + int(length) > len(data) + (length == "0"):
            yield {"archive": archive, "offset": at, "kind": "damaged", "url": None, "payload": data[at:], "head": b""}
            return
        block = data[end + 1:end + 1 + int(length)]
        if first:
            archive = values["URL"].removeprefix("filedesc://")
            lines = block.decode("utf-8", "replace").splitlines()
            version = 2 if lines and lines[0].startswith("2") else 1
            named = lines[1].split() if len(lines) > 1 else []
            fields = named if named[:1] == ["URL"] and named[-1:] == ["Archive-length"] else ARC_FIELDS[version]
            since = iso_date(values["Archive-date"]) or since
        http = block.startswith(b"HTTP/") and not first
        head, payload = http_parts(block) if http else (b"", block)
        yield {
            "archive": archive, "offset": at, "kind": "warcinfo" if first else "response" if http else "resource", "url": None if values["URL"] == "-" else values["URL"],
            "ip": values.get("IP-address"), "date": iso_date(values.get("Archive-date", "")) or since, "mime": values.get("Content-type"), "head": head, "payload": payload,
        }
        at = end + 1 + int(length)


def warc_record(r: dict) -> bytes:
    """One WARC/1.0 record, without the two line ends behind it."""
    head, payload = r["head"] or b"", r["payload"] or b""
    revisit = r["kind"] == "revisit"
    block = head if revisit else head + payload
    lines = [("WARC-Type", r["kind"]), ("WARC-Record-ID", r["record_id"]), ("WARC-Date", r["date"])]
    if r["kind"] == "warcinfo":
        name, block = r["archive"], f"software: tessera\r\nformat: WARC File Format 1.0\r\nconverted-from: {r['archive']}\r\n".encode()
        lines += [("WARC-Filename", name), ("Content-Type", WARC_FIELDS)]
    else:
        lines += [("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["ip"]), ("WARC-Payload-Digest", f"sha256:{r['digest']}")]
        if revisit:
            lines += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", r["first_id"]), ("WARC-Refers-To-Target-URI", r["first_url"]), ("WARC-Refers-To-Date", r["first_date"])]
        lines += [("Content-Type", HTTP_RESPONSE if r["kind"] in ("response", "revisit") else r["mime"])]
    lines += [("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Length", str(len(block)))]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines if v not in (None, "", "-")).encode() + b"\r\n" + block


def warc_records(data: bytes, key_field: str | None = None) -> Iterator[dict]:
    """The records of a WARC file in turn; a damaged one ends it."""
    at = 0
    while True:
        while at < len(data) and data[at] in b"\r\n":
            at += 1
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            return
        fields = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in data[at:end].decode("utf-8", "replace").split("\r\n")[1:]))
        length = int(fields.get("content-length", "0"))
        block = data[end + 4:end + 4 + length]
        http = fields.get("content-type", "").startswith("application/http")
        head, payload = http_parts(block) if http else (b"", block)
        kind, digest = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
        intact = fields.get("warc-block-digest") == f"sha256:{hashlib.sha256(block).hexdigest()}" and (
            digest is None or kind == "revisit" or hashlib.sha256(payload).hexdigest() == digest)
        yield {"record_id": fields.get("warc-record-id"), "kind": kind, "url": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "digest": digest,
               "size": None if kind == "revisit" else len(payload), "key": number(http_field(head, key_field)) if key_field else None,
               "refers_to": fields.get("warc-refers-to"), "intact": intact, "payload": None if kind == "revisit" else payload}
        at = end + 4 + length


def number(text: str | None) -> int | None:
    return int(text) if text is not None and re.fullmatch(r"-?[0-9]{1,19}", text) and -2**63 <= int(text) < 2**63 else None


# ---- tables

def _table(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    names = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds[t]) for n, t in names], [n for n, _ in names])


def _sliced(rows: Iterator[dict], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows in batches of a few megabytes of payload."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += 200 + len(r.get("payload") or b"")
        if size >= ARCHIVE_BYTES:
            yield _table(held, schema)
            held, size = [], 0
    if held:
        yield _table(held, schema)


def _archives(records: Iterator, opening, separator: bytes) -> Iterator[pa.RecordBatch]:
    """Records (or functions of their offset and archive number) joined to archives of about ARCHIVE_BYTES; ``opening(number)`` begins each."""
    held, size, made = [], 0, 0

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([separator.join(held)], pa.binary())], ["data"])

    for r in records:
        if not held:
            held += opening(made)
            size = sum(len(x) + len(separator) for x in held)
        held.append(r(size, made) if callable(r) else r)
        size += len(held[-1]) + len(separator)
        if size >= ARCHIVE_BYTES:
            yield closed()
            held, size, made = [], 0, made + 1
    if held:
        yield closed()


def _write(archives: DataFrame, path: str, end: str) -> None:
    """A gzip file for each row; ``end`` follows the last record."""
    (archives.select(F.col("data").cast("string").alias("value")).write.option("lineSep", end).option("maxRecordsPerFile", 1).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").text(path))


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("value").cast("binary").alias("data"))


def write_arc(pages: DataFrame, path: str, *, url: Column, payload: Column, key: Column, key_field: str = "X-Key", date: str = "20240101000000",
              ip: str = "0.0.0.0", name: str = "pages") -> None:
    """Legacy archives of HTTP responses, of version 1 and 2 in turn.

    White space and control characters in a URL are percent-encoded; a null
    URL is ``-``, a null payload empty, a null key leaves its header field out.
    """
    rows = pages.select(url.cast("string").alias("url"), payload.cast("string").cast("binary").alias("payload"), key.cast("long").alias("key"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def line(version: int, values: dict) -> bytes:
            return (" ".join(values.get(f, "-") for f in ARC_FIELDS[version]) + "\n").encode()

        def version_of(made: int) -> int:
            return 1 + (part + made) % 2

        def opening(made: int) -> list[bytes]:
            version, archive = version_of(made), f"{name}-{part:05d}-{made:05d}.arc"
            block = f"{version} 0 tessera\n{' '.join(ARC_FIELDS[version])}\n".encode()
            return [line(version, {"URL": f"filedesc://{archive}", "IP-address": ip, "Archive-date": date, "Content-type": "text/plain", "Result-code": "200", "Offset": "0",
                                   "Filename": archive, "Archive-length": str(len(block))}) + block]

        def record(url: str | None, payload: bytes, key: int | None):
            token = "-" if not url else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)
            mark = "" if key is None else f"{key_field}: {key}\r\n"
            block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{mark}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
            return lambda offset, made: line(version_of(made), {
                "URL": token, "IP-address": ip, "Archive-date": date, "Content-type": "text/html", "Result-code": "200", "Offset": str(offset),
                "Filename": f"{name}-{part:05d}-{made:05d}.arc", "Archive-length": str(len(block))}) + block

        records = (record(u, p or b"", k) for b in text_slices(batches, 1) for u, p, k in zip(*(c.to_pylist() for c in b.columns)))
        yield from _archives(records, opening, b"\n")

    _write(rows.mapInArrow(work, "data binary"), path, "\n")


def read_arc(spark: SparkSession, path: str, *, key_field: str | None = None, content: bool = True) -> DataFrame:
    """The records of the ARC files under ``path``, with what a WARC record of each needs.

    ``key`` is the number in the HTTP field ``key_field``, null without one.
    ``digest`` (sha256) and ``size`` are the payload's: an HTTP body, else the
    whole block.  Without ``content`` head and payload are null.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for data in batch.column(0):
                    for r in arc_records(data.as_py() or b""):
                        r["record_id"] = record_id(r["archive"], r["offset"])
                        r["digest"], r["size"] = hashlib.sha256(r["payload"]).hexdigest(), len(r["payload"])
                        r["key"] = number(http_field(r["head"], key_field)) if key_field else None
                        yield r if content else {**r, "head": None, "payload": None}

        yield from _sliced(rows(), _RECORD)

    return _read(spark, path).mapInArrow(work, _RECORD)


def convert(spark: SparkSession, arc_path: str, warc_path: str, *, key_field: str | None = None, least_bytes: int = LEAST_BYTES) -> None:
    """The ARC files under ``arc_path`` as WARC files under ``warc_path``.

    Of responses with equal payloads of at least ``least_bytes`` bytes that of
    the smallest key (a null one last), then date, then identifier stays a response, the
    others revisit it.  The archives are read twice: first for the digests
    that several records have, then to write.  Damaged rests of an archive
    are not written; ``read_arc`` shows them.
    """
    index = read_arc(spark, arc_path, key_field=key_field, content=False).filter((F.col("kind") == "response") & (F.col("size") >= least_bytes))
    order = F.struct(F.coalesce("key", F.lit(2**63 - 1)).alias("key"), "date", "record_id", "url")
    firsts = index.groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = materialise(firsts.select(F.col("digest").alias("f_digest"), F.col("first.record_id").alias("first_id"), F.col("first.url").alias("first_url"),
                                       F.col("first.date").alias("first_date")), "warc-firsts")
    records = read_arc(spark, arc_path, key_field=key_field).filter("kind <> 'damaged'")
    joined = records.join(firsts, (F.col("digest") == F.col("f_digest")) & (F.col("kind") == "response") & (F.col("size") >= least_bytes), "left")
    again = F.col("first_id").isNotNull() & (F.col("first_id") != F.col("record_id"))
    ready = joined.withColumns({"kind": F.when(again, F.lit("revisit")).otherwise(F.col("kind")), "payload": F.when(~again | again.isNull(), F.col("payload"))})
    ready = ready.select("archive", "kind", "record_id", "url", "ip", "date", "mime", "digest", "head", "payload", "first_id", "first_url", "first_date")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (warc_record(r) for b in text_slices(batches, 9) for r in b.to_pylist())
        yield from _archives(records, lambda made: [], b"\r\n\r\n")

    _write(ready.mapInArrow(work, "data binary"), warc_path, "\r\n\r\n")


def read_warc(spark: SparkSession, path: str, *, key_field: str | None = None, content: bool = True) -> DataFrame:
    """The records of the WARC files under ``path``; a revisit has neither size nor payload.

    ``intact``: the block, and a response's payload, have the digests that the header declares.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r if content else {**r, "payload": None} for b in batches for data in b.column(0) for r in warc_records(data.as_py() or b"", key_field))
        yield from _sliced(rows, _WARC)

    return _read(spark, path).mapInArrow(work, _WARC)


def resolved(records: DataFrame) -> DataFrame:
    """Responses and revisits of ``records``: a revisit gets the size of the response that it refers to, and that one's key as ``first_key``."""
    found = records.filter("kind IN ('response', 'revisit')")
    held = found.filter("kind = 'response'").select(F.col("record_id").alias("r_id"), F.col("size").alias("r_size"), F.col("key").alias("first_key"))
    joined = found.join(held, F.col("refers_to") == F.col("r_id"), "left")
    return joined.withColumn("size", F.coalesce("size", "r_size")).drop("r_id", "r_size")
