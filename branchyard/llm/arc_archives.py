"""Legacy ARC archives, and their conversion to WARC.

An ARC file is a version block (``filedesc://``) and records. Version 1 describes a record by URL,
address, date, type and length, version 2 by URL, address, date, type, result code, checksum,
location, offset, file name and length; in both, the declared length says where the record ends.
The converter reads each file as a stream, and gives every record what WARC asks for: a record
identifier (from file, offset, URL and date, so a second conversion gives the same), an ISO date, a
type, and digests of block and payload. A record whose payload another record has as well becomes a
revisit, which keeps the HTTP headers and refers to the record with the smallest source id.

Files are written and read by Spark: one gzip file for each partition, each read as one row. So a
partition's rows have to fit a task, which ``spark.sql.files.maxPartitionBytes`` of the input sees
to. Payloads are never shuffled by digest; only digests and ids are, and of what is decided only the
revisits go back to the files.

Defined results: a null payload is empty. A null URL is ``urn:source:<id>``, a null id leaves the
field out; such records refer to none. White space and control characters in a URL become percent
codes. Repeated rows give repeated records: of the smallest source id all are responses. Payloads
shorter than ``least_bytes`` are never revisits. An empty table gives archives without records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchyard.llm.common import column, python_tasks, with_group_min

#: The field names of the two ARC versions, and the WARC profile of a revisit.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
SAME_PAYLOAD = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

ADDRESS, DATE, TYPE = "0.0.0.0", "20000101000000", "text/html"
HEAD = re.compile(rb"HTTP/\d[^\r\n]*\r?\n(?:[^\r\n]+\r?\n)*\r?\n")


def safe_url(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f-\xa0\s]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


# ---- ARC --------------------------------------------------------------------------------


def _arc_rows(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    """The version block and the records of one file; files of even and odd number differ in version."""
    number = TaskContext.get().partitionId()
    version, name = 1 + number % 2, f"part-{number}.arc.gz"
    about = f"{version} 0 branchyard\n{FIELDS[version]}\n".encode()
    first = [f"filedesc://{name}", ADDRESS, date, "text/plain", *(["200", "-", "-", "0", name] if version == 2 else []), str(len(about))]
    block = " ".join(first).encode() + b"\n" + about
    offset = len(block) + 1
    yield pa.record_batch({"record": pa.array([block], pa.binary())})
    for batch in batches:
        records = []
        for source, url, payload in zip(column(batch, "source_id").to_pylist(), column(batch, "url").to_pylist(), column(batch, "payload")):
            data = (payload.as_py() or "").encode()
            own = "" if source is None else f"X-Source-Id: {source}\r\n"
            http = f"HTTP/1.1 200 OK\r\n{own}Content-Type: {TYPE}; charset=utf-8\r\nContent-Length: {len(data)}\r\n\r\n".encode() + data
            fields = [safe_url(url) if url else f"urn:source:{source}", ADDRESS, date, TYPE]
            if version == 2:
                fields += ["200", hashlib.md5(http, usedforsecurity=False).hexdigest(), "-", str(offset), name]
            record = " ".join([*fields, str(len(http))]).encode() + b"\n" + http
            offset += len(record) + 1
            records.append(record)
        yield pa.record_batch({"record": pa.array(records, pa.binary())})


def write_arc(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str = DATE) -> None:
    """Writes one ARC file for each partition, of version 1 and 2 by turns; payloads are UTF-8."""
    python_tasks(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("long").alias("source_id"), F.col(url_col).alias("url"), F.col(payload_col).alias("payload"))
    records = rows.mapInArrow(lambda batches: _arc_rows(batches, date), "record binary")
    records.select(F.col("record").cast("string")).write.option("compression", "gzip").text(folder)


@dataclass
class Record:
    offset: int
    url: str
    address: str
    date: str
    kind: str
    head: bytes
    payload: bytes

    @property
    def source(self) -> int | None:
        found = re.search(rb"(?mi)^X-Source-Id: (-?\d+)\r?$", self.head)
        return int(found[1]) if found else None


def arc_records(content: bytes) -> Iterator[Record]:
    """The records of an ARC file, as its version block describes them."""
    with gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content) as file:
        names, offset = FIELDS[1].split(), 0
        while line := file.readline():
            at, offset = offset, offset + len(line)
            if not line.strip():
                continue
            text = line.decode().rstrip("\r\n")
            if text.startswith("filedesc://"):
                length = int(text.rsplit(" ", 1)[1])
                about = _exactly(file, length)
                version = int(about.split(maxsplit=1)[0])
                if version not in FIELDS:
                    raise ValueError(f"ARC version {version} is not known")
                names = FIELDS[version].split()
            else:
                values = text.split(" ")
                if len(values) != len(names):
                    raise ValueError(f"{len(names)} fields expected at byte {at}: {text[:200]}")
                fields = dict(zip(names, values))
                length = int(fields["Archive-length"])
                data = _exactly(file, length)
                head = HEAD.match(data)
                head = head[0] if head else b""
                yield Record(at, fields["URL"], fields["IP-address"], fields["Archive-date"], fields["Content-type"], head, data[len(head) :])
            offset += length


def _exactly(file, n: int) -> bytes:
    data = file.read(n)
    if len(data) < n:
        raise ValueError(f"a record ends after {len(data)} of {n} bytes")
    return data


# ---- WARC -------------------------------------------------------------------------------


def record_id(name: str, record: Record) -> str:
    digest = hashlib.sha256(f"{name}|{record.offset}|{record.url}|{record.date}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest[:16], version=5)}>"


def iso_date(digits: str) -> str:
    """A date of ARC's digits; what a short one leaves out is the beginning of the period."""
    d = digits + "00010101000000"[len(digits) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(name: str, record: Record, refers: dict | None) -> bytes:
    kind = "revisit" if refers else "response" if record.head else "resource"
    block = record.head + (b"" if refers else record.payload)
    source = record.source
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id(name, record)),
        ("WARC-Date", iso_date(record.date)),
        ("WARC-Target-URI", record.url),
        ("WARC-IP-Address", record.address),
        ("Content-Type", "application/http; msgtype=response" if record.head else record.kind),
        ("WARC-Payload-Digest", f"sha256:{hashlib.sha256(record.payload).hexdigest()}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("X-Payload-Length", len(record.payload)),
        *([("X-Source-Id", source)] if source is not None else []),
        *([("WARC-Profile", SAME_PAYLOAD), ("WARC-Refers-To", refers["record_id"]), ("X-Refers-To-Source-Id", refers["source_id"])] if refers else []),
        ("Content-Length", len(block)),
    ]
    return b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(column(batch, "file").to_pylist(), column(batch, "content")):
            rows = [
                {"file": name, "offset": r.offset, "own": {"source_id": r.source, "record_id": record_id(name, r)}, "digest": hashlib.sha256(r.payload).digest(), "n_bytes": len(r.payload)}
                for r in arc_records(content.as_py())
                if r.head and r.source is not None
            ]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, DIGESTS)


DIGESTS = pa.schema(
    [("file", pa.string()), ("offset", pa.int64()), ("own", pa.struct([("source_id", pa.int64()), ("record_id", pa.string())])), ("digest", pa.binary()), ("n_bytes", pa.int64())]
)


def _warc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content, revisits in zip(column(batch, "file").to_pylist(), column(batch, "content"), column(batch, "revisits").to_pylist()):
            refers = {x["offset"]: x["first"] for x in revisits or []}
            about = b"software: branchyard\r\nformat: WARC File Format 1.0\r\n"
            info = Record(-1, "", "", DATE, "", b"", b"")
            head = f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: {record_id(name, info)}\r\nWARC-Date: {iso_date(DATE)}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n"
            records, size = [head.encode() + about], 0
            for record in arc_records(content.as_py()):
                records.append(warc_record(name, record, refers.get(record.offset)))
                size += len(records[-1])
                if size > 4 << 20:
                    yield pa.record_batch({"record": pa.array(records, pa.binary())})
                    records, size = [], 0
            yield pa.record_batch({"record": pa.array(records, pa.binary())})


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per archive; rows are as many tasks as there are files to read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, *, least_bytes: int = 100) -> None:
    """Writes the records of all ARC files of a folder as WARC files."""
    python_tasks(spark)
    files = _files(spark, arc_folder)
    rows = files.mapInArrow(_digests, "file string, offset long, own struct<source_id: long, record_id: string>, digest binary, n_bytes long")
    rows = with_group_min(rows.where(F.col("n_bytes") >= least_bytes).drop("n_bytes"), "digest", "own", "first")
    revisits = rows.where("own.source_id > first.source_id").groupBy("file").agg(F.collect_list(F.struct("offset", "first")).alias("revisits"))
    records = files.join(revisits, "file", "left").mapInArrow(_warc_rows, "record binary")
    records.select(F.col("record").cast("string")).write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(warc_folder)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of each record; the declared length says where it ends."""
    with gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content) as file:
        while line := file.readline():
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no WARC record: {line[:100]!r}")
            fields = {}
            while (line := file.readline().decode().rstrip("\r\n")):
                name, value = line.split(":", 1)
                fields[name.lower()] = value.strip()
            yield fields, _exactly(file, int(fields["content-length"]))


def _read_warc(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in column(batch, "content"):
            rows, size = [], 0
            for fields, block in warc_records(content.as_py()):
                if fields["warc-type"] == "warcinfo":
                    continue
                head = HEAD.match(block)
                payload = block[len(head[0]) :] if head else block
                digest = fields["warc-payload-digest"].removeprefix("sha256:")
                if fields["warc-type"] != "revisit" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"the payload of {fields['warc-record-id']} is not what its digest says")
                numbers = [int(x) if x is not None else None for x in (fields.get("x-source-id"), fields.get("x-payload-length"), fields.get("x-refers-to-source-id"))]
                rows.append(
                    {
                        "source_id": numbers[0], "record_id": fields["warc-record-id"], "record_type": fields["warc-type"], "url": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
                        "payload_bytes": numbers[1], "payload_digest": digest, "refers_to": numbers[2], "refers_to_record": fields.get("warc-refers-to"), "payload": payload if payloads else None,
                    }
                )
                size += len(payload) * payloads
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(rows, WARC)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, WARC)


WARC = pa.schema(
    [
        ("source_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("date", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("refers_to_record", pa.string()), ("payload", pa.binary()),
    ]
)


def read_warc(spark: SparkSession, folder: str, *, payloads: bool = True) -> DataFrame:
    """One row per record but warcinfo; ``payload`` is null without ``payloads`` and empty for revisits."""
    python_tasks(spark)
    schema = "source_id long, record_id string, record_type string, url string, date string, payload_bytes long, payload_digest string, refers_to long, refers_to_record string, payload binary"
    return _files(spark, folder).mapInArrow(lambda batches: _read_warc(batches, payloads), schema)
