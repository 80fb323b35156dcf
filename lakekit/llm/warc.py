"""Legacy archive converter: ARC files in, WARC files out.

``write_arc`` lays pages down as ARC archives (version 1 and 2 files), ``arc_to_warc`` reads the version block of each
ARC file, follows its field list and the declared lengths, and synthesises the WARC record of each entry: identifier,
timestamp, type, payload and block digests.  Entries with equal payloads become one ``response`` (smallest page id) and
``revisit`` records that refer to it.  ``read_warc`` parses WARC files back and verifies lengths and digests.

Archives go through Spark's text writer (a record's closing blank lines are the line separator), so they are committed
like any Spark output, on any store, and a lost task is simply written again.  Null html is an empty payload; a null or
unprintable URL is percent-encoded or ``about:blank``; a null page id leaves its header out and sorts last; repeated rows
become records of their own; an empty table gives archives without entries; further columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: field lists of the ARC format, versions 1 and 2
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
UNPRINTABLE = re.compile(r"[\x00-\x20\x7f]")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_url(url: str | None) -> str:
    return UNPRINTABLE.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"


def arc_version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 lakekit\n{ARC_FIELDS[version]}\n".encode()
    if version == 1:
        head = f"filedesc://{name} 0.0.0.0 {date} text/plain {len(body)}\n"
    else:
        head = f"filedesc://{name} 0.0.0.0 {date} text/plain 200 - - 0 {name} {len(body)}\n"
    return head.encode() + body


def arc_record(version: int, name: str, offset: int, url: str, ip: str, date: str, block: bytes) -> bytes:
    if version == 1:
        head = f"{url} {ip} {date} text/html {len(block)}\n"
    else:
        head = f"{url} {ip} {date} text/html 200 {hashlib.md5(block).hexdigest()} - {offset} {name} {len(block)}\n"
    return head.encode() + block


def write_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = "20240101000000", ip: str = "192.0.2.1") -> str:
    """One gzip ARC file per partition; odd partitions use version 1, even ones version 2."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version, name = 2 - part % 2, f"part-{part:05d}.arc"
        block = arc_version_block(version, name, date)
        offset = len(block) + 1
        yield pa.record_batch([pa.array([block], pa.binary())], ["line"])
        for batch in batches:
            lines = []
            cols = (batch.column(i).to_pylist() for i in range(3))
            for page_id, url, html in zip(*cols):
                html = html or b""
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + f"Content-Length: {len(html)}\r\n"
                head += "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
                lines.append(arc_record(version, name, offset, _header_url(url), ip, date, head.encode() + b"\r\n" + html))
                offset += len(lines[-1]) + 1
            yield pa.record_batch([pa.array(lines, pa.binary())], ["line"])

    rows = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"),
                        pages[html_col].cast("string").cast("binary").alias("html"))
    (rows.mapInArrow(encode, "line binary").select(F.col("line").cast("string").alias("value"))
     .write.option("lineSep", "\n").option("compression", "gzip").text(path))
    return path


def _stream(content: bytes):
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw), 1 << 18) if content[:2] == b"\x1f\x8b" else raw


def parse_arc(content: bytes, name: str) -> Iterator[tuple[int, dict, bytes]]:
    """(offset, header fields, block) of each entry; the field list comes from the file's own version block."""
    stream, fields, offset = _stream(content), None, 0
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        if line == b"\n":
            continue
        values = line.decode("utf-8", "replace").rstrip("\n").split(" ")
        if not values[-1].isdigit():
            raise ValueError(f"{name}: no length in the header at byte {start}")
        block = stream.read(int(values[-1]))
        offset += len(block)
        if len(block) != int(values[-1]):
            raise ValueError(f"{name}: the entry at byte {start} is shorter than declared")
        if values[0].startswith("filedesc:"):
            lines = block.decode("utf-8", "replace").split("\n")
            fields = lines[1].split(" ") if len(lines) > 1 and lines[1] else ARC_FIELDS[int(lines[0].split(" ")[0])].split(" ")
            continue
        if fields is None:
            raise ValueError(f"{name}: an entry stands before the version block")
        if len(values) != len(fields):
            raise ValueError(f"{name}: {len(values)} header fields at byte {start}; the version block names {len(fields)}")
        yield start, dict(zip(fields, values)), block


def warc_date(arc_date: str) -> str:
    """ARC dates have 8, 12 or 14 digits; missing parts are zero."""
    d = arc_date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _http(block: bytes) -> tuple[bytes, dict, bytes] | None:
    """Head, headers by lower-case name and payload of an HTTP response; None for another protocol."""
    if not block.startswith(b"HTTP/"):
        return None
    head, sep, payload = block.partition(b"\r\n\r\n")
    pairs = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])
    return head + sep, {k.strip().lower(): v.strip() for k, _, v in pairs}, payload


ENTRY = ("record_id string, page_id long, uri string, ip string, date string, mime string, payload_digest string, "
         "payload_bytes long")


def arc_entries(spark: SparkSession, path: str, with_payload: bool) -> DataFrame:
    """One row per ARC entry; ``head`` and ``payload`` only if asked for."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held = [], 0
                for offset, f, block in parse_arc(content, name):
                    http = _http(block)
                    head, headers, payload = http or (b"", {}, block)
                    page = headers.get("x-page-id")
                    row = (f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset}')}", int(page) if page else None,
                           f["URL"], f["IP-address"], warc_date(f["Archive-date"]),
                           f["Content-type"], sha1_base32(payload), len(payload))
                    rows.append(row + (head, payload) if with_payload else row)
                    held += len(block) if with_payload else 64
                    if held > 8 << 20:
                        yield to_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield to_batch(rows)

    names = [x.split(" ")[0] for x in ENTRY.split(", ")] + ["head", "payload"] * with_payload
    types = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary(), pa.binary()]
    to_batch = lambda rows: pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return files.mapInArrow(parse, ENTRY + ", head binary, payload binary" * with_payload)


def payload_groups(entries: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Payloads that more than one entry has, with the entry that keeps it (smallest page id, then record id)."""
    first = F.min(F.struct(F.col("page_id").isNull().alias("n"), "page_id", "record_id", "uri", "date")).alias("first")
    return (entries.filter(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "payload_bytes")
            .agg(F.count(F.lit(1)).alias("n"), first).filter("n > 1")
            .select("payload_digest", "payload_bytes", F.col("first.record_id").alias("to_id"),
                    F.col("first.uri").alias("to_uri"), F.col("first.date").alias("to_date")))


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without its two closing line ends, which the text writer adds."""
    lines = [f"{k}: {v}" for k, v in fields] + [f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = 0) -> str:
    groups = payload_groups(arc_entries(spark, arc_path, False), min_bytes)
    entries = arc_entries(spark, arc_path, True).join(groups, ["payload_digest", "payload_bytes"], "left")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        info = b"software: lakekit\r\nformat: WARC File Format 1.1\r\n"
        own = uuid.uuid5(uuid.NAMESPACE_URL, f"warcinfo#{TaskContext.get().partitionId()}")
        first = warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{own}>"),
                             ("WARC-Date", "1970-01-01T00:00:00Z"), ("Content-Type", "application/warc-fields")], info)
        yield pa.record_batch([pa.array([first], pa.binary())], ["line"])
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                revisit = r["to_id"] is not None and r["to_id"] != r["record_id"]
                kind = "revisit" if revisit else "response" if r["head"] else "resource"
                block = r["head"] if revisit else r["head"] + r["payload"]
                fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{r['record_id']}>"), ("WARC-Date", r["date"]),
                          ("WARC-Target-URI", r["uri"]), ("WARC-IP-Address", r["ip"]),
                          ("WARC-Payload-Digest", f"sha1:{r['payload_digest']}"),
                          ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
                          ("Content-Type", "application/http; msgtype=response" if r["head"] else r["mime"])]
                if revisit:
                    fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{r['to_id']}>"),
                               ("WARC-Refers-To-Target-URI", r["to_uri"]), ("WARC-Refers-To-Date", r["to_date"])]
                out.append(warc_record(fields, block))
            yield pa.record_batch([pa.array(out, pa.binary())], ["line"])

    (entries.mapInArrow(encode, "line binary").select(F.col("line").cast("string").alias("value"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(warc_path))
    return warc_path


def parse_warc(content: bytes, name: str) -> Iterator[tuple[dict, bytes]]:
    """(headers by lower-case name, block) of each record."""
    stream = _stream(content)
    while line := stream.readline():
        if line == b"\r\n":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"{name}: not a WARC record: {line[:60]!r}")
        headers = {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            k, _, v = line.decode("utf-8", "replace").partition(":")
            headers[k.strip().lower()] = v.strip()
        n = int(headers["content-length"])
        block = stream.read(n)
        if len(block) != n:
            raise ValueError(f"{name}: a record is shorter than declared")
        yield headers, block


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record_id, record_type, page_id, uri, date, payload_digest, payload_bytes, refers_to_id; digests are verified."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                for h, block in parse_warc(content, name):
                    if h["warc-type"] == "warcinfo":
                        continue
                    if h.get("warc-block-digest", "") != f"sha1:{sha1_base32(block)}":
                        raise ValueError(f"{name}: the block of {h['warc-record-id']} has another digest")
                    _, http, payload = _http(block) or (b"", {}, block)
                    digest = h["warc-payload-digest"].removeprefix("sha1:")
                    if h["warc-type"] == "response" and sha1_base32(payload) != digest:
                        raise ValueError(f"{name}: the payload of {h['warc-record-id']} has another digest")
                    page, n = http.get("x-page-id"), http.get("content-length")
                    rows.append((h["warc-record-id"].strip("<>"), h["warc-type"], int(page) if page else None,
                                 h["warc-target-uri"], h["warc-date"], digest,
                                 int(n) if h["warc-type"] == "revisit" else len(payload),
                                 h.get("warc-refers-to", "").strip("<>") or None))
                if rows:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    schema = ("record_id string, record_type string, page_id long, uri string, date string, payload_digest string, "
              "payload_bytes long, refers_to_id string")
    names = [x.split(" ")[0] for x in schema.split(", ")]
    types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
    files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    return files.mapInArrow(parse, schema)


def with_referred_page(records: DataFrame) -> DataFrame:
    """``refers_to``: the page id of the response that a revisit refers to."""
    kept = records.filter("record_type <> 'revisit'").select(F.col("record_id").alias("refers_to_id"),
                                                             F.col("page_id").alias("refers_to"))
    return records.join(kept, "refers_to_id", "left")
