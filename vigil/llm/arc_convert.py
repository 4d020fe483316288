"""Legacy ARC archives: writer, version-aware parser, and conversion to WARC.

An ARC file opens with a ``filedesc://`` record whose version block names the fields of the
header lines that follow (version 1: five fields, version 2: ten), each followed by as many
bytes as it declares.  The converter synthesises WARC records from them: identifiers from
archive name and offset, ISO timestamps from the 14 digits, types, and SHA-1 digests; of
equal payloads one stays a response and the others become revisits that refer to it.

Archives are written by Spark's text writer: a record is a value and the separator of the
format (a newline, or two CRLFs) is the line separator.  They are read as binary files, one
per task, and decompressed as a stream.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: fixed values of the formats
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
       "Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
CRLF2 = b"\r\n\r\n"

#: payloads shorter than this are never revisits
MIN_REVISIT_BYTES = 1000

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_EPOCH = datetime(2020, 1, 1)


def _url(url: str | None, page_id) -> str:
    """A URL without blanks or control characters (percent-encoded)."""
    return _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"


def _text_rows(rows: Iterator[bytes], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Records as batches of about ``size`` bytes."""
    own, held = [], 0
    for r in rows:
        own.append(r)
        held += len(r)
        if held >= size:
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary())], names=["value"])
            own, held = [], 0
    if own:
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary())], names=["value"])


# --- ARC -----------------------------------------------------------------------------


def _arc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    version, name = 2 - part % 2, f"pages-{part:06d}.arc"

    def records() -> Iterator[bytes]:
        offset = 0
        for batch in batches:
            for page, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                if not offset:
                    block = f"{version} 0 vigil\n{ARC_FIELDS[version]}\n".encode()
                    more = f"200 - - 0 {name} " if version == 2 else ""
                    first = (f"filedesc://{name} 0.0.0.0 {_EPOCH:%Y%m%d%H%M%S} text/plain "
                             f"{more}{len(block)}\n").encode() + block
                    offset = len(first) + 1
                    yield first
                html = html or b""
                body = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n"
                        f"X-Page-Id: {'' if page is None else page}\r\n\r\n").encode() + html
                when = _EPOCH + timedelta(seconds=abs(page or 0) % (1 << 28))
                more = (f"200 {hashlib.md5(html).hexdigest()} - {offset} {name} "
                        if version == 2 else "")
                line = (f"{_url(url, page)} 127.0.0.1 {when:%Y%m%d%H%M%S} text/html {more}"
                        f"{len(body)}\n").encode()
                offset += len(line) + len(body) + 1
                yield line + body
    return _text_rows(records())


def write_arc(pages: DataFrame, path: str) -> None:
    """``page_id, url, html`` as ARC files, one per scan partition, no shuffle; versions 2
    and 1 in turn.  A null html is an empty payload, a null url a URN of the page id."""
    (pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string")
                  .cast("binary").alias("html"))
     .mapInArrow(_arc_rows, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\n").option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").text(path))


def _stream(content: bytes) -> io.BufferedReader:
    raw = io.BytesIO(content)
    return gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw


def parse_arc(stream) -> Iterator[tuple[str, int, int, dict | None, bytes, str | None]]:
    """Archive name, offset, version, header fields, body and damage of each record.

    Header lines follow the field names of the last version block (version 1's until one
    is seen).  Damage is None, or ``truncated`` if the archive ends before the declared
    length, or ``skipped`` for lines that are no header (a damaged header and what followed
    it up to the next one, or bytes beyond a declared length): a row without fields whose
    body is all of them.  Blank lines between records are separators.
    """
    name, version, fields = "", 1, ARC_FIELDS[1].lower().split(" ")
    offset, lost, lost_at = 0, [], 0

    def skipped():
        body = b"".join(lost)
        lost.clear()
        return name, lost_at, version, None, body, "skipped"

    while line := stream.readline():
        at, offset = offset, offset + len(line)
        head = line.rstrip(b"\r\n")
        if not head:
            if lost:
                lost.append(line)
            continue
        first = head.startswith(b"filedesc://")
        # a legacy URL may hold blanks: split from the right
        parts = head.decode("utf-8", "replace").rsplit(" ", 1 if first else len(fields) - 1)
        if not (first and len(parts) == 2 or len(parts) == len(fields)) or not parts[-1].isdigit():
            lost_at = lost_at if lost else at
            lost.append(line)
            continue
        if lost:
            yield skipped()
        body = stream.read(int(parts[-1]))
        offset += len(body)
        if first:
            name = head.decode("utf-8", "replace").split(" ")[0].removeprefix("filedesc://")
            lines = body.decode("utf-8", "replace").split("\n")
            version = int(lines[0].split(" ")[0]) if lines[0][:1].isdigit() else 1
            fields = (lines[1] if len(lines) > 1 and lines[1].strip() else
                      ARC_FIELDS.get(version, ARC_FIELDS[1])).strip().lower().split(" ")
            continue
        yield (name, at, version, dict(zip(fields, parts)), body,
               "truncated" if len(body) < int(parts[-1]) else None)
    if lost:
        yield skipped()


def split_http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP head (with its blank line) and payload; no head if the body is not HTTP."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    cut, gap = body.find(CRLF2), 4
    if cut < 0:
        cut, gap = body.find(b"\n\n"), 2
    return (body[:cut + gap], body[cut + gap:]) if cut >= 0 else (body, b"")


def http_field(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*([^\r\n]*)", head)
    return m[1].decode("utf-8", "replace").strip() if m else None


def iso_date(digits: str) -> str:
    """WARC timestamp of an ARC date of up to 14 digits; the epoch if it is none."""
    d = (digits + "00000101000000"[len(digits):]) if digits.isdigit() and len(digits) >= 4 else ""
    try:
        return f"{datetime.strptime(d[:14], '%Y%m%d%H%M%S'):%Y-%m-%dT%H:%M:%SZ}"
    except ValueError:
        return "1970-01-01T00:00:00Z"


RECORD_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("record_id", pa.string()), ("url", pa.string()),
    ("ip", pa.string()), ("date", pa.string()), ("mime", pa.string()),
    ("arc_version", pa.int32()), ("payload_sha1", pa.string()), ("payload_bytes", pa.int64()),
    ("head", pa.binary()), ("payload", pa.binary()), ("archive", pa.string()),
    ("offset", pa.int64()), ("damage", pa.string())])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary",
             pa.bool_(): "boolean"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4 << 20
             ) -> Iterator[pa.RecordBatch]:
    own, held = [], 0

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*own), schema)], schema=schema)
    for r in rows:
        own.append(r)
        held += 200 + sum(len(x) for x in r if isinstance(x, bytes))
        if held >= size:
            yield made()
            own, held = [], 0
    if own:
        yield made()


def _arc_records(packed: bool):
    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for content in batch.column(0):
                for name, at, version, own, body, damage in parse_arc(_stream(content.as_py())):
                    own = own or {"url": None}
                    head, payload = split_http(body)
                    page = http_field(head, "X-Page-Id") or ""
                    url = own["url"]
                    yield (int(page) if page.lstrip("-").isdigit() else None,
                           f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{at}#{url}')}>",
                           url, own.get("ip-address", ""), iso_date(own.get("archive-date", "")),
                           own.get("content-type", ""), version,
                           hashlib.sha1(payload).hexdigest(), len(payload), head,
                           zlib.compress(payload) if packed else payload, name, at, damage)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(batches), RECORD_SCHEMA)
    return run


def read_arc(spark: SparkSession, path: str, *, packed: bool = False) -> DataFrame:
    """The records of all ARC files under ``path``; with ``packed`` their payloads are
    compressed (zlib), for a shuffle.  ``damage`` (with ``archive`` and ``offset``) says what is
    wrong with a row: ``truncated`` bodies are shorter than declared, ``skipped`` rows have no
    url and hold the bytes that belong to no readable record.  An archive is read as one
    ``content`` cell, so it has at most 2 GB."""
    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInArrow(_arc_records(packed), _ddl(RECORD_SCHEMA)))


# --- WARC ----------------------------------------------------------------------------


def assign_types(records: DataFrame, light: DataFrame | None = None, *,
                 min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds ``record_type`` and, for revisits, ``refers_to_record, refers_to_url,
    refers_to_date``: of records with equal payloads of at least ``min_bytes`` bytes, that
    with the largest page id (then record id) is the response.

    ``light`` may give the same records without bodies.  One row per repeated payload is
    joined back by digest, so a payload shared by much of the data is pre-aggregated and
    Spark can split its join.
    """
    key = F.struct("page_id", "record_id", "url", "date")
    groups = ((light if light is not None else records)
              .where(F.col("payload_bytes") >= min_bytes)
              .groupBy(F.col("payload_sha1").alias("__sha1"), F.col("payload_bytes").alias("__n"))
              .agg(F.max(key).alias("__first"), F.count("*").alias("__count"))
              .where("__count > 1"))
    out = records.join(groups, (F.col("payload_sha1") == F.col("__sha1"))
                       & (F.col("payload_bytes") == F.col("__n")), "left")
    again = F.col("__first").isNotNull() & (F.col("__first.record_id") != F.col("record_id"))
    return out.select(
        *records.columns, F.when(again, "revisit").otherwise("response").alias("record_type"),
        *[F.when(again, F.col(f"__first.{c}")).alias(f"refers_to_{a}")
          for c, a in (("record_id", "record"), ("url", "url"), ("date", "date"))])


def _sha1_32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def warc_record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record without the two CRLFs that end it."""
    lines = [f"{k}: {v}" for k, v in fields if v is not None]
    return "\r\n".join(["WARC/1.0", *lines, f"Content-Length: {len(block)}", "", ""]
                       ).encode() + block


def _warc_rows(packed: bool):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        part, started = TaskContext.get().partitionId(), False
        for batch in batches:
            names = batch.schema.names
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                r = dict(zip(names, values))
                if not started:
                    info = b"software: vigil\r\nformat: WARC File Format 1.0\r\n"
                    own = uuid.uuid5(uuid.NAMESPACE_URL, f"warcinfo#{part}")
                    yield warc_record(
                        [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{own}>"),
                         ("WARC-Date", f"{_EPOCH:%Y-%m-%dT%H:%M:%SZ}"),
                         ("Content-Type", "application/warc-fields")], info)
                    started = True
                http, revisit = bool(r["head"]), r["record_type"] == "revisit"
                body = b"" if revisit else r["payload"]
                block = r["head"] + (zlib.decompress(body) if packed and body else body)
                yield warc_record([
                    ("WARC-Type", "revisit" if revisit else "response" if http else "resource"),
                    ("WARC-Record-ID", r["record_id"]), ("WARC-Date", r["date"]),
                    ("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["ip"] or None),
                    ("WARC-Profile", REVISIT_PROFILE if revisit else None),
                    ("WARC-Refers-To", r["refers_to_record"]),
                    ("WARC-Refers-To-Target-URI", r["refers_to_url"]),
                    ("WARC-Refers-To-Date", r["refers_to_date"]),
                    ("WARC-Payload-Digest", "sha1:" + base64.b32encode(
                        bytes.fromhex(r["payload_sha1"])).decode()),
                    ("WARC-Payload-Length", str(r["payload_bytes"])),
                    ("WARC-Truncated", "unspecified" if r["damage"] else None),
                    ("WARC-Block-Digest", _sha1_32(block)),
                    ("Content-Type", "application/http; msgtype=response" if http
                     else r["mime"] or "application/octet-stream")], block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _text_rows(records(batches))
    return run


def write_warc(typed: DataFrame, path: str, *, packed: bool = False) -> None:
    """Records with their types as WARC files, one per partition, each opened by a
    ``warcinfo`` record."""
    (typed.withColumn("payload", F.when(F.col("record_type") != "revisit", F.col("payload")))
     .mapInArrow(_warc_rows(packed), "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").text(path))


def parse_warc(stream) -> Iterator[tuple[dict, bytes]]:
    """Header fields (lower-case names) and block of each record."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        own = {}
        while (line := stream.readline()).strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            own[k.strip().lower()] = v.strip()
        yield own, stream.read(int(own.get("content-length", 0)))


WARC_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
    ("url", pa.string()), ("date", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to_record", pa.string()), ("intact", pa.bool_())])


def _warc_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for content in batch.column(0):
                for own, block in parse_warc(_stream(content.as_py())):
                    kind = own.get("warc-type")
                    if kind == "warcinfo":
                        continue
                    head, payload = split_http(block)
                    page = http_field(head, "X-Page-Id") or ""
                    said = base64.b32decode(own["warc-payload-digest"].removeprefix("sha1:")).hex()
                    if kind == "revisit":
                        n, ok = int(own["warc-payload-length"]), True
                    else:
                        n = len(payload)
                        ok = hashlib.sha1(payload).hexdigest() == said
                    yield (int(page) if page.lstrip("-").isdigit() else None,
                           own["warc-record-id"], kind, own.get("warc-target-uri"),
                           own.get("warc-date"), n, said, own.get("warc-refers-to"),
                           ok and own["warc-block-digest"] == _sha1_32(block)
                           and "warc-truncated" not in own)
    return _batches(rows(), WARC_SCHEMA)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all WARC files under ``path``, without bodies; ``intact``: digests of
    block and stored payload agree with the header, and the record was not truncated."""
    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInArrow(_warc_records, _ddl(WARC_SCHEMA)))


def convert(spark: SparkSession, arc_path: str, warc_path: str, *,
            min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """All ARC files under one path to WARC files under another.  Truncated records are
    converted with ``WARC-Truncated``; skipped bytes are not (``damages`` lists both).

    The archives are read twice: for the digests alone, and with bodies, which are shuffled
    once (by digest), compressed.  Archives without records give an empty folder of WARC files.
    """
    light = read_arc(spark, arc_path).where(READABLE).select("page_id", "record_id", "url", "date",
                                             "payload_sha1", "payload_bytes")
    records = read_arc(spark, arc_path, packed=True).where(READABLE)
    write_warc(assign_types(records, light, min_bytes=min_bytes), warc_path, packed=True)


READABLE = "damage IS NULL OR damage = 'truncated'"


def damages(spark: SparkSession, arc_path: str) -> DataFrame:
    """``archive, offset, damage, url, bytes`` of every damaged place in ARC files."""
    found = read_arc(spark, arc_path).where("damage IS NOT NULL")
    return found.select("archive", "offset", "damage", "url", F.coalesce(
        F.octet_length("head") + F.octet_length("payload"), F.lit(0)).cast("long").alias("bytes"))


def refers_to_page(read_back: DataFrame, name: Column | str = "refers_to") -> DataFrame:
    """Read-back records with the page id of the response that a revisit refers to, found
    by its record id.  The responses referred to are one row per repeated payload."""
    asked = read_back.where("refers_to_record IS NOT NULL").select(
        F.col("refers_to_record").alias("__asked")).distinct()
    targets = (read_back.select(F.col("record_id").alias("__id"), F.col("page_id").alias("__page"))
               .join(asked, F.col("__id") == F.col("__asked"), "left_semi"))
    return (read_back.join(targets, F.col("refers_to_record") == F.col("__id"), "left")
            .withColumn(name, F.col("__page")).drop("__id", "__page"))
