"""Legacy archive conversion: ARC files (version 1 and 2) to WARC 1.1 files, with revisit records.

An ARC file opens with a ``filedesc:`` record whose block names the version and the fields of every later header
line; records follow, each a header line and a block of the declared length.  The converter reads ARC files with
Spark's binary reader, streams the (gzipped) bytes, cuts records by their declared lengths, and synthesises WARC
records: a stable ``urn:uuid`` from target, date and payload digest, the date in ISO form, and the type:
of records whose payloads are equal and large enough, the one of the largest page id is ``response`` and the others
are ``revisit`` and keep their HTTP header only.  All files are written by Spark under the shared folder, so a lost
task is written again; nothing is written from Python.

Defined cases: a null or empty payload is an empty block; a null URL becomes ``urn:none``, and white space in a URL
is percent-encoded; a null page id sorts below every other; rows that share the largest page id are all
``response``; an empty table makes an archive without records; other columns of the pages are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path

REVISIT_BYTES = 1000
SALTS = 16
CRLF = "\r\n"
# Fixed values of the ARC format: the header line's fields by version.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"],
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122's namespace of URLs
DATE14 = "20010203040506"
ARC_SCHEMA = ("url string, ip string, date14 string, mime string, http binary, payload binary, "
              "payload_bytes long, payload_digest string, page_id long")
WARC_SCHEMA = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
               "record_id string, target string, record_date string")


# ------------------------------------------------------------------ bytes
class _Stream:
    """Reads lines and blocks of a whole file's bytes, gzipped (any number of members) or plain, a piece at a time."""

    def __init__(self, data: bytes, step: int = 1 << 16):
        self.data, self.at, self.step, self.buffer = memoryview(data), 0, step, bytearray()
        self.gzip = bytes(self.data[:2]) == b"\x1f\x8b"
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.gzip and self.inflate.eof:
            rest = self.inflate.unused_data
            self.at -= len(rest)
            self.inflate = zlib.decompressobj(31)
        if self.at >= len(self.data):
            return False
        piece = self.data[self.at:self.at + self.step]
        self.at += len(piece)
        self.buffer += self.inflate.decompress(piece) if self.gzip else piece
        return True

    def line(self) -> bytes | None:
        """The next line with its end, or None at the end of the file."""
        start = 0
        while (cut := self.buffer.find(b"\n", start)) < 0:
            start = len(self.buffer)
            if not self._more():
                cut = len(self.buffer) - 1
                break
        out = bytes(self.buffer[:cut + 1])
        del self.buffer[:cut + 1]
        return out or None

    def block(self, size: int) -> bytes:
        while len(self.buffer) < size and self._more():
            pass
        if len(self.buffer) < size:
            raise ValueError(f"truncated archive: a block declares {size} bytes, {len(self.buffer)} are left")
        out = bytes(memoryview(self.buffer)[:size])
        del self.buffer[:size]
        return out


def arc_version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 tessera\n{' '.join(ARC_FIELDS[version])}\n".encode()
    values = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": DATE14, "Content-type": "text/plain",
              "Result-code": "200", "Checksum": "-", "Location": "-", "Offset": "0", "Filename": name,
              "Archive-length": str(len(body))}
    return " ".join(values[f] for f in ARC_FIELDS[version]).encode() + b"\n" + body


def arc_record(version: int, name: str, page_id: int | None, url: str | None, html: str | None) -> bytes:
    payload = (html or "").encode("utf-8", "replace")
    ident = "" if page_id is None else f"X-Page-Id: {page_id}{CRLF}"
    block = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{ident}Content-Length: {len(payload)}{CRLF}{CRLF}".encode() + payload
    values = {"URL": quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "urn:none", "IP-address": "192.0.2.1",
              "Archive-date": DATE14, "Content-type": "text/html", "Result-code": "200", "Checksum": "-", "Location": "-",
              "Offset": "0", "Filename": name, "Archive-length": str(len(block))}
    return " ".join(values[f] for f in ARC_FIELDS[version]).encode() + b"\n" + block


def http_parts(block: bytes) -> tuple[bytes, bytes]:
    """HTTP header with its blank line, and payload; a block without a header is all payload."""
    cut = block.find(b"\r\n\r\n")
    return (block[:cut + 4], block[cut + 4:]) if block[:5] == b"HTTP/" and cut >= 0 else (b"", block)


def http_field(http: bytes, name: bytes) -> bytes | None:
    m = re.search(rb"(?im)^" + re.escape(name) + rb":[ \t]*(.*?)\r?$", http)
    return m[1] if m else None


def read_arc(data: bytes) -> Iterator[dict]:
    """The records of one ARC file, read by the fields that its version block names."""
    stream, fields = _Stream(data), None
    while (head := stream.line()) is not None:
        if not head.strip():
            continue
        values = head.rstrip(b"\r\n").split(b" ")
        if fields is None:  # the version block: its own header line has the same fields, the length always last
            lines = stream.block(int(values[-1])).decode("utf-8", "replace").splitlines()
            if not values[0].startswith(b"filedesc:") or int(lines[0].split()[0]) not in ARC_FIELDS:
                raise ValueError("not an ARC file of version 1 or 2")
            fields = lines[1].split()
            continue
        if len(values) < len(fields):
            raise ValueError(f"ARC header line with {len(values)} of {len(fields)} fields")
        # a space inside the first field is the only kind that real files hold
        extra = len(values) - len(fields)
        values = [b" ".join(values[:extra + 1]), *values[extra + 1:]]
        got = dict(zip(fields, (v.decode("utf-8", "replace") for v in values)))
        http, payload = http_parts(stream.block(int(got["Archive-length"])))
        page = http_field(http, b"X-Page-Id")
        yield dict(url=got["URL"], ip=got["IP-address"], date14=got["Archive-date"], mime=got["Content-type"], http=http,
                   payload=payload, payload_bytes=len(payload), payload_digest=hashlib.sha1(payload).hexdigest(),
                   page_id=int(page) if page else None)


def iso_date(date14: str) -> str:
    d = (date14 + "00000101000000"[len(date14):])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def record_id(url: str, date: str, digest: str, page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{url} {date} {digest} {page_id}')}>"


def base32(digest: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()


def warc_record(r: dict) -> bytes:
    """A WARC record without its closing pair of line ends."""
    date, revisit = iso_date(r["date14"]), r["refers_to"] is not None
    block = r["http"] if revisit else r["http"] + r["payload"]
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(r["url"], date, r["payload_digest"], r["page_id"])),
            ("WARC-Date", date), ("WARC-Target-URI", r["url"]), ("WARC-IP-Address", r["ip"]),
            ("WARC-Payload-Digest", base32(r["payload_digest"])), ("WARC-Block-Digest", base32(hashlib.sha1(block).hexdigest()))]
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(r["refers_url"], iso_date(r["refers_date"]), r["payload_digest"], r["refers_to"])),
                 ("WARC-Refers-To-Target-URI", r["refers_url"]), ("WARC-Refers-To-Date", iso_date(r["refers_date"])),
                 ("X-Refers-To-Page-Id", str(r["refers_to"]))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1" + CRLF + "".join(f"{k}: {v}{CRLF}" for k, v in head) + CRLF).encode() + block


def read_warc(data: bytes) -> Iterator[dict]:
    """The response and revisit records of one WARC file; digests are held against the blocks."""
    stream = _Stream(data)
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:20]!r}")
        head = {}
        while (line := stream.line()) is not None and line.strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            head[k.strip().lower()] = v.strip()
        block = stream.block(int(head["content-length"]))
        if base32(hashlib.sha1(block).hexdigest()) != head["warc-block-digest"]:
            raise ValueError(f"block of {head['warc-record-id']} differs from its digest")
        kind = head["warc-type"]
        if kind not in ("response", "revisit"):
            continue
        http, payload = http_parts(block)
        digest = base64.b32decode(head["warc-payload-digest"].partition(":")[2]).hex()
        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"payload of {head['warc-record-id']} differs from its digest")
        page, size, to = http_field(http, b"X-Page-Id"), http_field(http, b"Content-Length"), head.get("x-refers-to-page-id")
        yield dict(page_id=int(page) if page else None, payload_bytes=len(payload) if kind == "response" else int(size),
                   payload_digest=digest, record_type=kind, refers_to=int(to) if to else None,
                   record_id=head["warc-record-id"], target=head["warc-target-uri"], record_date=head["warc-date"])


# ------------------------------------------------------------------ Spark
def _lines() -> pa.Schema:
    return pa.schema([("record", pa.binary())])


def _write(records: DataFrame, path: str, end: str) -> None:
    """Records as gzipped files, each record followed by ``end``; one pass, by Spark's text writer."""
    (records.select(F.col("record").cast("string")).write.option("lineSep", end).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").text(path))


def _parsed(files: DataFrame, reader, schema: str) -> DataFrame:
    """Rows of each file, in batches of bounded size."""
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for r in reader(content.as_buffer().to_pybytes()):
                    rows.append(r)
                    size += len(r.get("payload", b"")) + 200
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return files.select("content").mapInArrow(run, schema)


def write_arc(pages: DataFrame, path: str) -> None:
    """ARC files of ``pages`` (page_id, url, html), one a partition, of either version by turns."""

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        version, name = 1 + part % 2, f"pages-{part:05d}.arc.gz"
        out, size = [arc_version_block(version, name)], 0
        for batch in batches:
            for page_id, url, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
                out.append(arc_record(version, name, page_id, url, html))
                size += len(out[-1])
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], schema=_lines())
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], schema=_lines())

    _write(pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "record binary"), path, "\n")


def read_arcs(spark, path: str) -> DataFrame:
    return _parsed(spark.read.format("binaryFile").load(path), read_arc, ARC_SCHEMA)


def convert(spark, arc_path: str, warc_path: str, least: int = REVISIT_BYTES) -> None:
    """WARC files of the records of ARC files.

    The groups of equal payloads are found from digests alone (partial sums first, so a digest of a third of all
    records is no burden); only groups of two and more come back, ``SALTS`` rows each, to meet the records.
    """
    records = read_arcs(spark, arc_path)
    groups = (records.where(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
              .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "url", "date14")).alias("m")).where("n > 1")
              .select(F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("b"), F.col("m.page_id").alias("top"),
                      F.col("m.url").alias("refers_url"), F.col("m.date14").alias("refers_date"),
                      F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s")))
    salted = records.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)))
    joined = (salted.join(groups, (F.col("payload_digest") == F.col("d")) & (F.col("payload_bytes") == F.col("b")) & (F.col("salt") == F.col("s")), "left")
              .withColumn("refers_to", F.when(F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top")), F.col("top"))))
    names = ["url", "ip", "date14", "http", "payload", "payload_digest", "page_id", "refers_to", "refers_url", "refers_date"]

    def run(batches):
        for batch in batches:
            out, size = [], 0
            for r in zip(*(batch.column(i) for i in range(len(names)))):
                out.append(warc_record(dict(zip(names, (v.as_py() for v in r)))))
                size += len(out[-1])
                if size > 4_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], schema=_lines())
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], schema=_lines())

    _write(joined.select(*names).mapInArrow(run, "record binary"), warc_path, CRLF + CRLF)


def read_warcs(spark, path: str) -> DataFrame:
    return _parsed(spark.read.format("binaryFile").load(path), read_warc, WARC_SCHEMA)


def op7_legacy_archive_converter(spark, sf_dir: str) -> DataFrame:
    """Pages as ARC files, those converted to WARC files, and the records read back from these."""
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(spark.read.parquet(f"{sf_dir}/pages.parquet"), arc)
    convert(spark, arc, warc)
    return read_warcs(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
m AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY h) END AS top FROM p)
SELECT page_id, n AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to FROM m
"""
