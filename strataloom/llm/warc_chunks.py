"""WARC archives of pages, written and read as a table of record chunks.

Writing: a page is a WARC/1.1 record. A response's payload is the body of an HTTP message in chunked
transfer coding, so that the rows that go to the writer are (record, chunk number) rows of at most
``CHUNK`` bytes, never a whole record: lengths are known from the payload's length alone. A page whose
payload (of at least ``REVISIT_BYTES``) another page of smaller page_id has is a ``revisit`` record
with headers only. Rows are written by Spark's text writer with CRLF between them and gzip over a
file; each task writes its own files, and Spark's commit makes them visible.

Reading: the lines of an archive pass through one task in order (a gzip file is not split); the parser
keeps its state between lines and between batches and gives rows (record_id, chunk_no, data) with the
number of payload bytes so far; the SHA-256 of a payload is updated chunk by chunk and stands in the
record's last row, where it must equal the digest in the header. At most one chunk is held besides
the rows of a batch. Bodies without transfer coding, and records of other types, are read too.

Scale: two scans of the pages. The first shuffles digests only (partially aggregated, so that many
copies of one payload are a row a task); what has copies is stored, and the second scan joins it,
by broadcast where Spark knows that it is small. A file holds what one task writes.

Defined results: a null html is empty; a null url is an empty target; control characters and spaces of a url
are percent-encoded. All rows that hold the smallest page_id of a payload are responses; a null page_id is
larger than every other and refers to null where no other page has the payload. Repeated rows are
repeated records with one record id. An empty table writes no record and reads as an empty table.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm.common import shared_dir, stored, table

CHUNK, REVISIT_BYTES = 1 << 15, 100
#: Pages carry no time of capture.
DATE = "1970-01-01T00:00:00Z"
_URN = "urn:x-page:"
CHUNK_SCHEMA = "record_id string, record_type string, target_uri string, refers_to string, chunk_no bigint, data binary, payload_bytes bigint, payload_digest string, last boolean"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _uri(url: Column) -> Column:
    """url in one header line."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    out = url
    for code in (*range(33), 127):
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x20\x7f]"), out).otherwise(url)


def _hex(n: Column) -> Column:
    return F.lower(F.hex(n))


def decided(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with payload, n, digest, and refers_to: the page_id of the response that
    a revisit repeats; is_response."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    p = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").alias("url"), payload.alias("payload"))
    p = p.withColumns({"n": F.octet_length("payload").cast("bigint"), "digest": F.sha2("payload", 256)})
    long = p.where(F.col("n") >= REVISIT_BYTES)
    copies = stored(long.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("holders")).where("holders > 1").drop("holders"), "warc-copies")
    out = p.join(copies, "digest", "left")
    response = F.col("refers_to").isNull() | F.col("page_id").eqNullSafe(F.col("refers_to"))
    return out.withColumn("is_response", response).withColumn("refers_to", F.when(~response, F.col("refers_to")))


def record_rows(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The archive's rows, of at most one chunk each, in order inside their partition."""
    d, n, crlf = decided(pages), F.col("n"), "\r\n"
    full, rest = F.expr(f"n div {chunk}"), n % chunk
    coded = full * (len(f"{chunk:x}") + 4 + chunk) + F.when(rest > 0, F.length(_hex(rest)) + 4 + rest).otherwise(0) + 5
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), F.when(F.col("is_response"), F.lit("Transfer-Encoding: chunked")).otherwise(F.concat(F.lit("Content-Length: "), n.cast("string"))), F.lit(crlf))
    urn = lambda c: F.concat(F.lit(f"<{_URN}"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    kind = F.when(F.col("is_response"), F.lit("response")).otherwise(F.lit("revisit"))
    length = F.length(http) + 2 + F.when(F.col("is_response"), coded).otherwise(0)
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), kind, F.lit(crlf + "WARC-Record-ID: "), urn(F.col("page_id")), F.lit(f"\r\nWARC-Date: {DATE}\r\nWARC-Target-URI: "), _uri(F.col("url")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"), F.when(F.col("is_response"), F.lit("")).otherwise(F.concat(F.lit("\r\nWARC-Refers-To: "), urn(F.col("refers_to")), F.lit(f"\r\nWARC-Profile: {_PROFILE}"))),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), length.cast("string"), F.lit(crlf * 2), http, F.when(F.col("is_response"), F.lit("")).otherwise(F.lit(crlf * 2)),
    )
    n_chunks = F.when(F.col("is_response"), full + F.when(rest > 0, 1).otherwise(0) + 1).otherwise(0)
    rows = d.select("payload", "n", head.alias("head"), n_chunks.alias("k"), F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks)).alias("i"))
    at = (F.col("i") - 1) * chunk
    piece = F.substring(F.col("payload"), (at + 1).cast("int"), F.lit(chunk))
    body = F.concat(_hex(F.least(F.lit(chunk), n - at)), F.lit(crlf), piece.cast("string"))
    return rows.select(F.when(F.col("i") == 0, F.col("head")).when(F.col("i") == F.col("k"), F.lit("0" + crlf * 3)).otherwise(body).alias("value"))


def write_warc(pages: DataFrame, path: str, chunk: int = CHUNK) -> None:
    """Archives of all pages in a folder, one gzip file for each task."""
    record_rows(pages, chunk).write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


class Parser:
    """Lines (without their CRLF) of one archive in order -> chunk rows."""

    def __init__(self, chunk: int = CHUNK):
        self.chunk, self.state = chunk, "between"

    def line(self, line: bytes) -> Iterator[tuple]:
        state = self.state
        if state == "between":
            if line.startswith(b"WARC/"):
                self.state, self.headers = "warc", {}
            elif line:
                raise ValueError(f"a WARC record was expected, not {line[:60]!r}")
        elif state == "warc":
            if line:
                name, _, value = line.partition(b":")
                self.headers[name.strip().lower()] = value.strip().decode("utf-8", "replace")
            else:
                yield from self.open()
        else:
            yield from self.block(line + b"\r\n")

    def open(self) -> Iterator[tuple]:
        h = self.headers
        self.left = int(h[b"content-length"])
        self.http, self.sha, self.size, self.no, self.buffer = {}, hashlib.sha256(), 0, 0, bytearray()
        self.state = "http" if h.get(b"content-type", "").startswith("application/http") else "body"
        self.need = 0
        if not self.left:
            yield from self.close()

    def block(self, raw: bytes) -> Iterator[tuple]:
        """raw belongs to the block, up to its last byte; what follows is the end of the record."""
        raw, after = raw[: self.left], raw[self.left :]
        self.left -= len(raw)
        if after not in (b"", b"\r\n"):
            raise ValueError("a record is longer than its Content-Length")
        if self.state == "http":
            line = raw.rstrip(b"\r\n")
            if line:
                name, _, value = line.partition(b":")
                self.http[name.strip().lower()] = value.strip().decode("utf-8", "replace")
            else:
                self.state = "size" if self.http.get(b"transfer-encoding", "").lower() == "chunked" else "body"
        elif self.state == "size":
            self.need = int(raw.split(b";")[0], 16)
            self.state = "data" if self.need else "trailer"
        elif self.state == "data":
            body, end = raw[: self.need], raw[self.need :]
            self.need -= len(body)
            yield from self.add(body)
            if not self.need:
                self.state = "size" if end else "data-end"
        elif self.state == "data-end":
            self.state = "size"
        elif self.state == "body":
            yield from self.add(raw)
        if not self.left:
            yield from self.close()

    def add(self, body: bytes) -> Iterator[tuple]:
        self.buffer += body
        while len(self.buffer) > self.chunk:
            yield self.row(bytes(self.buffer[: self.chunk]), False)
            del self.buffer[: self.chunk]

    def row(self, data: bytes, last: bool) -> tuple:
        h, kind = self.headers, self.headers.get(b"warc-type", "")
        self.sha.update(data)
        self.size += len(data)
        size, stated = self.size, h.get(b"warc-payload-digest", "").removeprefix("sha256:") or None
        digest = self.sha.hexdigest() if last else None
        if last and kind == "revisit":
            size, digest = int(self.http.get(b"content-length", 0)), stated
        elif last and kind == "response" and stated is not None and stated != digest:
            raise ValueError(f"payload of {h.get(b'warc-record-id')} differs from its digest")
        self.no += 1
        return h.get(b"warc-record-id", "").strip("<>"), kind, h.get(b"warc-target-uri", ""), h.get(b"warc-refers-to", "").strip("<>") or None, self.no - 1, data, size, digest, last

    def close(self) -> Iterator[tuple]:
        yield self.row(bytes(self.buffer), True)
        self.buffer, self.state = bytearray(), "between"


def read_chunks(spark: SparkSession, path: str, data: bool = True, chunk: int = CHUNK) -> DataFrame:
    """All records of the gzip archives under path as CHUNK_SCHEMA rows, a record's in order; without
    data the payload stays in the task and only its size and digest come out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser, archive, out, held = None, None, [], 0
        types = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_())
        names = ("record_id", "record_type", "target_uri", "refers_to", "chunk_no", "data", "payload_bytes", "payload_digest", "last")

        def emit() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

        for b in batches:
            for value, name, start in zip(b.column("value"), b.column("archive").to_pylist(), b.column("start").to_pylist(), strict=True):
                if start:
                    raise ValueError("an archive that is not compressed was split: read it as gzip")
                if name != archive:
                    if parser is not None and parser.state != "between":
                        raise ValueError("an archive ends inside a record")
                    parser, archive = Parser(chunk), name
                for r in parser.line(value.as_py()):
                    out.append(r if data else (*r[:5], None, *r[6:]))
                    held += len(r[5]) * data + 100
                    if held > 1 << 22:
                        yield emit()
                        out, held = [], 0
        if parser is not None and parser.state != "between":
            raise ValueError("an archive ends inside a record")
        if out:
            yield emit()

    lines = spark.read.option("lineSep", "\r\n").text(path).select(F.col("value").cast("binary").alias("value"), F.xxhash64("_metadata.file_path").alias("archive"), F.col("_metadata.file_block_start").alias("start"))
    return lines.mapInArrow(rows, CHUNK_SCHEMA)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/strataloom-warc-{uuid.uuid4().hex}"
    write_warc(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    page = lambda c: F.substring_index(F.col(c), ":", -1).try_cast("bigint")
    return read_chunks(spark, path, data=False).where("last").select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


OP12_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id FROM p
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN first_id IS NULL OR first_id IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM f
"""
