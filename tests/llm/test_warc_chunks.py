"""Archives are written and read back; contents by a plain byte-wise reading of the files."""

import glob
import gzip
import hashlib
import uuid

import pytest

from strataloom.llm import warc_chunks as W

SCHEMA = "page_id bigint, url string, html string"
LONG = "x" * 120
PAGES = [
    (4, "http://a/4", LONG), (2, "http://a/2", LONG), (9, None, LONG), (1, "http://a b/\r\n1", None), (3, "u", ""), (5, "u", "short"), (6, "u", "short"),
    (7, "u", "é\r\n" * 900 + "\r\n"), (8, "u", "\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n0\r\n\r\n" * 9), (None, "u", LONG), (None, "u", "only null " * 20), (None, "u", "only null " * 20), (2, "u", LONG), (10, "u", "y" * 64), (11, "u", "z" * 65),
]


def expected(rows):
    first = {}
    for i, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(i, first.get(raw, i))
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        f = first.get(raw)
        again = f is not None and f != i
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", f if again else None))
    return sorted(out, key=str)


def read(chunks):
    page = lambda urn: None if urn is None or urn.endswith("null") else int(urn.rpartition(":")[2])
    return sorted(((page(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, page(r.refers_to)) for r in chunks.where("last").collect()), key=str)


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 15])
def test_round_trip_at_every_chunk_size(spark, tmp_path, chunk):
    path = str(tmp_path / "warc")
    W.write_warc(spark.createDataFrame([(*r, "clash") for r in PAGES], SCHEMA + ", digest string"), path, chunk)
    assert read(W.read_chunks(spark, path, data=False)) == expected(PAGES)
    # payloads, put together from their chunk rows
    rows = W.read_chunks(spark, path, chunk=50).orderBy("record_id", "chunk_no").collect()
    assert max(len(r.data) for r in rows) <= 50
    got = {}
    for r in rows:
        if r.record_type == "response" and not r.record_id.endswith(("null", ":2")):
            got[r.record_id] = got.get(r.record_id, b"") + r.data
            assert r.payload_bytes == len(got[r.record_id])
    assert got == {f"urn:x-page:{i}": (h or "").encode() for i, _, h in PAGES if i not in (None, 2, 4, 9)}


def test_files_are_plain_warc(spark, tmp_path):
    """Each record begins where the Content-Length of the one before says, followed by two line ends."""
    path = str(tmp_path / "warc")
    W.write_warc(spark.createDataFrame(PAGES, SCHEMA), path, 16)
    records = 0
    for f in glob.glob(path + "/part*.gz"):
        raw, at = gzip.open(f).read(), 0
        while at < len(raw):
            head, _, _ = raw[at:].partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
            at += len(head) + 4 + int(fields[b"Content-Length"])
            assert raw[at : at + 4] == b"\r\n\r\n"
            at += 4
            records += 1
    assert records == len(PAGES)


def test_bodies_without_transfer_coding_and_other_types():
    body = b"line\r\n\r\nend"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    raw = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 7\r\n\r\na: b\r\nc\r\n\r\n" + b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(http) + http + b"\r\n\r\n" + b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    p = W.Parser(4)
    rows = [r for line in raw.removesuffix(b"\r\n").split(b"\r\n") for r in p.line(line)]
    assert b"".join(r[5] for r in rows if r[1] == "response") == body
    assert [(r[1], r[6]) for r in rows if r[8]] == [("warcinfo", 7), ("response", len(body)), ("metadata", 0)]


def test_damaged_archives_are_refused(spark, tmp_path):
    path = str(tmp_path / "warc")
    W.write_warc(spark.createDataFrame([(1, "u", "payload")], SCHEMA).coalesce(1), path)
    (f,) = glob.glob(path + "/part*.gz")
    whole = gzip.open(f).read()
    for k, raw in enumerate((whole.replace(b"payload", b"paylaod"), whole[:-20])):
        other = tmp_path / str(k)
        other.mkdir()
        with gzip.open(other / f"{uuid.uuid4().hex}.txt.gz", "wb") as g:
            g.write(raw)
        with pytest.raises(Exception, match="differs from its digest|ends inside a record"):
            W.read_chunks(spark, str(other)).collect()


def test_a_long_payload_and_an_empty_table(spark, tmp_path):
    rows = [(1, "u", "äb\n" * 3_000_000), (2, "u", "äb\n" * 3_000_000)]
    W.write_warc(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "long"))
    assert read(W.read_chunks(spark, str(tmp_path / "long"))) == expected(rows)
    W.write_warc(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"))
    assert read(W.read_chunks(spark, str(tmp_path / "none"))) == []
