"""Legacy ARC archives to WARC.

ARC headers of version 1 (5 fields) and 2 (10 fields) are parsed with their declared lengths; each record becomes a WARC record
with a synthesised identifier, timestamp, type and digests. Files are rows (path, content), as Spark's binaryFile source gives
them, plain or gzipped, so inputs may be in any store; a file is decompressed and parsed as a stream, record after record. Repeated
payloads become revisits of one response: only digests are compared, payloads never meet. WARC files are written by Spark's own
writer, so a lost executor leaves no half file; they hold a bounded number of bytes, and each record is a gzip member of its own.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm.common import bounded, materialize, partitions, shared_dir

#: Smallest payload for which a revisit is written.
LEAST_REVISIT = 1000
#: Bytes of an ARC file made by to_arc, about.
ARC_BYTES = 8 << 20
#: Bytes of payload in a WARC file, about; a file holds one record at least.
FILE_BYTES = 256 << 20
#: Bytes of a gzip member at most. Its last byte, the highest of its length, is then zero.
_MEMBER = (16 << 20) - 1
DATE = "20240101000000"
_FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

RECORD = "record_id string, type string, uri string, date string, ip string, content_type string, http binary, payload binary, payload_bytes long, payload_digest string, page_id long, refers_to string, error string"
_NAMES = [x.split()[0] for x in RECORD.split(", ")]
_KINDS = {"http": pa.binary(), "payload": pa.binary(), "payload_bytes": pa.int64(), "page_id": pa.int64()}


def _batch(rows: list[dict], names: list[str] | None = None) -> pa.RecordBatch:
    names = names or _NAMES
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], _KINDS.get(n, pa.string())) for n in names], names)


def _to_arc(batches: Iterator[pa.RecordBatch], date: str) -> Iterator[pa.RecordBatch]:
    held: list[bytes] = []
    size, made = 0, 0
    task = TaskContext.get()
    part = task.partitionId() if task else 0

    def file() -> pa.RecordBatch:
        version = 1 + made % 2
        name = f"pages-{part:05d}-{made:05d}.arc"
        about = f"{version} 0 pages\n{_FIELDS[version]}\n".encode()
        more = b"" if version == 1 else f" 200 - - 0 {name}".encode()
        head = f"filedesc://{name} 0.0.0.0 {date} text/plain".encode() + more + b" %d\n" % len(about) + about
        out, at = [head, b"\n"], len(head) + 1
        for url, body in held:
            more = b"" if version == 1 else b" 200 %s - %d %s" % (hashlib.sha1(body).hexdigest().encode(), at, name.encode())
            record = url + b" 0.0.0.0 " + date.encode() + b" text/html" + more + b" %d\n" % len(body) + body + b"\n"
            out.append(record)
            at += len(record)
        return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([b"".join(out)], pa.binary())], ["path", "content"])

    for batch in batches:
        ids, urls, pages = (batch.column(c) for c in ("page_id", "url", "html"))
        for i in range(len(batch)):
            html = (pages[i].as_py() if pa.types.is_binary(pages.type) else pages[i].cast(pa.binary()).as_py()) or b""
            url = "%20".join((urls[i].as_py() or "about:blank").split()).encode()
            page = ids[i].as_py()
            head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if page is None else page}\r\nContent-Length: {len(html)}\r\n\r\n".encode()
            held.append((url or b"about:blank", head + html))
            size += len(html)
            if size >= ARC_BYTES:
                yield file()
                held, size, made = [], 0, made + 1
    if held:
        yield file()


def to_arc(pages: DataFrame, date: str = DATE) -> DataFrame:
    """pages (page_id, url, html) as ARC files (path, content), of version 1 and 2 by turns; the html is UTF-8, null is empty."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("binary").alias("html"))
    return bounded(rows).mapInArrow(lambda it: _to_arc(it, date), "path string, content binary")


def _iso(date: str) -> str:
    d = (date + "0" * 14)[:14] if date.isdigit() and len(date) >= 8 else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _http(body: bytes) -> tuple[bytes, bytes]:
    """HTTP head with its blank line, and payload; a body of another kind has no head."""
    if not body.startswith(b"HTTP/"):
        return b"", body
    for mark in (b"\r\n\r\n", b"\n\n"):
        at = body.find(mark)
        if at >= 0:
            return body[: at + len(mark)], body[at + len(mark) :]
    return body, b""


def _field(head: bytes, name: bytes) -> str | None:
    for line in head.splitlines():
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name:
            return value.strip().decode("utf-8", "replace")
    return None


def _number(text: str | None) -> int | None:
    try:
        return int(text) if text else None
    except ValueError:
        return None


def _opened(content: bytes) -> io.BufferedIOBase:
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BufferedReader(io.BytesIO(content))


def _parsed(content: bytes, parse) -> Iterator[dict]:
    """Rows of one file; where its compression breaks off, a row that says so ends it."""
    with _opened(content) as f:
        try:
            yield from parse(f)
        except (EOFError, OSError, zlib.error) as e:
            yield {"type": "error", "error": str(e) or type(e).__name__}


def parse_arc(content: bytes) -> Iterator[dict]:
    """Records of one ARC file. What can't be parsed ends the file with a row that says so."""
    return _parsed(content, _arc)


def _arc(f) -> Iterator[dict]:
    version = 1
    while True:
        at, line = f.tell(), f.readline()
        if not line:
            return
        header = line.rstrip(b"\r\n")
        if not header:
            continue
        if header.startswith(b"filedesc:"):
            version = 2 if f.peek(1)[:1] == b"2" else 1
        parts = header.rsplit(b" ", 4 if version == 1 else 9)
        length = _number(parts[-1].decode("ascii", "replace"))
        if not line.endswith(b"\n") or len(parts) != (5 if version == 1 else 10) or length is None or length < 0:
            yield {"type": "error", "error": f"no ARC header at byte {at}"}
            return
        body = f.read(length)
        uri, ip, date, kind = (p.decode("utf-8", "replace") for p in parts[:4])
        if uri.startswith("filedesc:"):
            continue
        head, payload = _http(body)
        digest = hashlib.sha1(payload).hexdigest()
        name = uuid.uuid5(_SPACE, "|".join([uri, date, digest, hashlib.sha1(head).hexdigest()]))
        yield {
            "record_id": f"<urn:uuid:{name}>", "type": "response" if head or uri.startswith("dns:") else "resource", "uri": uri, "date": _iso(date), "ip": ip, "content_type": "application/http; msgtype=response" if head else kind if "/" in kind else "application/octet-stream",
            "http": head, "payload": payload, "payload_bytes": len(payload), "payload_digest": digest, "page_id": _number(_field(head, b"x-page-id")), "error": "truncated" if len(body) < length else None,
        }


def _records(batches: Iterator[pa.RecordBatch], parse, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            rows: list[dict] = []
            size = 0
            for row in parse(content.as_py() or b""):
                rows.append(row)
                size += len(row.get("payload") or b"")
                if size > ARC_BYTES // 2 or len(rows) >= 5000:
                    yield _batch(rows, names)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, names)


def arc_records(files: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """ARC files (path, content) to WARC fields, one row for each record. columns: the fields that are wanted."""
    names = columns or _NAMES
    schema = ", ".join(x for x in RECORD.split(", ") if x.split()[0] in names)
    names = [x.split()[0] for x in schema.split(", ")]
    return bounded(files).select("content").mapInArrow(lambda it: _records(it, parse_arc, names), schema)


def revisits(records: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """record_id, refers_to: the records whose payload, of ``least`` bytes or more, that of a larger page_id equals.

    Records that tie for the largest page_id stay responses all. A null page_id is less than any other. The largest are written before
    they are joined, so that adaptive execution can split the records of a common payload.
    """
    rows = records.filter(F.col("payload_bytes") >= least).select("record_id", "payload_digest", F.coalesce("page_id", F.lit(-(1 << 63))).alias("page_id"))
    lead = rows.groupBy("payload_digest").agg(F.max("page_id").alias("lead"), F.max_by("record_id", F.struct("page_id", "record_id")).alias("refers_to"), F.count("*").alias("n")).filter("n > 1")
    return rows.join(materialize(lead), "payload_digest").filter("page_id < lead").select("record_id", "refers_to").dropDuplicates(["record_id"])


def _packed(record: bytes) -> bytes:
    """One gzip member, more for a record beyond 16 MB, without the last byte: that is zero, and the writer's line end."""
    out = []
    for k in range(0, len(record), _MEMBER):
        out.append(gzip.compress(record[k : k + _MEMBER], 1, mtime=0))
    return b"".join(out)[:-1]


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = True
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if first:
                about = b"software: archive converter\r\nformat: WARC File Format 1.0\r\n"
                name = uuid.uuid5(_SPACE, f"info|{r['record_id']}")
                out.append(_packed(f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{name}>\r\nWARC-Date: {r['date']}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(about)}\r\n\r\n".encode() + about + b"\r\n\r\n"))
                first = False
            block = r["http"] + (b"" if r["refers_to"] else r["payload"])
            head = ["WARC/1.0", f"WARC-Type: {'revisit' if r['refers_to'] else r['type']}", f"WARC-Record-ID: {r['record_id']}", f"WARC-Date: {r['date']}", f"WARC-Target-URI: {r['uri']}", f"WARC-IP-Address: {r['ip']}"]
            if r["refers_to"]:
                head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {r['refers_to']}"]
            if r["error"]:
                head += ["WARC-Truncated: length"]
            digest = base64.b32encode(bytes.fromhex(r["payload_digest"])).decode()
            head += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}", f"Content-Type: {r['content_type']}", f"Content-Length: {len(block)}"]
            out.append(_packed("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"))
        blob = pa.array(out, pa.binary())
        yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.string(), len(blob), blob.buffers())], ["value"])


def write_warc(records: DataFrame, path: str) -> None:
    """One WARC file for each partition that has rows, its records gzip members, a warcinfo record in front. Error rows are left out.

    Rows go through Spark's text writer as bytes; a partition must hold what a file may, see :func:`convert`.
    """
    rows = bounded(records.filter("type != 'error'")).mapInArrow(_render, "value string")
    rows.write.option("compression", "none").option("lineSep", "\x00").text(path)


def parse_warc(content: bytes) -> Iterator[dict]:
    """Records of one WARC file, gzipped or not, save warcinfo."""
    return _parsed(content, _warc)


def _warc(f) -> Iterator[dict]:
    while True:
        at, line = f.tell(), f.readline()
        if not line:
            return
        if not line.strip():
            continue
        head = []
        while line.strip():
            head.append(line)
            line = f.readline()
        head = b"".join(head)
        length = _number(_field(head, b"content-length"))
        if not head.startswith(b"WARC/") or length is None:
            yield {"type": "error", "error": f"no WARC header at byte {at}"}
            return
        block = f.read(length)
        kind = _field(head, b"warc-type")
        if kind == "warcinfo":
            continue
        http, payload = _http(block)
        digest = _field(head, b"warc-payload-digest")
        digest = base64.b32decode(digest.partition(":")[2]).hex() if digest else hashlib.sha1(payload).hexdigest()
        if kind == "revisit":
            size = _number(_field(http, b"content-length"))
        else:
            size = len(payload)
            if hashlib.sha1(payload).hexdigest() != digest:
                yield {"type": "error", "error": f"payload digest of {_field(head, b'warc-record-id')} does not hold"}
                continue
        yield {
            "record_id": _field(head, b"warc-record-id"), "type": kind, "uri": _field(head, b"warc-target-uri"), "date": _field(head, b"warc-date"), "ip": _field(head, b"warc-ip-address"), "content_type": _field(head, b"content-type"), "http": http, "payload": payload, "payload_bytes": size,
            "payload_digest": digest, "page_id": _number(_field(http, b"x-page-id")), "refers_to": _field(head, b"warc-refers-to"), "error": "truncated" if _field(head, b"warc-truncated") else None,
        }


def read_warc(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    names = columns or _NAMES
    schema = ", ".join(x for x in RECORD.split(", ") if x.split()[0] in names)
    names = [x.split()[0] for x in schema.split(", ")]
    files = spark.read.format("binaryFile").load(path)
    return bounded(files).select("content").mapInArrow(lambda it: _records(it, parse_warc, names), schema)


def convert(files: DataFrame, path: str, least: int = LEAST_REVISIT, file_bytes: int = FILE_BYTES) -> None:
    """ARC files (path, content) to WARC files of about ``file_bytes`` under path; repeated payloads become revisits.

    Files are read twice, for the digests and for the records, and not stored in between. Empty and truncated files, records
    without payload and repeated records are converted as they are; files are independent. Other columns are not read.
    """
    small = materialize(arc_records(files, ["record_id", "payload_bytes", "payload_digest", "page_id"]).filter("record_id is not null"))
    again = materialize(revisits(small, least))
    held = small.agg(F.sum("payload_bytes")).first()[0] or 0
    n = max(partitions(files.sparkSession), -(-held // file_bytes))  # records are hashed, so files are of about equal size
    records = arc_records(files).drop("refers_to").repartition(n, "record_id")
    write_warc(records.join(again, "record_id", "left"), path)


def convert_pages(pages: DataFrame) -> DataFrame:
    """Pages as ARC, converted and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    pages (page_id, url, html): null html is an empty payload, a null url about:blank; a null page_id comes back as null. Rows that
    repeat are records each, and all responses where they tie for the largest page_id. Html is kept whole, however long. Other columns,
    whatever their names, are not read. An empty table gives no file and an empty result.
    """
    spark = pages.sparkSession
    path = shared_dir(spark)
    convert(to_arc(pages), path)
    fields = ["record_id", "type", "payload_bytes", "payload_digest", "page_id", "refers_to"]
    back = materialize(read_warc(spark, path, fields))
    lead = materialize(back.filter("refers_to is null").select(F.col("record_id").alias("refers_to"), F.col("page_id").alias("__lead")).dropDuplicates(["refers_to"]))
    about = ["page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type")]
    again = back.filter("refers_to is not null").join(lead, "refers_to", "left").select(*about, F.col("__lead").alias("refers_to"))
    return again.unionByName(back.filter("refers_to is null").select(*about, F.lit(None).cast("long").alias("refers_to")))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT payload_digest, max(page_id) AS lead FROM d WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, d.payload_digest, CASE WHEN lead > page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN lead > page_id THEN lead END AS refers_to
FROM d LEFT JOIN m ON d.payload_digest = m.payload_digest
"""
