"""WARC archives: writing captures, reading records, and assembling transactions.

Writing: every page is a capture of three records, gzipped each for itself: a response (or a revisit, where
an equal payload stands elsewhere), its request, and its metadata; request and metadata name the response in
WARC-Concurrent-To. A task writes one file under a name of its own attempt and reports it; the reports are written
as a table, and only files named there are archives, so lost or repeated attempts leave no trace.

Assembly: each response, revisit or resource is a capture; request and metadata records reach it through
their concurrent-to identifier, or through the identifier that the capture itself names, or through a request
that does; every capture gives one nested row. Records that reach no capture give a row of their own.

Defined results: a null html is the empty payload; a page_id that is null is written as such and read back as
null; a page without url has no target; rows that repeat a page_id and payload are a capture each; an empty table
gives no archive and no rows; other columns are not read. Of equal payloads the one with the largest page_id is the
response (all rows that share that page_id are); where all page_ids are null all are.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import shared_path, whole_text, written

_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"
_READ = 1 << 20
#: Scheme, host, path and query of an address (RFC 3986, appendix B); every text matches.
_ADDRESS = re.compile(r"(?:[^:/?#]+:)?(?://([^/?#]*))?([^?#]*)(\?[^#]+)?")

RECORDS = (
    "archive string, record_id string, type string, target string, concurrent_to array<string>, refers_to string, "
    "content_type string, block_bytes long, payload_bytes long, payload_digest string, fields map<string,string>, payload binary"
)


def record(kind: str, headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record, as a gzip member of its own."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(lines).encode() + _END) + pack.compress(block) + pack.compress(_END) + pack.flush()


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _id(kind: str, page: int | None, digest: str) -> str:
    return f"<urn:page:{kind}:{'' if page is None else page}:{digest}>"


def capture(page: int | None, url: str | None, payload: bytes, digest: str, revisits: int | None) -> bytes:
    """The three records of a page; ``revisits`` is the page whose response holds an equal payload."""
    kind = "response" if revisits is None else "revisit"
    own = _id(kind, page, digest)
    common = [("WARC-Date", _DATE), ("WARC-Target-URI", None if url is None else " ".join(url.split()))]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if revisits is not None:
        headers += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _id("response", revisits, digest))]
    host, path, query = _ADDRESS.match("".join(c for c in url or "" if c.isprintable())).groups("")
    ask = f"GET {path or '/'}{query} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    told = f"page_id: {'' if page is None else page}\r\npayload_bytes: {len(payload)}\r\n".encode()
    return b"".join([
        record(kind, headers, http + (payload if revisits is None else b"")),
        record("request", [("WARC-Record-ID", _id("request", page, digest)), *common, ("WARC-Concurrent-To", own), ("Content-Type", "application/http; msgtype=request")], ask),
        record("metadata", [("WARC-Record-ID", _id("metadata", page, digest)), *common, ("WARC-Concurrent-To", own), ("Content-Type", "application/warc-fields")], told),
    ])


def write_archives(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the pages (page_id, url, html); (path, records) for each archive. Payloads of fewer than ``least_bytes``
    bytes are never revisits."""
    folder = shared_path(pages.sparkSession, "warc")
    payload = F.encode(whole_text("html"), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.length("payload"))
    equal = rows.filter(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    equal = written(equal.filter("n > 1").drop("n"), "warc-equal")
    rows = rows.join(equal, ["digest", "size"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    rows = rows.select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("revisits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, path, n = TaskContext.get(), None, "", 0
        for batch in batches:
            for page, url, data, revisits in zip(*(batch.column(k) for k in range(4)), strict=True):
                if out is None:
                    path = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"
                    files, at = pafs.FileSystem.from_uri(path)
                    files.create_dir(at.rpartition("/")[0], recursive=True)
                    out = files.open_output_stream(at, compression=None, buffer_size=1 << 20)
                body = data.as_py()
                out.write(capture(page.as_py(), url.as_py(), body, sha1_base32(body), revisits.as_py()))
                n += 3
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([n], pa.int64())})

    return written(rows.mapInArrow(run, "path string, records long"), "warc-archives")


def members(path: str) -> Iterator[bytes]:
    """The records of an archive, one at a time, gzipped each or as a whole or not at all."""
    files, at = pafs.FileSystem.from_uri(path)
    with files.open_input_stream(at, compression=None) as file:
        held, plain, unpack = b"", bytearray(), None
        first = True
        while True:
            data = held or file.read(_READ)
            held = b""
            if first and data:
                packed, first = data[:2] == b"\x1f\x8b", False
            if not data:
                break
            if not packed:
                plain += data
            else:
                unpack = unpack or zlib.decompressobj(31)
                plain += unpack.decompress(data)
                if unpack.eof:
                    held, unpack = unpack.unused_data, None
            yield from _complete(plain)
        if unpack is not None or plain.strip():
            raise ValueError(f"archive ends within a record: {path}")


def _complete(plain: bytearray) -> Iterator[bytes]:
    """Takes whole records off the front."""
    while (head := plain.find(_END)) >= 0:
        length = next((int(x.partition(b":")[2]) for x in plain[:head].split(b"\r\n") if x.lower().startswith(b"content-length:")), 0)
        end = head + 4 + length
        if len(plain) < end + 4:
            return
        one = bytes(plain[:end])
        del plain[: end + 4]
        yield one


def parsed(archive: str, one: bytes, with_payload: bool) -> dict:
    """A record as a row of ``RECORDS``. Payload figures are those of the bytes read; a revisit has its digest from its header."""
    head, _, block = one.partition(_END)
    headers: dict[str, list[str]] = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        headers.setdefault(name.strip().lower(), []).append(value.strip())
    get = lambda name: headers.get(name, [None])[0]
    kind, content, body, fields = get("warc-type"), get("content-type") or "", None, None
    if kind in ("response", "resource", "conversion"):
        body = block.partition(_END)[2] if content.startswith("application/http") else block
    if content.startswith("application/warc-fields"):
        fields = [(a.strip(), b.strip()) for a, _, b in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n")) if a.strip()]
        fields = list(dict(fields).items())
    digest = sha1_base32(body) if body is not None else (get("warc-payload-digest") or "").rpartition(":")[2] or None
    return {
        "archive": archive, "record_id": get("warc-record-id"), "type": kind, "target": get("warc-target-uri"), "concurrent_to": headers.get("warc-concurrent-to", []),
        "refers_to": get("warc-refers-to"), "content_type": content, "block_bytes": len(block), "payload_bytes": None if body is None else len(body),
        "payload_digest": digest, "fields": fields, "payload": body if with_payload else None,
    }


_ARROW = pa.schema([
    ("archive", pa.string()), ("record_id", pa.string()), ("type", pa.string()), ("target", pa.string()), ("concurrent_to", pa.list_(pa.string())), ("refers_to", pa.string()),
    ("content_type", pa.string()), ("block_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("fields", pa.map_(pa.string(), pa.string())), ("payload", pa.binary()),
])


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives in ``archives`` (path). Each archive is read by one task, record by record, and there
    are as many tasks as archives: the number is given, as the paths' few bytes would be merged into one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                for one in members(path):
                    rows.append(parsed(path, one, with_payload))
                    held += len(one) if with_payload else 500
                    if held > 1 << 24:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return archives.select("path").repartitionByRange(max(1, archives.count()), "path").mapInArrow(run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One row for each capture: capture_id, and the records as structs ``response``, ``request``, ``metadata``.
    ``response`` is the response, revisit, resource or conversion; of several requests or metadata records of a
    capture the least record_id stands in the row."""
    main = F.col("type").isin("response", "revisit", "resource", "conversion")
    whole = F.struct(*records.columns)
    captures = records.filter(main).select(F.col("record_id").alias("capture_id"), "concurrent_to", whole.alias("response"))
    others = records.filter(~main & F.col("type").isin("request", "metadata"))
    named = captures.select("capture_id", F.explode("concurrent_to").alias("record_id"))
    targets = others.select("record_id", "type", F.explode_outer("concurrent_to").alias("to"))
    known = captures.select(F.col("capture_id").alias("to"), "capture_id").distinct()
    direct = targets.join(known, "to").select("record_id", "capture_id").unionByName(others.select("record_id").join(named, "record_id").select("record_id", "capture_id"))
    direct = direct.groupBy("record_id").agg(F.min("capture_id").alias("capture_id"))
    hop = targets.join(direct.select(F.col("record_id").alias("to"), F.col("capture_id")), "to").join(direct.select("record_id"), "record_id", "left_anti")
    reach = direct.unionByName(hop.groupBy("record_id").agg(F.min("capture_id").alias("capture_id")))
    placed = others.withColumn("whole", whole).join(reach, "record_id", "left").withColumn("key", F.coalesce("capture_id", "record_id"))
    pick = lambda kind: F.min_by(F.when(F.col("type") == kind, F.col("whole")), F.when(F.col("type") == kind, F.col("record_id"))).alias(kind)
    grouped = placed.groupBy("key").agg(pick("request"), pick("metadata"))
    joined = captures.join(grouped, captures["capture_id"] == grouped["key"], "full_outer")
    return joined.select(F.coalesce("capture_id", "key").alias("capture_id"), "response", "request", "metadata")


def assemble_written(records: DataFrame) -> DataFrame:
    """``assemble`` over the records as a written table, so that the archives are read once."""
    return assemble(written(records, "warc-records"))
