"""WARC archives: writing, reading and transaction assembly (operator 6).

``write_archives`` writes three WARC/1.1 records per page: a request, a response or a
revisit, and a metadata record; the request and the metadata name the response in
WARC-Concurrent-To.  Of pages with equal payloads of at least ``min_bytes`` bytes, the one with
the smallest page_id is a response and the others are revisits without a payload.  Spark's
text writer puts the records into files of about ``FILE_BYTES`` bytes (a record's two closing
line ends are its line separator), gzip-compressed, in the shared folder.

``read_archives`` reads whole files with Spark's binary reader and parses records by their
Content-Length, streaming through the compressed bytes; payloads that look like record
borders are harmless.  ``captures`` joins request, response and metadata through the
concurrent-to identifiers and emits one nested row per capture.

Null html is the empty payload; null urls are kept as null.  Rows with a null page_id are no
captures and are dropped; rows that repeat a page_id and its payload are one capture.  Extra
columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlab.llm import textbytes as tb
from sensorlab.llm.storage import shared_path, written
from sensorlab.session import ship_package

c = F.col

FILE_BYTES = 32 << 20
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"
RECORD_SCHEMA = ("record_id string, concurrent_to string, type string, target_uri string, page_id long, "
                 "refers_to long, payload_bytes long, payload_digest string, payload binary")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(kind: str, name: str, url: str | None, content_type: str, block: str, more: list[str]) -> str:
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {DATE}",
            *([f"WARC-Target-URI: {url}"] if url else []), *more, f"Content-Type: {content_type}",
            f"Content-Length: {len(block.encode())}", "", ""]
    return CRLF.join(head) + block


def _records(batches):
    """One row per WARC record (without its closing line ends)."""
    for batch in batches:
        _, offsets = tb.utf8(batch.column(2))
        for i, j in tb.blocks(offsets, 4 << 20):
            out = []
            for page, url, html, first in zip(*(batch.column(k).slice(i, j - i).to_pylist() for k in range(4))):
                url = None if url is None else "".join(url.splitlines())
                payload = (html or "").encode()
                sha, size = digest(payload), len(payload)
                name, request, meta = (str(uuid.uuid5(uuid.NAMESPACE_URL, f"{kind}:{page}:{sha}:{size}"))
                                       for kind in ("response", "request", "metadata"))
                http = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: {size}{CRLF}{CRLF}"
                same = [f"WARC-Payload-Digest: sha1:{sha}"]
                original = first is not None and first != page
                if original:
                    refers = uuid.uuid5(uuid.NAMESPACE_URL, f"response:{first}:{sha}:{size}")
                    same += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                             f"WARC-Refers-To: <urn:uuid:{refers}>"]
                to = [f"WARC-Concurrent-To: <urn:uuid:{name}>"]
                out.append(_record("request", request, url, "application/http; msgtype=request",
                                   f"GET {url or '/'} HTTP/1.1{CRLF}{CRLF}", to))
                out.append(_record("revisit" if original else "response", name, url,
                                   "application/http; msgtype=response", http + ("" if original else html or ""), same))
                fields = [f"page-id: {page}", *([f"refers-to-page: {first}"] if original else []), ""]
                out.append(_record("metadata", meta, url, "application/warc-fields", CRLF.join(fields), to))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> None:
    """Write the archives of ``pages`` into the folder ``path``."""
    ship_package(pages.sparkSession)
    html = F.coalesce(c(html_col), F.lit(""))
    rows = pages.select(c(id_col).cast("long").alias("page_id"), c(url_col).alias("url"), html.alias("html"),
                        F.sha2(html, 256).alias("sha"), F.octet_length(html).alias("bytes")).where("page_id is not null")
    # firsts of the payloads that repeat: narrow rows, combined before the shuffle
    groups = written(rows.groupBy("sha", "bytes").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"),
                                                      F.count(F.lit(1)).alias("n")), "payloads")
    total, records = groups.agg(F.sum(c("bytes") * c("n")), F.sum("n")).first()
    per_file = max(3, int(3 * FILE_BYTES / max(1.0, float(total or 0) / max(1, records or 1) + 1000)))
    repeated = groups.where((c("first") < c("last")) & (c("bytes") >= min_bytes)).select(
        c("sha").alias("_sha"), c("bytes").alias("_bytes"), "first")
    # a hot payload is one sort-merge join key; adaptive execution splits its pages
    marked = rows.join(repeated, (c("sha") == c("_sha")) & (c("bytes") == c("_bytes")), "left")
    (marked.select("page_id", "url", "html", "first").mapInArrow(_records, "value string")
     .write.option("lineSep", CRLF + CRLF).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path))


def parse(stream):
    """(headers, block) of every record of a WARC stream; header names in lower case."""
    while True:
        line = stream.readline()
        while line in (b"\r\n", b"\n"):
            line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        headers = {}
        while True:
            line = stream.readline().rstrip(b"\r\n")
            if not line:
                break
            key, _, value = line.decode().partition(":")
            headers[key.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a WARC record is cut short")
        yield headers, block


def _http(block: bytes) -> tuple[dict, bytes]:
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def _reading(with_payload: bool):
    names = [x.split(" ")[0] for x in RECORD_SCHEMA.split(", ")]
    types = [pa.string()] * 4 + [pa.int64()] * 3 + [pa.string(), pa.binary()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                raw = io.BytesIO(content.as_py())
                rows, held = [], 0
                for headers, block in parse(io.BufferedReader(gzip.GzipFile(fileobj=raw)) if raw.getvalue()[:2] == b"\x1f\x8b" else raw):
                    kind = headers["warc-type"]
                    page = refers = size = sha = payload = None
                    if kind == "response":
                        _, payload = _http(block)
                        size, sha = len(payload), digest(payload)
                        if headers.get("warc-payload-digest", f"sha1:{sha}") != f"sha1:{sha}":
                            raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
                    elif kind == "revisit":
                        http, _ = _http(block)
                        size, sha = int(http["content-length"]), headers["warc-payload-digest"].partition(":")[2]
                    elif kind == "metadata":
                        fields = dict(x.split(": ", 1) for x in block.decode().split("\r\n") if ": " in x)
                        page = int(fields["page-id"])
                        refers = int(fields["refers-to-page"]) if "refers-to-page" in fields else None
                    elif kind != "request":
                        continue
                    rows.append((headers["warc-record-id"], headers.get("warc-concurrent-to"), kind,
                                 headers.get("warc-target-uri"), page, refers, size, sha,
                                 payload if with_payload else None))
                    held += len(payload or b"") if with_payload else 0
                    if len(rows) >= 4096 or held > 4 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)
    return run


def read_archives(spark, path: str, with_payload: bool = True) -> DataFrame:
    """One row per request, response, revisit and metadata record below ``path``."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path)
    return files.select("content").mapInArrow(_reading(with_payload), RECORD_SCHEMA)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, request, response, metadata.

    Identifiers are unique, so no key of the joins is hot.  A response without a request or
    metadata keeps null there."""
    response = records.where(c("type").isin("response", "revisit")).select(
        c("record_id").alias("capture_id"), F.struct("type", "target_uri", "payload_bytes", "payload_digest", "payload")
        .alias("response"))
    request = records.where("type = 'request'").select(
        c("concurrent_to").alias("_r"), F.struct("record_id", "target_uri").alias("request"))
    meta = records.where("type = 'metadata'").select(
        c("concurrent_to").alias("_m"), F.struct("record_id", "page_id", "refers_to").alias("metadata"))
    return (response.dropDuplicates(["capture_id"])
            .join(request.dropDuplicates(["_r"]), c("capture_id") == c("_r"), "left")
            .join(meta.dropDuplicates(["_m"]), c("capture_id") == c("_m"), "left")
            .select("capture_id", "request", "response", "metadata"))


def round_trip(pages: DataFrame, min_bytes: int = 0, with_payload: bool = False, path: str | None = None) -> DataFrame:
    """The captures read back from the archives that ``pages`` were written to."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    return captures(written(read_archives(spark, path, with_payload), "records"))


def oracle(pages: str = "pages") -> str:
    """DuckDB SQL for the digest columns of ``round_trip``."""
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return f"""
WITH p AS (SELECT DISTINCT page_id, coalesce(html, '') AS h FROM {pages} WHERE page_id IS NOT NULL),
d AS (SELECT page_id, h, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS hex,
             min(page_id) OVER (PARTITION BY h) AS first FROM p),
q AS (SELECT *, [CAST('0x' || substr(hex, CAST(5 * i + 1 AS INTEGER), 5) AS INTEGER) for i in range(8)] AS groups FROM d)
SELECT page_id, payload_bytes,
       list_aggregate([substr('{digits}', (x >> 15) + 1, 1) || substr('{digits}', ((x >> 10) & 31) + 1, 1)
                       || substr('{digits}', ((x >> 5) & 31) + 1, 1) || substr('{digits}', (x & 31) + 1, 1)
                       for x in groups], 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM q"""
