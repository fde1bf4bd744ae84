"""Legacy web archives: ARC files in, WARC files out, and both readers.

``write_arc`` stores pages as ARC files (versions 1 and 2). ``arc_records``
parses them: the version block names the header fields, each record's declared
length says where it ends. ``arc_to_warc`` synthesises the WARC records: an
identifier from file and offset, the 14-digit date as an ISO time, the type
(``response``, or ``revisit`` where an equal payload of ``MIN_REVISIT`` bytes or
more has a smaller page id), and SHA-256 digests of payload and block.
``warc_records`` reads them back and checks every payload against its digest.
A scan partition becomes one gzip file, so no payload is collected or dealt out
for writing. A bitmap of fixed size tells which records can be revisits; only
these are joined with the decisions, all others go straight to their file.

Defined results: null html is an empty payload; a null url becomes
``urn:page:<id>``; white space and control characters in a url are percent-encoded.
Rows that repeat a page id are records of their own (the first in file order of
the smallest id is the response). A null page id sorts after every other.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext
from xxhash import xxh3_64_intdigest

from docflow.llm.common import bitmap_of, in_bitmap, query, written
from docflow.session import scratch_path
from docflow.sources.tables import table

MIN_REVISIT = 100
CRAWL_DATE = "20240101000000"
FLUSH_BYTES = 8 << 20
# fixed values: the header fields of both versions of the format
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _clean_url(url: str | None, page_id: int | None) -> str:
    if not url:
        return f"urn:page:{'' if page_id is None else page_id}"
    return re.sub(r"[\s\x00-\x1f\x7f]", lambda m: quote(m[0]), url)


def _http(page_id: int | None, size: int) -> str:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {'' if page_id is None else page_id}\r\nContent-Length: {size}\r\n\r\n"


def write_arc(pages: DataFrame, path: str, date: str = CRAWL_DATE) -> None:
    """Write (page_id, url, html) as gzip-compressed ARC files; scan partitions of
    even number in version 1, of odd number in version 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        version, name = 1 + part % 2, f"part-{part}.arc"
        about = f"{version} 0 docflow\n{ARC_FIELDS[version]}\n"
        extra = f"200 - - 0 {name} " if version == 2 else ""
        held, size = [f"filedesc://{name} 0.0.0.0 {date} text/plain {extra}{len(about)}\n{about}"], 0
        for b in batches:
            for page_id, url, html in zip(*(b.column(k) for k in range(3)), strict=True):
                i, body = page_id.as_py(), html.as_py() or ""
                raw = len(body.encode("utf-8"))
                block = _http(i, raw) + body
                length = len(block) - len(body) + raw
                held.append(f"{_clean_url(url.as_py(), i)} 0.0.0.0 {date} text/html {extra}{length}\n{block}")
                size += length
                if size >= FLUSH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], names=["value"])

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    rows.mapInArrow(run, "value string").write.option("compression", "gzip").option("lineSep", "\n").text(path)


def _parse_arc(content: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, header fields, block) of the records of one ARC file."""
    f = gzip.GzipFile(fileobj=io.BytesIO(content))
    fields: list[str] = []
    while True:
        at = f.tell()
        line = f.readline()
        if not line:
            return
        if line == b"\n":
            continue
        values = line.decode("utf-8").rstrip("\n").split(" ")
        block = f.read(int(values[-1]))
        if len(block) != int(values[-1]):
            raise ValueError("an ARC record is shorter than its declared length")
        if values[0].startswith("filedesc://"):
            fields = block.decode("utf-8").split("\n")[1].split(" ")
        elif len(values) != len(fields):
            raise ValueError("an ARC header line doesn't fit the version block")
        else:
            yield at, dict(zip(fields, values, strict=True)), block


def _split_http(block: bytes) -> tuple[str, dict[str, str], bytes]:
    head, _, body = block.partition(b"\r\n\r\n")
    text = head.decode("utf-8")
    return text + "\r\n\r\n", dict(x.split(": ", 1) for x in text.split("\r\n")[1:]), body


def _page_id(http: dict[str, str]) -> int | None:
    return int(http["X-Page-Id"]) if http.get("X-Page-Id") else None


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("path", "content")


_ARC_SCHEMA = "rec string, rec_key long, page_id long, uri string, date string, http string, payload string, payload_bytes long, digest string, block_digest string, head_digest string"
_ARC_TYPES = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), *[pa.string()] * 3]


def arc_records(spark: SparkSession, path: str, payload: bool = True, part: tuple[Broadcast, bool] | None = None) -> DataFrame:
    """The records of ARC files; ``payload`` null if it isn't asked for. ``part``:
    a bitmap of record keys, and whether to give the records in it or the others."""
    names = [x.split()[0] for x in _ARC_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, content in zip(b.column(0), b.column(1), strict=True):
                rows, size = [], 0
                for at, field, block in _parse_arc(content.as_py()):
                    rec = f"{file.as_py().rsplit('/', 1)[-1]}#{at}"
                    key = np.uint64(xxh3_64_intdigest(rec)).astype(np.int64)
                    if part and bool(in_bitmap(part[0].value, np.array([key]))[0]) != part[1]:
                        continue
                    http, heads, body = _split_http(block)
                    digests = (hashlib.sha256(x).hexdigest() for x in (body, block, http.encode("utf-8")))
                    rows.append((rec, int(key), _page_id(heads), field["URL"], field["Archive-date"], http, body.decode("utf-8") if payload else None, len(body), *digests))
                    size += len(block) if payload else 500
                    if size >= FLUSH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARC_TYPES, strict=True)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARC_TYPES, strict=True)], names=names)

    return _files(spark, path).mapInArrow(run, _ARC_SCHEMA)


def revisits(records: DataFrame) -> DataFrame:
    """(rec, rec_key, response_rec) of the records that repeat a payload of MIN_REVISIT bytes."""
    known = records.where(F.col("payload_bytes") >= MIN_REVISIT).select("rec", "rec_key", "digest", F.coalesce("page_id", F.lit((1 << 63) - 1)).alias("p"))
    first = known.groupBy("digest").agg(F.min(F.struct("p", "rec")).alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", F.col("first.rec").alias("response_rec"))
    return known.join(first, "digest").where("rec <> response_rec").select("rec", "rec_key", "response_rec")


def record_id(rec):
    """A stable identifier of a record: file name and offset as a name-based UUID."""
    h = F.md5(F.encode(rec, "UTF-8"))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def arc_to_warc(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Convert ARC files to gzip-compressed WARC files."""
    digests = written(arc_records(spark, arc_path, payload=False).select("rec", "rec_key", "page_id", "payload_bytes", "digest"), "arc-digests")
    again = written(revisits(digests), "arc-revisits")
    bitmap = spark.sparkContext.broadcast(bitmap_of(again, "rec_key"))
    maybe = arc_records(spark, arc_path, part=(bitmap, True)).join(again.drop("rec_key"), "rec", "left")
    others = arc_records(spark, arc_path, part=(bitmap, False)).withColumn("response_rec", F.lit(None).cast("string"))
    rows = others.unionByName(maybe)
    is_new = F.col("response_rec").isNull()
    block = F.when(is_new, F.concat("http", "payload")).otherwise(F.col("http"))
    d = F.col("date")
    iso = F.concat(F.substring(d, 1, 4), F.lit("-"), F.substring(d, 5, 2), F.lit("-"), F.substring(d, 7, 2), F.lit("T"), F.substring(d, 9, 2), F.lit(":"), F.substring(d, 11, 2), F.lit(":"), F.substring(d, 13, 2), F.lit("Z"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(is_new, "response").otherwise("revisit")),
        F.concat(F.lit("WARC-Record-ID: "), record_id(F.col("rec"))),
        F.concat(F.lit("WARC-Date: "), iso),
        F.concat(F.lit("WARC-Target-URI: "), F.col("uri")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.concat(F.lit("WARC-Block-Digest: sha256:"), F.when(is_new, F.col("block_digest")).otherwise(F.col("head_digest"))),
        F.when(~is_new, F.concat(F.lit(f"WARC-Profile: {_PROFILE}\r\nWARC-Refers-To: "), record_id(F.col("response_rec")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    record = F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block)
    rows.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", "\r\n\r\n").text(warc_path)


def _parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of one WARC file."""
    f = gzip.GzipFile(fileobj=io.BytesIO(content))
    while line := f.readline():
        if not line.startswith(b"WARC/1."):
            raise ValueError("a WARC record doesn't start with its version")
        heads = {}
        while (line := f.readline()) != b"\r\n":
            key, value = line.decode("utf-8").rstrip("\r\n").split(": ", 1)
            heads[key] = value
        block = f.read(int(heads["Content-Length"]))
        if len(block) != int(heads["Content-Length"]) or f.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record doesn't end where it says")
        yield heads, block


_WARC_SCHEMA = "record_id string, page_id long, record_type string, refers_to_record string, payload_bytes long, payload_digest string, uri string, date string"
_WARC_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.string()] * 3]


def warc_records(spark: SparkSession, path: str) -> DataFrame:
    """Headers of the records of WARC files, payloads checked against their digests."""
    names = [x.split()[0] for x in _WARC_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                rows = []
                for heads, block in _parse_warc(content.as_py()):
                    _, http, body = _split_http(block)
                    digest = heads["WARC-Payload-Digest"].removeprefix("sha256:")
                    if heads["WARC-Type"] == "response" and hashlib.sha256(body).hexdigest() != digest:
                        raise ValueError("a payload doesn't have its digest")
                    rows.append((heads["WARC-Record-ID"], _page_id(http), heads["WARC-Type"], heads.get("WARC-Refers-To"), int(http["Content-Length"]), digest, heads["WARC-Target-URI"], heads["WARC-Date"]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _WARC_TYPES, strict=True)], names=names)

    return _files(spark, path).select("content").mapInArrow(run, _WARC_SCHEMA)


@query(
    "op2_warc",
    """
    WITH p AS (
      SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
    f AS (SELECT body, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY body)
    SELECT p.page_id, p.n AS payload_bytes, sha256(p.body) AS payload_digest,
           CASE WHEN f.first_id < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN f.first_id < p.page_id THEN f.first_id END AS refers_to
    FROM p LEFT JOIN f ON p.body = f.body
    """,
)
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns: pages to ARC, ARC to WARC, WARC read back."""
    arc, out = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(table(spark, sf_dir, "pages"), arc)
    arc_to_warc(spark, arc, out)
    read = written(warc_records(spark, out), "warc-headers")
    target = read.where("record_type = 'response'").select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"))
    again = read.where("record_type = 'revisit'").join(target, "refers_to_record", "left")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return read.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("long")).select(*cols).unionByName(again.select(*cols))
