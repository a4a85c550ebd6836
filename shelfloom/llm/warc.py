"""WARC archives: writing captures, reading records, assembling transactions.

``write_archive`` gives each page a *request*, a *response* (or *revisit*) and a *metadata* record;
request and metadata name the response in ``WARC-Concurrent-To``.  Of pages with equal payloads of
at least ``min_revisit`` bytes, the one with the smallest id is the response, the others revisit it
without a body.  The files come from Spark's own text writer: a record is its header block and
block, and the writer's line separator is the blank lines that end a record.

Files hold about ``FILE_BYTES`` of payload at most: pages are written by classes of size, each with as
many records to a file as its largest page allows.  ``read_records`` decompresses a file as it goes, a
record at a time, and cuts records by Content-Length, so payloads may hold any bytes, record separators
too; a task holds a compressed file, one record and a batch of about ``BATCH_BYTES``.

``assemble`` joins the records of a transaction through their concurrent-to identifiers, whichever
side names the other, and gives one nested row per capture.  It reads the records twice: give it a
written table, as the query does, and archives are parsed once.

Cases: null html is an empty payload; null url is written as an empty target; null page ids are
kept (their revisits name no page); repeated rows are separate captures, and only one of them is the
response when their payload is long enough; an empty table writes no record and reads back empty;
payloads of any length that Spark's strings allow; columns besides page_id, url and html are not used.
``pages`` is read twice and has to give the same rows in the same order, as files do.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfloom.llm.common import materialize

CRLF = "\r\n"
END = CRLF + CRLF
FILE_BYTES = 256 << 20
BATCH_BYTES = 8 << 20
#: Classes of payload bytes: above the first, up to the second.
CLASSES = ((-1, 64 << 10), (64 << 10, 4 << 20), (4 << 20, 1 << 40))
DATE = "2024-01-01T00:00:00Z"
RECORD = "record_id string, type string, uri string, date string, concurrent_to array<string>, refers_to string, payload_digest string, block_length long, payload_bytes long, block binary"


def _record(kind: str, record_id: Column, headers: list[tuple[str, Column | str]], block: Column) -> Column:
    """Header lines, an empty line, and the block."""
    lines = [F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}{CRLF}WARC-Date: {DATE}{CRLF}WARC-Record-ID: <"), record_id, F.lit(f">{CRLF}")]
    for name, value in headers:
        lines += [F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(CRLF)]
    lines += [F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(END), block]
    return F.concat(*lines)


def write_archive(pages: DataFrame, path: str, min_revisit: int = 100, file_bytes: int = FILE_BYTES) -> None:
    """Writes (page_id, url, html) as gzip-compressed WARC files under ``path``."""
    one = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[\r\n]+", " ")  # noqa: E731  a header is one line
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.monotonically_increasing_id().alias("ord"),
        one(F.col("url")).alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumns({"digest": F.sha2(F.col("html").cast("binary"), 256), "bytes": F.octet_length("html")})
    # Payloads that repeat: found by partial counts on the digest, so a hot payload is one row a task.
    first = (
        base.where(F.col("bytes") >= min_revisit)
        .select("digest", "page_id", "ord")
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", "ord")).alias("first"))
        .where("n > 1")
        .select("digest", F.col("first.page_id").alias("first_page"), F.col("first.ord").alias("first_ord"))
    )
    rows = base.join(materialize(first, "warc-first"), "digest", "left")
    name = lambda kind, page, order: F.concat(F.lit(f"urn:capture:{kind}:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), order.cast("string"))
    me = name("response", F.col("page_id"), F.col("ord"))
    again = F.coalesce(F.col("first_ord") != F.col("ord"), F.lit(False))
    target, payload = ("WARC-Target-URI", F.col("url")), F.col("html")
    http = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{END}")
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))
    kind = ("Content-Type", "application/http; msgtype=response")
    linked = ("WARC-Concurrent-To", F.concat(F.lit("<"), me, F.lit(">")))
    get = F.concat(F.lit("GET "), F.col("url"), F.lit(f" HTTP/1.1{END}"))
    records = F.array(
        _record("request", name("request", F.col("page_id"), F.col("ord")), [target, linked, ("Content-Type", "application/http; msgtype=request")], get),
        F.when(
            again,
            _record("revisit", me, [target, digest, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", F.concat(F.lit("<"), name("response", F.col("first_page"), F.col("first_ord")), F.lit(">"))), kind], http),
        ).otherwise(_record("response", me, [target, digest, kind], F.concat(http, payload))),
        _record(
            "metadata",
            name("metadata", F.col("page_id"), F.col("ord")),
            [target, linked, ("Content-Type", "application/warc-fields")],
            F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(f"{CRLF}payload-length: "), F.col("bytes").cast("string"), F.lit(CRLF)),
        ),
    )
    body = F.when(again, 0).otherwise(F.col("bytes"))
    n = base.agg(*[F.count_if((F.col("bytes") > low) & (F.col("bytes") <= high)) for low, high in CLASSES]).first()
    for k, (low, high) in enumerate(CLASSES):
        # Revisits have no body and go with the smallest pages; a class that no page has is not written.
        if k == 0 or n[k]:
            out = rows.where((body > low) & (body <= high)).select(F.explode(records).alias("value"))
            out.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", 3 * max(1, file_bytes // high)).text(f"{path}/{k}")


def _parse(file: BinaryIO) -> Iterator[dict]:
    """The records of one archive file, read in order."""
    while True:
        line = file.readline()
        if not line:
            return
        if not line.strip():
            continue  # the blank lines after a record
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record where one should begin: {line[:40]!r}")
        heads: dict[str, list[str]] = {}
        while (line := file.readline()).strip():
            key, _, value = line.decode("utf-8").partition(":")
            heads.setdefault(key.lower(), []).append(value.strip())
        if not line:
            raise ValueError("a record's headers do not end")
        one = lambda k: heads.get(k, [None])[0]  # noqa: E731, B023
        size = int(one("content-length"))
        block = file.read(size)
        if len(block) < size:
            raise ValueError("a record is cut short")
        payload = block
        if (one("content-type") or "").startswith("application/http"):
            payload = memoryview(block)[block.find(b"\r\n\r\n") + 4 :]
        own = one("warc-type") in ("response", "resource")
        bare = lambda v: v.strip("<>") if v else None
        yield {
            "record_id": bare(one("warc-record-id")),
            "type": one("warc-type"),
            "uri": one("warc-target-uri"),
            "date": one("warc-date"),
            "concurrent_to": [bare(v) for v in heads.get("warc-concurrent-to", [])],
            "refers_to": bare(one("warc-refers-to")),
            # A response's digest is taken from the bytes that were read, a revisit's is what it claims.
            "payload_digest": hashlib.sha256(payload).hexdigest() if own else (one("warc-payload-digest") or "").removeprefix("sha256:") or None,
            "block_length": size,
            "payload_bytes": len(payload) if own else None,
            "block": block,
        }


def read_records(spark: SparkSession, path: str, block: bool = True) -> DataFrame:
    """One row per WARC record under ``path``; ``block=False`` leaves the bytes of bodies of captures out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").option("recursiveFileLookup", True).load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _schema()
        for b in batches:
            for i in range(b.num_rows):
                rows, size = [], 0
                with gzip.GzipFile(fileobj=pa.BufferReader(b.column(0)[i].as_buffer())) as file:
                    for r in _parse(file):
                        if not block and r["type"] in ("response", "revisit", "request"):
                            r["block"] = None
                        rows.append(r)
                        size += len(r["block"] or b"") + 500
                        if size >= BATCH_BYTES:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return files.mapInArrow(run, RECORD)


def _schema() -> pa.Schema:
    s = pa.string()
    return pa.schema([("record_id", s), ("type", s), ("uri", s), ("date", s), ("concurrent_to", pa.list_(s)), ("refers_to", s), ("payload_digest", s), ("block_length", pa.int64()), ("payload_bytes", pa.int64()), ("block", pa.binary())])


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: (capture_id, capture, request, metadata), each a struct (null if absent).

    Links go from the record that names to the one named.  A capture has few records, so the join is
    a grouping on the capture's id; of several requests (or metadata records) the smallest id stays
    first and all are kept in the arrays.
    """
    record = F.struct("record_id", "type", "uri", "date", "refers_to", "payload_digest", "block_length", "payload_bytes", "block")
    main = F.col("type").isin("response", "revisit", "resource")
    named = records.select(main.alias("main"), record.alias("r"), "concurrent_to")
    # A capture may name its request, or be named by it.
    own = named.select(F.when(F.col("main"), F.col("r.record_id")).otherwise(F.col("concurrent_to")[0]).alias("capture_id"), "r", "main")
    back = named.where(F.col("main") & (F.size("concurrent_to") > 0)).select(F.explode("concurrent_to").alias("other"), F.col("r.record_id").alias("via"))
    own = own.join(back, (F.col("r.record_id") == F.col("other")) & ~F.col("main"), "left").select(F.coalesce("via", "capture_id").alias("capture_id"), "r")
    pick = lambda *kinds: F.when(F.col("r.type").isin(*kinds), F.col("r"))
    return own.where("capture_id is not null").groupBy("capture_id").agg(
        F.first(pick("response", "revisit", "resource"), True).alias("capture"),
        F.sort_array(F.collect_list(pick("request"))).alias("requests"),
        F.sort_array(F.collect_list(pick("metadata"))).alias("metadata"),
    )


def field(name: str) -> Column:
    """A field of the capture's first metadata record."""
    text = F.decode(F.col("metadata")[0]["block"], "UTF-8")
    return F.nullif(F.regexp_extract(text, f"(?m)^{name}: ([^\r\n]*)", 1), F.lit(""))
