"""Content-addressed WARC archive.

An archive is two tables in the shared folder. ``payloads`` holds every distinct payload
once, compressed, under its SHA-256; ``headers`` holds one row per record with its exact
header bytes and the digest of its payload. Records are rebuilt by joining the two; the
payload is decompressed and checked against its digest again before it is used.

The first record of a payload is a ``response``, all others are ``revisit`` records that
refer to it and repeat no payload. Copies are combined before the shuffle (one row per
digest and task), so a payload that a third of all pages share is stored by one small
group; in the join it is one row that its headers meet, which adaptive execution splits.

Defined cases: a null html is an empty payload, a null url gives no target URI, control
characters and blanks of a url are percent-encoded; equal payloads shorter than
``least_bytes`` are all responses; rows that repeat the id of the response are responses
too; a null page_id is written as an empty one, and refers like any other (it is the
response only where all ids of the payload are null); every record has its own
``WARC-Record-ID``, also where rows repeat an id, and a revisit names one response; a very long
html is one payload; an empty table gives an empty
archive; other columns are ignored. Two payloads of one SHA-256 but another SHA-1 or
length stop the write.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import scratch, table

DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


@dataclass(frozen=True)
class Archive:
    """Paths of the two tables."""

    payloads: str
    headers: str


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _payload_rows(keep: bool):
    """Task: page_id, url, digests and length of each row; with ``keep`` the packed payload too."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            payloads = [x.as_py() or b"" for x in batch.column(2).cast(pa.binary())]
            columns = {
                "page_id": batch.column(0),
                "url": batch.column(1),
                "sha256": pa.array([hashlib.sha256(x).digest() for x in payloads], pa.binary()),
                "sha1": pa.array([base32_sha1(x) for x in payloads], pa.string()),
                "bytes": pa.array([len(x) for x in payloads], pa.int64()),
            }
            if keep:
                columns["packed"] = pa.array([pack.compress(x) for x in payloads], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    return digest


def record_id(page_id, sha256: bytes, target: str, copy: int) -> str:
    """Unique name of a record: equal ids, payloads and target URIs are told apart by ``copy``."""
    return f"<urn:page:{'' if page_id is None else page_id}:{sha256.hex()[:32]}:{target}:{copy}>"


def record_header(own: str, url, sha1: str, size: int, refers_to: str, revisit: bool) -> bytes:
    """The exact bytes of a record before its payload: WARC header and HTTP header."""
    http = _HTTP + f"Content-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}"]
    lines.append(f"WARC-Record-ID: {own}")
    lines.append(f"WARC-Date: {DATE}")
    if url is not None:
        safe = _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    lines.append(f"WARC-Payload-Digest: sha1:{sha1}")
    if revisit:
        lines += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {PROFILE}"]
    lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"Content-Length: {len(http) + (0 if revisit else size)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


def _headers(least_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row in batch.to_pylist():
                revisit = row["bytes"] >= least_bytes and row["page_id"] != row["first_id"]
                own = record_id(row["page_id"], row["sha256"], row["target"], row["copy"])
                first = record_id(row["first_id"], row["sha256"], row["first_target"], 0)
                made.append(record_header(own, row["url"], row["sha1"], row["bytes"], first, revisit))
            yield pa.RecordBatch.from_pydict({"sha256": batch.column("sha256"), "header": pa.array(made, pa.binary())})

    return write


def _target() -> "F.Column":
    """What tells the target URI in a record's name."""
    return F.substring(F.sha2(F.coalesce(F.col("url"), F.lit("")), 256), 1, 16)


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0) -> Archive:
    """Write a record for every row of pages (page_id, url, html) below ``path``."""
    archive = Archive(f"{path}/payloads", f"{path}/headers")
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    named = f"page_id {kind}, url string, sha256 binary, sha1 string, bytes long"
    whole = rows.mapInArrow(_payload_rows(True), named + ", packed binary")
    (
        whole.groupBy("sha256")
        .agg(
            F.max(F.struct("page_id", _target().alias("target"))).alias("_first"),
            F.min("sha1").alias("sha1"),
            F.max("sha1").alias("_sha1"),
            F.min("bytes").alias("bytes"),
            F.max("bytes").alias("_bytes"),
            F.first("packed").alias("packed"),
        )
        # Equal strong digests are verified by a second digest and the length.
        .withColumn(
            "packed",
            F.when((F.col("sha1") == F.col("_sha1")) & (F.col("bytes") == F.col("_bytes")), F.col("packed")).otherwise(
                F.raise_error(F.lit("two payloads share a SHA-256")).cast("binary")
            ),
        )
        .select(
            "sha256",
            F.col("_first.page_id").alias("first_id"),
            F.col("_first.target").alias("first_target"),
            "bytes",
            "packed",
        )
        .write.option("compression", "uncompressed")
        .parquet(archive.payloads)
    )
    firsts = pages.sparkSession.read.parquet(archive.payloads).select("sha256", "first_id", "first_target")
    digested = rows.mapInArrow(_payload_rows(False), named)
    # Rows equal in all that a header says are counted, then numbered.
    copies = digested.groupBy(*digested.columns).agg(F.count(F.lit(1)).alias("_n"))
    numbered = copies.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).drop("_n")
    (
        numbered.withColumn("target", _target())
        .join(firsts, "sha256")
        .mapInArrow(_headers(least_bytes), "sha256 binary, header binary")
        .write.option("compression", "zstd")
        .parquet(archive.headers)
    )
    return archive


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """header, record (exact bytes of the whole record) and payload of every record."""
    headers = spark.read.parquet(archive.headers)
    payloads = spark.read.parquet(archive.payloads).select("sha256", "bytes", "packed")
    return headers.join(payloads, "sha256").mapInArrow(_rebuild, "header binary, record binary, payload binary")


def _opened(row: dict, unpack) -> bytes:
    payload = unpack.decompress(row["packed"], max_output_size=max(1, row["bytes"]))
    if hashlib.sha256(payload).digest() != row["sha256"]:
        raise ValueError("a stored payload does not match its digest")
    return payload


def _rebuilt(batch: pa.RecordBatch, unpack) -> Iterator[tuple[bytes, bytes, bytes]]:
    for k in range(batch.num_rows):
        row = {n: batch.column(n)[k].as_py() for n in ("sha256", "header", "bytes", "packed")}
        payload = _opened(row, unpack)
        body = b"" if b"\r\nWARC-Type: revisit\r\n" in row["header"][:64] else payload
        yield row["header"], row["header"] + body + b"\r\n\r\n", payload


_SOME = 256  # records rebuilt at once: payloads are larger than what is read


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for at in range(0, batch.num_rows, _SOME):
            rows = list(_rebuilt(batch.slice(at, _SOME), unpack))
            yield pa.RecordBatch.from_pydict(
                {n: pa.array([r[k] for r in rows], pa.binary()) for k, n in enumerate(("header", "record", "payload"))}
            )


_FIELD = re.compile(rb"([A-Za-z-]+): (.*)")


def parse_record(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC fields, HTTP header, body) of one record's bytes; checks its lengths."""
    head, _, block = record.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    fields = {m[1].decode(): m[2].decode() for m in map(_FIELD.fullmatch, lines)}
    size = int(fields["Content-Length"])
    if version != b"WARC/1.1" or block[size:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    http, _, body = block[:size].partition(b"\r\n\r\n")
    return fields, http + b"\r\n\r\n", body


def record_facts(spark: SparkSession, archive: Archive) -> DataFrame:
    """What the rebuilt records say: a row per record.

    page_id, payload_bytes, payload_digest, record_type, refers_to; size and digest are
    taken from the full payload, and a digest field that differs from it fails.
    """
    headers = spark.read.parquet(archive.headers)
    payloads = spark.read.parquet(archive.payloads).select("sha256", "bytes", "packed")

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        id_of = lambda urn: urn.split(":")[2]
        number = lambda urn: int(id_of(urn)) if id_of(urn) else None
        for batch in batches:
            out = {n: [] for n in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")}
            for _, record, payload in _rebuilt(batch, unpack):
                fields, _, body = parse_record(record)
                revisit = fields["WARC-Type"] == "revisit"
                sha1 = base32_sha1(payload)
                if fields["WARC-Payload-Digest"] != f"sha1:{sha1}" or body != (b"" if revisit else payload):
                    raise ValueError("a record does not match its payload")
                out["page_id"].append(number(fields["WARC-Record-ID"]))
                out["payload_bytes"].append(len(payload))
                out["payload_digest"].append(sha1)
                out["record_type"].append(fields["WARC-Type"])
                out["refers_to"].append(number(fields["WARC-Refers-To"]) if revisit else None)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_pydict({n: pa.array(v, t) for (n, v), t in zip(out.items(), kinds)})

    return headers.join(payloads, "sha256").mapInArrow(
        facts, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def op3_warc_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to a content-addressed archive and read back."""
    archive = write_archive(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return record_facts(spark, archive)


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), f AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS first_id FROM p
), digits AS (
  SELECT *, list_transform(range(32), lambda k:
    (('0x' || substr(hex, (k // 8) * 10 + 1, 10))::BIGINT >> (35 - 5 * (k % 8))) & 31) AS d FROM f
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       array_to_string(list_transform(d, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x + 1)::INTEGER, 1)), '')
         AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM digits
"""
