"""WARC writing, reading and transaction assembly (operator 9).

Writing: each page gives a request, a response (or revisit) and a metadata
record; request and metadata name the response's record in
WARC-Concurrent-To.  Payloads are told apart by their SHA-1 digest; among
equal payloads the page with the largest id is the response and the others
are revisits that refer to it.  Records are written by Spark's text writer
with the record separator as line separator, so files appear by its commit
protocol in any file system and a lost task is simply rerun.

Reading: whole archive files go to tasks (their size is bounded by the
writer) and are parsed by Content-Length, so payloads may hold any bytes.

Assembly: request and metadata records are joined to the response records
through their concurrent-to identifiers; one nested row per capture.

Defined cases: a null html is an empty payload; a null url is an empty URI;
rows with one page_id are captures of their own, and if they hold the
largest id of equal payloads they are all responses; a null page_id loses
against any other and, alone, is a response; an empty table gives an empty
table; other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import new_folder

MIN_REVISIT_BYTES = 0
FILE_RECORDS = 3_000         # records of an archive file
VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
CRLF = "\r\n"


def base32_digest(digest_hex: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 in hex: eight letters per 10 hex digits."""
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for k in range(4):
        part = F.conv(F.substring(digest_hex, 10 * k + 1, 10), 16, 10).cast("long")
        for shift in range(35, -1, -5):
            out.append(F.substring(alphabet, (F.shiftright(part, shift).bitwiseAND(31) + 1).cast("int"), F.lit(1)))
    return F.concat(*out)


def captures(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, digest (hex), bytes, record_type, refers_to."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload")).select(
        "*", F.sha1(F.col("payload").cast("binary")).alias("digest"), F.octet_length("payload").cast("long").alias("bytes"))
    # the largest id per digest; partial aggregates, so a hot payload is a row per task
    last = (rows.select("page_id", "digest").groupBy("digest")
            .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("copies"))
            .where("copies > 1").select("digest", "response_id"))
    again = (F.col("bytes") >= min_bytes) & F.col("response_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return (rows.join(last, "digest", "left")
            .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(again, F.col("response_id"))).drop("response_id"))


def records(found: DataFrame) -> DataFrame:
    """One text ``value`` per WARC record, three per capture, without the
    blank lines that end a record."""
    clean = lambda c: F.regexp_replace(c, r"[\r\n]", "")
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    urn = lambda kind: F.concat(F.lit(f"<urn:capture:{kind}:"), page, F.lit(":"), F.col("_n").cast("string"), F.lit(">"))

    def record(kind, own, fields, body):
        lines = [F.lit(VERSION), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: "), own),
                 F.lit(f"WARC-Date: {DATE}"), *fields,
                 F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"))]
        return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), body)

    uri = F.concat(F.lit("WARC-Target-URI: "), clean(F.col("url")))
    with_response = F.concat(F.lit("WARC-Concurrent-To: "), urn("response"))
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32_digest(F.col("digest")))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("bytes").cast("string"), F.lit(CRLF * 2))
    refers = F.when(F.col("refers_to").isNotNull(), F.concat(
        F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))
    response = record(F.col("record_type"), urn("response"), [uri, digest, refers, F.lit(
        "Content-Type: application/http; msgtype=response")],
        F.when(F.col("record_type") == "revisit", head).otherwise(F.concat(head, F.col("payload"))))
    request = record(F.lit("request"), urn("request"), [uri, with_response, F.lit(
        "Content-Type: application/http; msgtype=request")],
        F.concat(F.lit("GET "), clean(F.col("url")), F.lit(f" HTTP/1.1{CRLF * 2}")))
    meta = record(F.lit("metadata"), urn("metadata"), [uri, with_response, F.lit("Content-Type: application/warc-fields")],
                  F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                           F.lit(f"{CRLF}payload-bytes: "), F.col("bytes").cast("string"), F.lit(CRLF)))
    return (found.withColumn("_n", F.monotonically_increasing_id())
            .select(F.explode(F.array(request, response, meta)).alias("value")))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write the pages' records as gzip-compressed archives below ``folder``."""
    (records(captures(pages, min_bytes)).write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", FILE_RECORDS).text(folder))


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields in lower case, block) of each record, by Content-Length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8", "replace").split(CRLF)
        if not first.startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(fields["content-length"])
        block = data[end + 4:end + 4 + size]
        if len(block) < size:
            raise ValueError("truncated record")
        yield fields, block
        at = end + 4 + size + 4


def read_archives(spark: SparkSession, folder: str, keep_payload: bool = True) -> DataFrame:
    """One row per record: record_type, record_id, concurrent_to, uri,
    refers_to, digest (of the payload read, else the one declared),
    payload_bytes, fields (of a metadata record) and, if kept, the payload."""
    schema = ("record_type string, record_id string, concurrent_to string, uri string, refers_to string, "
              "digest string, payload_bytes long, fields map<string,string>") + ", payload binary" * keep_payload

    def rows(data: bytes):
        for f, block in parse_archive(data):
            kind, declared = f["warc-type"], f.get("warc-payload-digest", "").removeprefix("sha1:")
            digest, size, info, body = declared or None, None, {}, None
            if kind in ("response", "revisit"):
                head, _, body = block.partition(b"\r\n\r\n")
                length = [x.partition(b":")[2] for x in head.split(CRLF.encode()) if x.lower().startswith(b"content-length:")]
                size = int(length[0]) if length else len(body)
                if kind == "response":
                    size = len(body)
                    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
                    if declared and declared != digest:
                        raise ValueError(f"payload digest differs in {f['warc-record-id']}")
            elif kind == "metadata":
                info = {k.strip(): v.strip() for k, _, v in (
                    x.partition(":") for x in block.decode("utf-8", "replace").split(CRLF) if x)}
            yield (kind, f["warc-record-id"], f.get("warc-concurrent-to"), f.get("warc-target-uri"),
                   f.get("warc-refers-to"), digest, size, info, *([body] * keep_payload))

    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for data in pdf["content"]:
                data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
                yield pd.DataFrame(list(rows(data)), columns=names).astype({"payload_bytes": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("content")
    return files.mapInPandas(run, schema)


def assemble(found: DataFrame) -> DataFrame:
    """One nested row per capture: its response (or revisit), request and
    metadata records, joined through concurrent-to identifiers."""
    nest = lambda *kinds: found.where(F.col("record_type").isin(*kinds))
    every = F.struct(*[F.col(c) for c in found.columns])
    response = nest("response", "revisit").select(F.col("record_id").alias("capture"), every.alias("response"))
    request = nest("request").select(F.col("concurrent_to").alias("capture"), every.alias("request"))
    meta = nest("metadata").select(F.col("concurrent_to").alias("capture"), every.alias("metadata"))
    return response.join(request, "capture", "left").join(meta, "capture", "left")


def op9_warc_transactions(spark, sf_dir) -> DataFrame:
    folder = new_folder(spark, "warc")
    write_archives(read_table(spark, sf_dir, "pages"), folder)
    rows = assemble(read_archives(spark, folder, keep_payload=False))
    page = F.col("metadata.fields")["page-id"]
    return rows.select(
        F.when(page != "", page.cast("long")).alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.digest").alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        F.regexp_extract("response.refers_to", r"<urn:page:(-?\d+)>", 1).try_cast("long").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS m FROM p GROUP BY h),
d AS (SELECT p.page_id, octet_length(encode(p.h))::BIGINT AS payload_bytes, sha1(p.h) AS x, m FROM p JOIN g ON p.h = g.h),
b AS (SELECT *, list_transform(range(0, 4), lambda k: ('0x' || x[10 * k + 1:10 * k + 10])::BIGINT) AS q FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((q[i // 8 + 1] >> (35 - 5 * (i % 8))) & 31)::INT + 1]), '') AS payload_digest,
       CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = m THEN NULL ELSE m END AS refers_to
FROM b
"""
