"""WARC archives: writing pages as request, response and metadata records, reading archives
back, and assembling transactions.

Writing is a text sink whose line separator is the blank line that ends a record, so that the
archives go to any folder that Spark writes to. Pages with equal payloads of ``REVISIT_BYTES``
or more are written once: the one with the largest page id is the response, the others are
revisits of it. Archives are bounded in size, and a reading task streams through an archive
record by record.

``assemble`` joins the records of a capture through the identifiers that requests and
metadata are concurrent to, and gives one nested row per response or revisit.

Defined results: a null html is an empty payload, a null url an empty one; blanks and control
characters of urls are escaped; null and repeated page ids are captures of their own; an empty
table gives archives without records and an empty result; extra columns are not read. Requests
and metadata whose capture is in no archive make no row; a record that stands in several
archives counts once.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.common import ship_with_job, staged
from tablewright.plans.staging import new_path

REVISIT_BYTES = 1000
ARCHIVE_BYTES = 16 << 20        # uncompressed, on average
BATCH_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"   # the pages have no time of their own
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _identifier(kind: str, page: str = "page_id", row: str = "_row") -> Column:
    digest = F.md5(F.concat_ws("-", F.lit(kind), F.coalesce(F.col(page).cast("string"), F.lit("")),
                               F.col(row).cast("string")))
    parts = [F.substring(digest, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: Column, identifier: Column, uri: Column, content_type: str, block: Column,
            *fields: tuple[str, Column]) -> Column:
    """Header and block of a record; a field with a null value is left out."""
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind),
             F.concat(F.lit("WARC-Record-ID: "), identifier), F.lit(f"WARC-Date: {DATE}"),
             F.concat(F.lit("WARC-Target-URI: "), uri)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    lines += [F.lit(f"Content-Type: {content_type}"),
              F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def write_warc(pages: DataFrame, path: str) -> None:
    """Archives below ``path``, three records per row of ``pages`` (page_id, url, html)."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20]", "%20")
                        .alias("url"), html.alias("html"),
                        F.monotonically_increasing_id().alias("_row"))
    # numbered and written once: a row keeps its number whatever is read of it, and in every run
    rows = staged(rows.withColumns({"_digest": F.sha1("html"), "_bytes": F.octet_length("html").cast("long")}),
                  "warc-pages")
    light = rows.select("page_id", "_row", "_digest", "_bytes")
    size = light.agg(F.sum("_bytes").alias("b"), F.count("*").alias("n")).first()
    per_page = (size["b"] or 0) / max(size["n"], 1) + 1500
    first = F.max(F.struct("page_id", "_row"))
    kept = staged(light.filter(F.col("_bytes") >= REVISIT_BYTES).groupBy("_digest")
                  .agg(first.alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
                  .select("_digest", F.col("_first.page_id").alias("_page"), F.col("_first._row").alias("_at")),
                  "warc-repeats")
    # the table of repeated payloads is written, so that Spark knows its size when it picks
    # the join; a hot payload is split by the adaptive plan
    rows = rows.join(kept, "_digest", "left")
    revisit = F.col("_at").isNotNull() & (F.col("_at") != F.col("_row"))
    uri, capture = F.col("url"), _identifier("capture")
    head = F.concat(F.lit("HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF
                          + "Content-Length: "), F.col("_bytes").cast("string"), F.lit(CRLF + CRLF))
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1)
    target = F.regexp_extract("url", r"^[a-z]+://[^/?#]*(.*)$", 1)
    request = _record(
        F.lit("request"), _identifier("request"), uri, "application/http;msgtype=request",
        F.concat(F.lit("GET "), F.when(F.startswith(target, F.lit("/")), target)
                 .otherwise(F.concat(F.lit("/"), target)),
                 F.lit(" HTTP/1.1" + CRLF + "Host: "), host, F.lit(CRLF + CRLF)),
        ("WARC-Concurrent-To", capture))
    response = _record(
        F.when(revisit, "revisit").otherwise("response"), capture, uri,
        "application/http;msgtype=response", F.when(revisit, head).otherwise(F.concat(head, F.col("html"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_digest"))),
        ("WARC-Refers-To", F.when(revisit, _identifier("capture", "_page", "_at"))),
        ("WARC-Profile", F.when(revisit, F.lit(PROFILE))))
    fields = F.concat_ws(
        CRLF, F.concat(F.lit("page: "), F.col("page_id").cast("string")),
        F.concat(F.lit("payloadLength: "), F.col("_bytes").cast("string")),
        F.when(revisit, F.concat(F.lit("refersToPage: "), F.col("_page").cast("string"))))
    metadata = _record(F.lit("metadata"), _identifier("metadata"), uri, "application/warc-fields",
                       F.concat(fields, F.lit(CRLF)), ("WARC-Concurrent-To", capture))
    (rows.select(F.concat_ws(CRLF * 2, request, response, metadata).alias("value"))
     .write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED")
     .option("maxRecordsPerFile", max(1, int(ARCHIVE_BYTES / per_page))).text(path))


RECORD = ("record_id string, type string, concurrent_to string, refers_to string, target_uri string,"
          " date string, digest string, content_type string, http_head string, payload binary")


def records_of(archive: io.BufferedIOBase) -> Iterator[tuple]:
    """The records of an open archive, one after the other; for http the payload is the body."""
    while True:
        line = archive.readline()
        if not line:
            return
        if line in (b"\r\n", b"\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        fields: dict[str, str] = {}
        last = ""
        while (line := archive.readline()) not in (b"\r\n", b"\n", b""):
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            if text[:1] in (" ", "\t") and last:  # a folded line goes on
                fields[last] += " " + text.strip()
                continue
            name, _, value = text.partition(":")
            last = name.strip().lower()
            fields[last] = value.strip()
        size = int(fields.get("content-length", "0"))
        block = archive.read(size)
        if len(block) < size:
            raise ValueError(f"record {fields.get('warc-record-id')} is cut off")
        kind, head = fields.get("content-type", ""), None
        if kind.startswith("application/http"):
            top, gap, body = block.partition(b"\r\n\r\n")
            head, block = top.decode("latin-1"), body if gap else b""
        yield (fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-concurrent-to"),
               fields.get("warc-refers-to"), fields.get("warc-target-uri"), fields.get("warc-date"),
               fields.get("warc-payload-digest"), kind, head, block)


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [f.split()[0] for f in RECORD.split(", ")]
    rows, held = [], 0
    for batch in batches:
        for content in batch["content"]:
            raw = io.BytesIO(content)
            packed = content[:2] == b"\x1f\x8b"
            archive = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if packed else raw
            for record in records_of(archive):
                rows.append(record)
                held += len(record[-1]) + 500
                if held >= BATCH_BYTES:
                    yield pd.DataFrame(rows, columns=names)
                    rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``, packed by gzip or not. A task holds
    one archive of at most 2 GB, and of its records a few at a time."""
    ship_with_job()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.filter("length > 0").select("content").mapInPandas(_parse, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """(capture_id, response, request, metadata): one row per capture, the other columns of
    ``records`` nested. One shuffle by the capture's identifier, which is no hot key."""
    fields = F.struct(*[c for c in records.columns if c != "concurrent_to"])
    is_capture = F.col("type").isin("response", "revisit")
    keyed = records.withColumn("capture_id", F.when(is_capture, F.col("record_id"))
                               .otherwise(F.col("concurrent_to"))).filter("capture_id IS NOT NULL")
    return (keyed.groupBy("capture_id").agg(
        F.max(F.when(is_capture, fields)).alias("response"),
        F.max(F.when(F.col("type") == "request", fields)).alias("request"),
        F.max(F.when(F.col("type") == "metadata", fields)).alias("metadata"))
        .filter("response IS NOT NULL"))


def capture_report(pages: DataFrame) -> DataFrame:
    """Write ``pages``, read the archives back, and give one row of digests per capture."""
    spark = pages.sparkSession
    path = new_path(spark, "llm-warc")
    write_warc(pages, path)
    records = read_warc(spark, path)
    light = records.select(
        "record_id", "type", "concurrent_to", "digest",
        F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("sha1"),
        F.when(F.col("type") == "metadata", F.decode("payload", "UTF-8")).alias("fields"))
    revisit = F.col("response.type") == "revisit"

    def field(name: str) -> Column:
        found = F.regexp_extract("metadata.fields", rf"(?m)^{name}: (-?\d+)", 1)
        return F.when(found != "", found).cast("long")

    return assemble(light).select(
        field("page").alias("page_id"),
        F.when(revisit, field("payloadLength")).otherwise(F.col("response.bytes")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("response.digest", "^sha1:", ""))
        .otherwise(F.col("response.sha1")).alias("payload_digest"),
        F.col("response.type").alias("record_type"), field("refersToPage").alias("refers_to"))
