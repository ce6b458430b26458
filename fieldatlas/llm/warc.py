"""WARC archives of pages: written by Spark, read back, and joined to captures.

Every page becomes a request, a response (or revisit) and a metadata record; the
response and the metadata name the request in WARC-Concurrent-To.  A record ends
with two line breaks, so a text writer with that separator writes the archive
format itself, and every task rolls its files.  Reading parses the records by
their Content-Length and joins the three kinds through those identifiers into
one nested row per capture.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldatlas.llm.frames import arrow_map
from fieldatlas.operators.joins import lookup
from fieldatlas.session import Scratch

END = "\r\n\r\n"
RECORDS_PER_FILE = 3000
_STAMP = "2024-01-01T00:00:00Z"
_KINDS = ("request", "response", "revisit", "metadata")


# --- writing -------------------------------------------------------------------

def base32_sha1(value: Column) -> Column:
    """Bare upper-case base32 SHA-1: five hexadecimal digits make four letters."""
    digest = F.sha1(value)
    parts = []
    for k in range(8):
        digits = F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0")
        parts.append(F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))
    return F.concat(*parts)


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts]))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[
        F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">"))


def _record(kind: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind)]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in fields]  # null fields are left out
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def with_originals(pages: DataFrame, least: int) -> DataFrame:
    """Add payload, digest and ``original``: the largest page with the same payload, where that is long enough."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")) \
        .withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", base32_sha1(F.col("payload")))
    largest = rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.max("page_id").alias("original"))
    return lookup(rows, largest, "digest", "left")


def records(pages: DataFrame, least: int = 0) -> DataFrame:
    """``value``: the text of every record, without its end."""
    rows = with_originals(pages, least).withColumn("capture", F.expr("uuid()"))
    revisit = F.coalesce(F.col("page_id") < F.col("original"),
                         F.col("page_id").isNull() & F.col("original").isNotNull())
    request = _urn(F.lit("request"), F.col("capture"))
    response = _urn(F.lit("response"), F.col("digest"), F.col("page_id"))
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    host = F.regexp_extract(target, r"^[a-zA-Z]+://([^/?#]*)", 1)
    path = F.regexp_replace(target, r"^[a-zA-Z]+://[^/?#]*", "")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("bytes").cast("string"), F.lit(END))
    ask = F.concat(F.lit("GET "), F.coalesce(F.when(path != "", path), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "),
                   F.coalesce(host, F.lit("")), F.lit(END))
    about = F.concat(F.lit("pageId: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\n"))
    date = ("WARC-Date", F.lit(_STAMP))
    uri = ("WARC-Target-URI", target)
    # a repeated row of the largest page repeats its response, so that name is its own only with the capture
    own = F.when(revisit, _urn(F.lit("revisit"), F.col("capture"))).otherwise(response)
    three = F.array(
        _record(F.lit("request"), [("WARC-Record-ID", request), date, uri,
                                   ("Content-Type", F.lit("application/http; msgtype=request"))], ask),
        _record(F.when(revisit, "revisit").otherwise("response"),
                [("WARC-Record-ID", own), date, uri, ("WARC-Concurrent-To", request),
                 ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
                 ("WARC-Refers-To", F.when(revisit, _urn(F.lit("response"), F.col("digest"), F.col("original")))),
                 ("WARC-Profile", F.when(revisit, F.lit(
                     "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
                 ("Content-Type", F.lit("application/http; msgtype=response"))],
                F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("payload")))),
        _record(F.lit("metadata"), [("WARC-Record-ID", _urn(F.lit("metadata"), F.col("capture"))), date, uri,
                                    ("WARC-Concurrent-To", request),
                                    ("Content-Type", F.lit("application/warc-fields"))], about))
    return rows.select(F.explode(three).alias("value"))


def write(pages: DataFrame, folder: str, least: int = 0) -> None:
    """Write compressed archives of all pages; a file holds at most RECORDS_PER_FILE records."""
    records(pages, least).write.option("lineSep", END).option("maxRecordsPerFile", RECORDS_PER_FILE) \
                                .option("compression", "gzip").text(folder)


# --- reading -------------------------------------------------------------------

_HEAD = re.compile(rb"WARC/1\.[01]\r\n")


def parse(data: bytes) -> Iterator[tuple[dict[bytes, bytes], memoryview]]:
    """Header fields and block of each record of an archive, compressed or not."""
    raw, at = bytes(data), 0
    if raw.startswith(b"\x1f\x8b"):
        raw = gzip.decompress(raw)
    while at < len(raw):
        if not _HEAD.match(raw, at):
            raise ValueError(f"no record at byte {at}")
        stop = raw.index(b"\r\n\r\n", at)
        lines = raw[at:stop].split(b"\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(b":") for line in lines)}
        begin = stop + 4
        end = begin + int(fields[b"content-length"])
        yield fields, memoryview(raw)[begin:end]
        at = end + 4


def _read_step(batch: pa.RecordBatch) -> Iterator[dict]:
    for content in batch.column("content"):
        out: dict[str, list] = {k: [] for k in ("kind", "id", "request", "refers", "digest", "size", "found", "page", "uri",
                                                "payload")}
        text = lambda fields, k: fields[k].decode() if k in fields else None
        for fields, block in parse(content.as_py()):
            kind = fields[b"warc-type"].decode()
            if kind not in _KINDS:
                continue
            head, _, body = bytes(block).partition(b"\r\n\r\n")
            size = re.search(rb"(?im)^content-length:\s*(\d+)", head) if kind in ("response", "revisit") else None
            page = re.search(rb"(?m)^pageId: (\d+|-\d+)", bytes(block)) if kind == "metadata" else None
            out["kind"].append(kind)
            out["id"].append(text(fields, b"warc-record-id"))
            out["request"].append(out["id"][-1] if kind == "request" else text(fields, b"warc-concurrent-to"))
            out["refers"].append(text(fields, b"warc-refers-to"))
            out["digest"].append((text(fields, b"warc-payload-digest") or "").removeprefix("sha1:") or None)
            out["size"].append(int(size[1]) if size else None)
            out["found"].append(base64.b32encode(hashlib.sha1(body).digest()).decode() if kind == "response" else None)
            out["page"].append(int(page[1]) if page else None)
            out["uri"].append(text(fields, b"warc-target-uri"))
            out["payload"].append(body.decode("utf-8", "replace") if kind == "response" else None)
        for a in range(0, len(out["kind"]), 256):  # an archive goes on in small batches
            yield {k: v[a: a + 256] for k, v in out.items()}


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per request, response, revisit and metadata record of the archives in a folder."""
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", str((1 << 31) - 1))
    files = spark.read.format("binaryFile").load(folder).select("content")
    return arrow_map(files, "kind string, id string, request string, refers string, digest string, size long, "
                            "found string, page long, uri string, payload string", _read_step)


def captures(found: DataFrame, scratch: Scratch, payload: bool = True) -> DataFrame:
    """One nested row per capture: its request, response or revisit, and metadata.

    A revisit's ``refers_to`` is the page of the response it names.  A capture
    whose request or metadata is missing keeps its response with nulls there.
    Payloads are null for revisits, and left out with ``payload=False``.
    """
    saved = scratch.save(found if payload else found.drop("payload"))
    answer = saved.where(F.col("kind").isin("response", "revisit"))
    parts = ["kind", "id", "refers", "digest", "size", "found", *(["payload"] if payload else [])]
    answers = answer.select("request", F.struct(*parts).alias("response"))
    asked = saved.where("kind = 'request'").select("request", F.struct("id", "uri").alias("asked"))
    told = saved.where("kind = 'metadata'").groupBy("request").agg(F.first(F.struct("id", "page")).alias("metadata"))
    joined = answers.join(asked, "request", "left").join(told, "request", "left")
    # what a response is called and whose page it is, for those that revisits name
    named = joined.where(F.col("response.kind") == "response").groupBy(F.col("response.id").alias("_refers")) \
                  .agg(F.max("metadata.page").alias("refers_to"))
    return lookup(joined.withColumn("_refers", F.col("response.refers")), named, "_refers", "left").drop("_refers")


def archived(pages: DataFrame, scratch: Scratch, least: int = 0) -> DataFrame:
    """Write all pages to archives and assemble the captures read back.

    Null payloads are empty.  Rows repeated with the largest page id of their
    payload are all responses; a row without an id revisits any page that has one.
    """
    folder = f"{scratch.root}/archive"
    write(pages, folder, least)
    return captures(read(pages.sparkSession, folder), scratch, payload=False)
