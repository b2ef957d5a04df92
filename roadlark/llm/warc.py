"""WARC archives: pages written as request, response or revisit and metadata records, records read
back, and transactions assembled to one nested row per capture.

Writing.  Pages with equal payloads share one ``response`` record, that of the largest page id; the
others become ``revisit`` records which name it in ``WARC-Refers-To``.  Payloads of fewer than
``least_bytes`` bytes are always written in full.  Rows that are equal in all columns are counted
before any shuffle, and each payload travels once per task, so a page copied a billion times sends
one row per task.  The records of a capture stand together: the response or revisit first, then
request and metadata, which name it in ``WARC-Concurrent-To``.

Reading.  Every file is read whole by one task, hence ``ARCHIVE_BYTES`` bounds what ``write`` puts
into one.  Archives may be plain or gzipped (one member per record, or any other number of members).  Records
are cut by their Content-Length, so a payload may hold anything, WARC headers too.  Where no record
begins or one ends early, a row of type ``damaged`` covers the bytes up to the next ``WARC/1.`` that
starts a line.

Assembly.  A response, revisit, resource or conversion record is a capture of its own.  Any other
record belongs to the captures that it reaches through concurrent-to identifiers, in either
direction and over any number of records between; a record that reaches none makes a capture
without response, under the name it refers to or, without one, its own.

Odd input: a null html is an empty payload, a null url leaves the target URI out, a null page id is
smaller than all others and leaves the id out of the metadata.  Equal rows are captures of their
own: one response, the rest revisits.  Line breaks in urls are percent-encoded.  Empty tables give
archives without records and no rows.  Columns of the input other than those named are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlark.llm.common import Scratch

ARCHIVE_BYTES = 32 << 20  # payload that write() aims at per file
DATE = "2000-01-01T00:00:00Z"

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = ("response", "revisit", "resource", "conversion")
LINE = "\r\n"

_BATCH = 16 << 20  # bytes of payload per Arrow batch
_BLOCK = 10_000  # copies of one row that one task writes


def _uuid(h: Column) -> Column:
    """A record id of a hexadecimal SHA-256."""
    pieces = [F.substring(h, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _fives(hexadecimal: Column) -> Column:
    """The numbers of each five digits of a 40-digit hexadecimal SHA-1."""
    return F.array(*[F.conv(F.substring(hexadecimal, start, 5), 16, 10).cast("int") for start in range(1, 41, 5)])


def _base32(fives: Column) -> Column:
    """Base32 of a SHA-1: each five hexadecimal digits are four letters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for k in range(8):
        for shift in (15, 10, 5, 0):
            five = F.shiftright(fives[k], shift).bitwiseAND(F.lit(31))
            out.append(F.substring(letters, five + 1, F.lit(1)))
    return F.concat(*out)


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; those without a value are left out."""
    named = [F.concat(F.lit(f"{name}: "), value, F.lit(LINE)) for name, value in pairs]
    return F.concat_ws("", *named)


def _record(kind: Column, record_id: Column, date: str, more: list, block: Column, size: Column) -> Column:
    head = _lines(
        ("WARC-Type", kind),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", F.lit(date)),
        *more,
        ("Content-Length", size.cast("string")),
    )
    return F.concat(F.lit(VERSION + LINE), head, F.lit(LINE), block, F.lit(LINE))


def records(pages: DataFrame, least_bytes: int = 0, date: str = DATE) -> DataFrame:
    """One string per capture of ``pages`` (page_id, url, html): its three records, without the last
    line break."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", F.sha2(html, 256).alias("same"), html.alias("html"))
    rows = rows.withColumn("size", F.octet_length("html").cast("bigint"))

    counted = rows.groupBy("same", "size", "page_id", "url").agg(F.count("*").alias("copies"))
    shared = F.col("size") >= least_bytes
    first = rows.where(shared).groupBy("same").agg(
        F.max(F.struct("page_id", "url")).alias("page"), F.first("html").alias("html"), F.first("size").alias("size")
    )
    responses = first.select("page.page_id", "page.url", "same", "size", "html", F.lit(0).cast("bigint").alias("copy"))
    small = rows.where(~shared).groupBy("same", "size", "page_id", "url").agg(
        F.first("html").alias("html"), F.count("*").alias("copies")
    )
    small = _copies(small, F.lit(0)).select("page_id", "url", "same", "size", "html", "copy")

    # The largest page of a payload is found once more on rows without text: no wide join.
    winners = counted.where(shared).groupBy("same").agg(F.max(F.struct("page_id", "url")).alias("page"))
    wins = winners.select("same", "page.page_id", "page.url", F.lit(1).alias("one"))
    again = (
        counted.where(shared).select("same", "size", "page_id", "url", "copies", F.lit(0).alias("one"))
        .unionByName(wins.select("same", F.lit(0).cast("bigint").alias("size"), "page_id", "url", F.lit(0).cast("bigint").alias("copies"), "one"))
        .groupBy("same", "page_id", "url")
        .agg(F.max("size").alias("size"), F.sum("copies").alias("copies"), F.sum("one").alias("one"))
    )
    revisits = _copies(again, F.col("one")).select("page_id", "url", "same", "size", F.lit(None).cast("string").alias("html"), "copy")
    every = responses.unionByName(revisits).unionByName(small)
    # Hashes are columns of their own: written into the text's expression, which takes them apart
    # letter by letter, each would be computed once per letter or piece.
    full = F.col("html").isNotNull()
    key = F.concat_ws(
        ":", "same", F.coalesce(F.col("page_id").cast("string"), F.lit(" ")), F.coalesce("url", F.lit("\n")), F.col("copy").cast("string")
    )
    texts = {"_row": key, "_request": F.concat(F.lit("request:"), key), "_metadata": F.concat(F.lit("metadata:"), key)}
    hashes = {name: F.sha2(text, 256) for name, text in texts.items()}
    hashes["_payload"] = F.sha2(F.concat(F.lit("payload:"), "same"), 256)
    # A response's payload is hashed where it is written, a revisit's digest is that of the record it names.
    hashes["_sha1"] = F.when(full, F.sha1("html"))
    hashed = every.withColumns(hashes).withColumn("_fives", F.when(full, _fives(F.col("_sha1"))))
    ids = {name: _uuid(F.col(name)) for name in (*texts, "_payload")}
    named = hashed.withColumns({**ids, "_digest": F.concat(F.lit("sha1:"), _base32(F.col("_fives")))})
    return named.select(_capture(least_bytes, date).alias("value"))


def _copies(rows: DataFrame, begin: Column) -> DataFrame:
    """Each row once for every number from ``begin`` (1 at most) up to ``copies``; long runs are dealt out in blocks."""
    blocks = rows.where(F.col("copies") > begin).select(
        *[c for c in rows.columns if c != "copies"],
        F.col("copies").alias("upto"),
        F.explode(F.sequence(begin.cast("bigint"), F.col("copies") - 1, F.lit(_BLOCK).cast("bigint"))).alias("at"),
    )
    end = F.least(F.col("at") + _BLOCK, F.col("upto")) - 1
    return blocks.withColumn("copy", F.explode(F.sequence("at", end))).drop("at", "upto")


def _capture(least_bytes: int, date: str) -> Column:
    full = F.col("html").isNotNull()
    size = F.col("size")
    payload_id = F.col("_payload")
    record_id = F.when(full & (size >= least_bytes), payload_id).otherwise(F.col("_row"))
    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    kind = F.when(full, F.lit("response")).otherwise(F.lit("revisit"))
    refers = F.when(~full, payload_id)
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}Content-Length: "),
        size.cast("string"),
        F.lit(LINE + LINE),
    )
    body = F.concat(http, F.coalesce("html", F.lit("")))
    length = F.octet_length(http) + F.when(full, size).otherwise(0)
    page = _record(
        kind,
        record_id,
        date,
        [
            ("WARC-Target-URI", uri),
            ("WARC-Profile", F.when(~full, F.lit(REVISIT_PROFILE))),
            ("WARC-Refers-To", refers),
            ("WARC-Payload-Digest", F.col("_digest")),
            ("Content-Type", F.lit("application/http;msgtype=response")),
        ],
        body,
        length,
    )
    ask = F.concat(F.lit("GET "), F.coalesce(uri, F.lit("/")), F.lit(f" HTTP/1.1{LINE}{LINE}"))
    request = _record(
        F.lit("request"),
        F.col("_request"),
        date,
        [
            ("WARC-Target-URI", uri),
            ("WARC-Concurrent-To", record_id),
            ("Content-Type", F.lit("application/http;msgtype=request")),
        ],
        ask,
        F.octet_length(ask),
    )
    fields = _lines(("page-id", F.col("page_id").cast("string")))
    metadata = _record(
        F.lit("metadata"),
        F.col("_metadata"),
        date,
        [
            ("WARC-Target-URI", uri),
            ("WARC-Concurrent-To", record_id),
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        fields,
        F.octet_length(fields),
    )
    return F.concat(page, F.lit(LINE), request, F.lit(LINE), metadata)


def write(pages: DataFrame, path: str, least_bytes: int = 0, compression: str = "gzip", date: str = DATE) -> None:
    """Write archives of ``pages`` into a new folder.  The rows of a file are limited by the mean
    size of a page, so that a file holds about ``ARCHIVE_BYTES``."""
    n, total = pages.agg(F.count("*"), F.sum(F.octet_length("html").cast("bigint"))).first()
    rows = max(1, ARCHIVE_BYTES * n // max(total or 1, 1))
    writer = records(pages, least_bytes, date).write.option("lineSep", LINE).option("compression", compression)
    writer.option("maxRecordsPerFile", min(rows, 1 << 30)).text(path)


RECORD = (
    "archive string, start long, type string, record_id string, target_uri string, date string, "
    "concurrent_to array<string>, refers_to string, declared_digest string, content_type string, "
    "payload_bytes long, payload_digest string, fields map<string,string>, payload binary"
)
_ARROW = pa.schema(
    [
        ("archive", pa.string()),
        ("start", pa.int64()),
        ("type", pa.string()),
        ("record_id", pa.string()),
        ("target_uri", pa.string()),
        ("date", pa.string()),
        ("concurrent_to", pa.list_(pa.string())),
        ("refers_to", pa.string()),
        ("declared_digest", pa.string()),
        ("content_type", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("fields", pa.map_(pa.string(), pa.string())),
        ("payload", pa.binary()),
    ]
)


def _headers(block: bytes) -> list[tuple[str, str]]:
    """Name and value of each header line; a line that begins blank continues the one before."""
    out: list[tuple[str, str]] = []
    for line in block.split(b"\n"):
        text = line.rstrip(b"\r").decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {text.strip()}")
        elif ":" in text:
            name, _, value = text.partition(":")
            out.append((name.strip().lower(), value.strip()))
    return out


def _next_record(data: bytes, at: int) -> int:
    """The next place behind ``at`` where a line starts with a WARC version."""
    found = data.find(b"\nWARC/1.", at)
    return len(data) if found < 0 else found + 1


def parse(data: bytes) -> Iterator[dict]:
    """The records of one archive, uncompressed or of gzip members; payloads are views of it."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.GzipFile(fileobj=io.BytesIO(data)).read()
    at, end, view = 0, len(data), memoryview(data)
    while at < end:
        if data[at : at + 1] in (b"\r", b"\n"):
            at += 1
            continue
        start, stop = at, data.find(b"\r\n\r\n", at)
        headers = _headers(data[at:stop]) if stop >= 0 and data.startswith(b"WARC/1.", at) else []
        known = dict(headers)
        length = known.get("content-length", "")
        if not (length.isascii() and length.isdigit()) or stop + 4 + int(length) > end:
            at = _next_record(data, at)
            yield {"start": start, "type": "damaged", "payload": view[start:at]}
            continue
        body, at = stop + 4, stop + 4 + int(length)
        content_type = known.get("content-type", "")
        kind = known.get("warc-type")
        if content_type.lower().startswith("application/http"):
            split = data.find(b"\r\n\r\n", body, at)
            payload = view[at:at] if split < 0 else view[split + 4 : at]
        else:
            payload = view[body:at]
        fields = None
        if content_type.lower().startswith("application/warc-fields"):
            fields = list(dict(_headers(data[body:at])).items())
        yield {
            "start": start,
            "type": kind,
            "record_id": known.get("warc-record-id"),
            "target_uri": known.get("warc-target-uri"),
            "date": known.get("warc-date"),
            "concurrent_to": [v for n, v in headers if n == "warc-concurrent-to"],
            "refers_to": known.get("warc-refers-to"),
            "declared_digest": known.get("warc-payload-digest"),
            "content_type": content_type,
            "fields": fields,
            "payload": payload,
        }


def _read(batches: Iterator[pa.RecordBatch], payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            rows, size = [], 0
            for row in parse(content.as_py()):
                payload = row["payload"]
                row["archive"] = path.as_py()
                row["payload_bytes"] = len(payload)
                row["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                row["payload"] = bytes(payload) if payloads else None
                rows.append(row)
                size += 500 + (len(payload) if payloads else 0)
                if size >= _BATCH:
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)
                    rows, size = [], 0
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives below ``path``; without ``payloads`` their bytes are left out,
    their digests and lengths are not."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(lambda b: _read(b, payloads), RECORD)


def assemble(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """One nested row per capture: capture_id, response (null if none was found), requests, metadata
    and others (arrays, ordered by record id).  An array is as long as the capture has records."""
    rows = scratch.keep(rows.where("type IS NULL OR type <> 'damaged'"))
    is_capture = F.coalesce(F.col("type").isin(*CAPTURES), F.lit(False))
    captures = rows.where(is_capture)
    others = rows.where(~is_capture)
    pairs = rows.select("record_id", F.explode("concurrent_to").alias("named")).where("record_id <> named")
    edges = pairs.unionByName(pairs.select(F.col("named").alias("record_id"), F.col("record_id").alias("named")))
    ids = captures.select(F.col("record_id").alias("named")).distinct()
    free = others.select("record_id").distinct()

    # Records that name a capture, or that a capture names, then those next to them, and so on.
    found = scratch.keep(edges.join(free, "record_id").join(ids, "named", "left_semi").distinct())
    member = found
    while True:
        left = scratch.keep(free.join(member, "record_id", "left_anti"))
        if left.isEmpty():
            break
        near = member.select(F.col("record_id").alias("via"), F.col("named").alias("capture"))
        step = edges.join(left, "record_id").join(near, F.col("named") == F.col("via"))
        step = scratch.keep(step.select("record_id", F.col("capture").alias("named")).distinct())
        if step.isEmpty():
            alone = others.join(left, "record_id", "left_semi")
            names = F.coalesce(F.array_min("concurrent_to"), "record_id")
            member = member.unionByName(alone.select("record_id", names.alias("named")).distinct())
            break
        member = scratch.keep(member.unionByName(step))

    part = F.struct(*[c for c in rows.columns if c != "concurrent_to"])
    joined = others.join(member, others["record_id"].eqNullSafe(member["record_id"]), "left")
    sides = joined.select(
        F.coalesce("named", F.array_min("concurrent_to")).alias("capture_id"),
        "type",
        F.struct(*[others[c].alias(c) for c in rows.columns if c != "concurrent_to"]).alias("part"),
    )
    sides = sides.groupBy("capture_id").agg(
        _ordered("request").alias("requests"),
        _ordered("metadata").alias("metadata"),
        _ordered(None).alias("others"),
    )
    whole = captures.select(F.col("record_id").alias("id"), part.alias("response"))
    both = whole.join(sides, F.col("id") == F.col("capture_id"), "full")
    empty = F.array().cast(both.schema["requests"].dataType)
    return both.select(
        F.coalesce("id", "capture_id").alias("capture_id"),
        "response",
        *[F.coalesce(F.col(c), empty).alias(c) for c in ("requests", "metadata", "others")],
    )


def _ordered(kind: str | None) -> Column:
    known = F.coalesce(F.col("type"), F.lit(""))
    wanted = known == kind if kind else ~known.isin("request", "metadata")
    listed = F.collect_list(F.when(wanted, F.col("part")))
    # Maps cannot be compared: by record id and place.
    key = lambda x: F.concat_ws(" ", x["record_id"], x["archive"], F.lpad(x["start"].cast("string"), 20, "0"))
    by_key = lambda a, b: F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)
    return F.array_sort(listed, by_key)


def resolved(captures: DataFrame) -> DataFrame:
    """Captures with page_id, payload_bytes, payload_digest, record_type and refers_to (a page id).

    A revisit has the payload of the record that it names.  If that is not there, its length is
    unknown and its digest the declared one."""
    fields = F.col("metadata")[0]["fields"]
    rows = captures.where("response IS NOT NULL").select(
        "capture_id",
        F.try_element_at(fields, F.lit("page-id")).cast("bigint").alias("page_id"),
        F.col("response.target_uri").alias("url"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("named"),
        F.col("response.payload_bytes").alias("own_bytes"),
        F.col("response.payload_digest").alias("own_digest"),
        F.col("response.declared_digest").alias("declared"),
    )
    full = rows.where("record_type <> 'revisit'")
    target = full.select(
        F.col("capture_id").alias("named"),
        F.col("page_id").alias("refers_to"),
        F.col("own_bytes").alias("payload_bytes"),
        F.col("own_digest").alias("payload_digest"),
    )
    again = rows.where("record_type = 'revisit'").join(target, "named", "left")
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    plain = full.withColumnsRenamed({"own_bytes": "payload_bytes", "own_digest": "payload_digest"})
    declared = F.regexp_replace("declared", "^[A-Za-z0-9]+:", "")
    again = again.withColumn("payload_digest", F.coalesce("payload_digest", declared))
    return plain.withColumn("refers_to", F.lit(None).cast("bigint")).select(columns).unionByName(again.select(columns))
