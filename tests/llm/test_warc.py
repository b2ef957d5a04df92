import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from roadlark.llm import warc
from roadlark.llm.common import Scratch

PAGES = "page_id long, url string, html string"


def brute(rows, least=0):
    """(page_id, bytes, digest, type, refers_to), sorted, for every row."""
    groups = {}
    for page_id, _, html in rows:
        groups.setdefault((html or "").encode(), []).append(page_id)
    out = []
    for payload, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0))
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        for k, page_id in enumerate(ids):
            first = k == len(ids) - 1 or len(payload) < least
            out.append((page_id, len(payload), digest, "response" if first else "revisit", None if first else ids[-1]))
    return sorted(out, key=repr)


def result(spark, df, tmp_path, **options):
    path = str(tmp_path / "archives")
    warc.write(df, path, **options)
    captures = warc.assemble(warc.read(spark, path), Scratch(spark, "test"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in warc.resolved(captures).select(columns).collect()), key=repr)


def odd():
    text = "<p>é 日本 \r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n</p>"
    return [
        (1, "http://a/", "<p>one</p>"),
        (2, None, "<p>one</p>"),
        (2, None, "<p>one</p>"),
        (2, "http://b/", "<p>one</p>"),
        (None, "http://c/", "<p>one</p>"),
        (3, "http://a\r\nX: y/", text),
        (4, "", text),
        (5, "http://e/", None),
        (6, "http://e/", ""),
        (None, None, None),
        (-7, "http://f/", "x" * 300_000),
        (8, "http://f/", "\x00\x1f\x8b"),
    ]


@pytest.mark.parametrize("least", [0, 12])
def test_odd_rows_equal_brute_force(spark, tmp_path, least):
    df = spark.createDataFrame(odd(), PAGES).repartition(3)
    df = df.withColumns({n: F.lit("x") for n in ("copies", "size", "type", "record_id", "same", "at")})
    assert result(spark, df, tmp_path, least_bytes=least) == brute(odd(), least)


def test_many_copies_and_small_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 500)
    monkeypatch.setattr(warc, "_BLOCK", 7)
    monkeypatch.setattr(warc, "_BATCH", 1000)
    rng = random.Random(3)
    rows = [(rng.randint(0, 60), f"u{rng.randint(0, 2)}", f"page {rng.choice([0, 0, 0, 1, 2, 3])}") for _ in range(400)]
    assert result(spark, spark.createDataFrame(rows, PAGES).repartition(5), tmp_path, compression="none") == brute(rows)


def test_empty_table(spark, tmp_path):
    assert result(spark, spark.createDataFrame([], PAGES), tmp_path) == []


def record(kind, record_id, *more, body=b"", content_type="text/plain"):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"warc-record-id: {record_id}", f"Content-Type: {content_type}", *more]
    return "\r\n".join([*lines, f"Content-Length: {len(body)}", "", ""]).encode() + body + b"\r\n\r\n"


def test_foreign_archive(spark, tmp_path):
    """Members per record, indirect and reversed links, several captures, orphans and damage."""
    to = "WARC-Concurrent-To: "
    records = [
        record("warcinfo", "i"),
        record("response", "r1", to + "q1", body=b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody", content_type="application/http; msgtype=response"),
        record("request", "q1", body=b"GET / HTTP/1.1\r\n\r\n", content_type="application/http"),
        record("metadata", "m1", to + "q1", body=b"page-id: 5\r\nvia: x\r\n  y\r\n", content_type="application/warc-fields"),
        record("metadata", "m2", to + "m1"),
        record("resource", "r2", body=b"plain\r\n\r\ntext"),
        record("metadata", "m3", to + "r1", to + "r2"),
        record("request", "q9", to + "lost"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    (tmp_path / "b.warc").write_bytes(b"junk\r\n" + record("resource", "r3") + b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort")
    rows = warc.read(spark, str(tmp_path))
    assert [r.payload for r in rows.where("type = 'damaged'").orderBy("start").collect()] == [
        b"junk\r\n",
        b"WARC/1.1\r\nContent-Length: 99\r\n\r\nshort",
    ]
    found = {r.capture_id: r for r in warc.assemble(rows, Scratch(spark, "test")).collect()}
    assert set(found) == {"r1", "r2", "r3", "lost", "i"}
    assert [r.record_id for r in found["r1"].requests] == ["q1"]
    assert [r.record_id for r in found["r1"].metadata] == ["m1", "m2", "m3"]
    assert [r.record_id for r in found["r2"].metadata] == ["m3"]
    assert found["r1"].metadata[0].fields == {"page-id": "5", "via": "x y"}
    assert bytes(found["r1"].response.payload) == b"body" and bytes(found["r2"].response.payload) == b"plain\r\n\r\ntext"
    assert found["lost"].response is None and [r.record_id for r in found["lost"].requests] == ["q9"]
    assert [r.type for r in found["i"].others] == ["warcinfo"]


def test_each_hash_is_computed_once_per_record(spark):
    """Base32 letters and id pieces are taken from hash columns, not from a hash each."""
    df = spark.createDataFrame(odd(), PAGES).repartition(3)
    plan = warc.records(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sha1(") <= 3
    assert plan.count("sha2(") <= 20
