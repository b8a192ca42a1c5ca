"""WARC archives: exact round trips, damaged files, false magic and range borders."""

import gzip
import hashlib
import random
import zlib

import pytest

from lakefold.llm import warc

PAGES = "/root/testdata/sf0.001/pages.parquet"


def response(k, payload):
    digest = hashlib.sha1(payload).hexdigest()
    return warc.record_bytes(str(k), f"http://x/{k}", digest, payload, len(payload), None)


def stored(data):
    """A member whose stream holds the data as it is, with the magic inside."""
    pack = zlib.compressobj(0, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def by_force(rows):
    most = {}
    for i, _, html in rows:
        p = (html or "").encode()
        if len(p) >= warc.LEAST_SHARED and i is not None:
            most[p] = max(most.get(p, i), i)
    out = []
    for i, _, html in rows:
        p = (html or "").encode()
        other = p in most and most[p] != i
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if other else "response", most[p] if other else None))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archive_report(df).collect()), key=str)


def test_pages(spark):
    df = spark.read.parquet(PAGES)
    assert found(df) == by_force([tuple(r) for r in df.select("page_id", "url", "html").collect()])


def test_edge_pages(spark):
    long = "long page " * 200
    rows = [(1, "http://a", long), (2, None, long), (3, "http://c", long), (4, "http://d", "short"), (5, "http://e", "short"),
            (6, "http://f", None), (7, "http://g", ""), (8, "http://h", "x" * (17 << 20)), (9, "http://i", "é" * 600), (10, "http://i", "é" * 600),
            (11, "http://k", "WARC/1.1\r\n\r\nHTTP/1.1 200 OK\r\n\r\n"), (None, "http://l", "no id"), (3, "http://c", long)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS digest", "'x' AS payload", "2 AS size", "'y' AS holder")
    assert found(df) == by_force(rows)
    back = {r.page_id: r.url for r in warc.archive_report(df).collect()}
    assert back[2] is None and back[1] == "http://a"
    assert warc.archive_report(df.limit(0)).count() == 0


def test_archives_are_plain_gzip(spark, tmp_path):
    df = spark.read.parquet(PAGES)
    warc.write_archives(warc.plan_records(df), str(tmp_path / "w"))
    n = 0
    for file in (tmp_path / "w").glob("part-*"):
        n += gzip.decompress(file.read_bytes()).count(b"WARC/1.1\r\n")
    assert n == df.count()


@pytest.mark.parametrize("span", ["700", "4000", "100000"])
def test_ranges_and_false_magic(spark, tmp_path, span):
    draw = random.Random(1)
    payloads = []
    for k in range(60):
        body = bytes(draw.randrange(256) for _ in range(draw.randint(0, 2500)))
        for _ in range(draw.randint(0, 3)):
            at = draw.randint(0, len(body))
            body = body[:at] + draw.choice([warc.MAGIC, warc.MAGIC + b"\0" * 7, gzip.compress(b"inner"), gzip.compress(b"WARC/1.1\r\n\r\n")]) + body[at:]
        payloads.append(body)
    members = [stored(response(k, p)) if k % 2 else warc.gzip_member(response(k, p)) for k, p in enumerate(payloads)]
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.warc").write_bytes(b"".join(members[:40]))
    (tmp_path / "a" / "two.warc").write_bytes(b"\0".join(members[40:]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", span)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        rows = warc.read_archives(spark, str(tmp_path / "a")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert sorted((int(r.record_id), bytes(r.payload)) for r in rows if r.record_type == "response") == list(enumerate(payloads))
    assert not [r for r in rows if r.record_type == "damaged"]


def test_damaged_bytes_are_reported(spark, tmp_path):
    members = [warc.gzip_member(response(k, b"payload %d" % k)) for k in range(4)]
    (tmp_path / "one.warc").write_bytes(b"junk" + members[0] + members[1][:-20] + members[2] + gzip.compress(b"no record") + members[3])
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert sorted(int(r.record_id) for r in rows if r.record_type == "response") == [0, 2, 3]
    assert sum(r.record_type == "damaged" for r in rows) >= 2
