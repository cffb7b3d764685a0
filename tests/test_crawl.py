import gzip

import pytest
from pyspark.sql import functions as F

from corpusmill.operators import batching
from corpusmill.sources import crawl, sinks


def record(url, body, kind="response"):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Block-Digest: sha1:X\r\nContent-Length: {len(http)}\r\n\r\n"
    return gzip.compress(head.encode() + http + b"\r\n\r\n")


def test_cdx(spark):
    line = 'com,a)/ 20240101 {"url":"http://a/","filename":"f","offset":"7","length":"3"}'
    got = spark.createDataFrame([(line,)], "value string").select(*crawl.cdx_columns(F.col("value"))).first()
    assert tuple(got) == ("http://a/", "f", 7, 3)


def test_ranges(spark):
    rows = spark.createDataFrame([("f", 10, 5), ("f", 0, 10), ("f", 10, 5)], "filename string, offset long, length long")
    index = crawl.warc_index(rows)
    assert crawl.byte_range_requests(index).first()["header"] == "bytes=0-9, 10-14"
    assert [r["header"] for r in crawl.byte_range_requests(index, 1).orderBy("request_no").collect()] == ["bytes=0-9", "bytes=10-14"]


def test_warc_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.warc.gz").write_bytes(record("http://a/", b"<p>A") + record("http://q/", b"no", "request") + record("http://b/", b"B"))
    got = crawl.read_warc(spark, str(tmp_path)).orderBy("url").collect()
    assert [(r["url"], bytes(r["payload"])) for r in got] == [("http://a/", b"<p>A"), ("http://b/", b"B")]
    assert len(got[0]["id"]) == 64 and got[0]["warc_block_digest"] == "sha1:X"


def test_range_answers():
    a, b = record("http://a/", b"A"), record("http://b/", b"B")
    part = lambda x: b"--B\r\nContent-Type: x\r\nContent-Range: bytes 0-1/2\r\n\r\n" + x + b"\r\n"
    body = part(a) + part(b"not gzip") + part(b) + b"--B--\r\n"
    assert len(crawl.parse_range_answer(206, "multipart/byteranges; boundary=B", body)) == 2
    assert len(crawl.parse_range_answer(206, "application/octet-stream", a)) == 1
    assert crawl.parse_range_answer(200, "application/octet-stream", a) == []
    assert crawl.parse_range_answer(206, "text/html", a) == []


def test_fetch(spark):
    a = record("http://a/", b"A")
    requests = spark.createDataFrame([("f", 0, "bytes=0-9")], "filename string, request_no int, header string")
    got = crawl.fetch_documents(requests, lambda name, header: (206, "application/octet-stream", a)).first()
    assert got["url"] == "http://a/" and bytes(got["payload"]) == b"A"


def test_members_in_linear_time():
    """Many small members cost as many steps as there are members, not their square."""
    import time

    one = gzip.compress(b"x" * 50)
    took = []
    for n in (20_000, 80_000):
        began = time.process_time()
        assert sum(map(len, crawl.gunzip_members(one * n))) == 50 * n
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0]
    assert list(crawl.gunzip_members(one * 2 + one[:9])) == [b"x" * 50] * 2
    big = gzip.compress(bytes(range(256)) * 1000)
    assert list(crawl.gunzip_members(one + big, 100)) == [b"x" * 50, bytes(range(256)) * 1000]


def test_frames_are_bounded():
    rows = [("u", "f", None, None, b"x" * 10)] * 25
    assert [len(f) for f in crawl.frames(iter(rows), 100)] == [10, 10, 5]


def test_statuses_are_tried_again(spark):
    a = record("http://a/", b"A")
    answers = iter([(503, "", b""), (429, "", b""), (206, "application/octet-stream", a)])
    assert crawl.answered(lambda n, h: next(answers), "f", "h", 3, 0)[0] == 206
    with pytest.raises(OSError, match="503"):
        crawl.answered(lambda n, h: (503, "", b""), "f", "h", 2, 0)
    requests = spark.createDataFrame([("f", 0, "bytes=0-9")], "filename string, request_no int, header string")
    for status in (503, 404):
        with pytest.raises(Exception, match=str(status)):
            crawl.fetch_documents(requests, lambda n, h, s=status: (s, "", b""), 2, 0).collect()


def test_urls_fail_fast(spark, tmp_path):
    with gzip.open(tmp_path / "u.json.gz", "wt") as f:
        f.write('{"url": "a", "x": 1}\n{"url": "a"}\n')
    assert crawl.mined_urls(spark, str(tmp_path)).count() == 1
    with gzip.open(tmp_path / "v.json.gz", "wt") as f:
        f.write("{bad\n")
    with pytest.raises(Exception):  # noqa: B017
        crawl.mined_urls(spark, str(tmp_path)).collect()


def test_shard_paths_and_sinks(spark, tmp_path):
    dump, shard = batching.shard_of_path(F.col("p"))
    got = spark.createDataFrame([("x/FilterDocuments/2024-10/0007.parquet",)], "p string").select(dump, shard).first()
    assert tuple(got) == ("2024-10", "0007")
    rows = spark.createDataFrame([("2024-10", 1), ("2024-18", 2)], "dump string, id int")
    sinks.write_sharded(rows, str(tmp_path / "o"))
    sinks.write_sharded(rows.filter("id = 1").withColumn("id", F.lit(9)), str(tmp_path / "o"))
    assert {(r["dump"], r["id"]) for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {("2024-10", 9), ("2024-18", 2)}
    planned = batching.planned_shards(spark, 3, ("2024-10",))
    assert batching.missing_shards(planned, planned.filter("shard = '0001'")).count() == 2
