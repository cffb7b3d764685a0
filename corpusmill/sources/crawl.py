"""Crawl sources: URL lists, index lines, WARC records, byte-range plans and multi-part answers."""

from __future__ import annotations

import gzip
import io
import time
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CDX = "url string, filename string, offset string, length string"
RECORD = "url string, warc_file string, warc_date string, warc_block_digest string, payload binary"


def mined_urls(spark: SparkSession, path: str) -> DataFrame:
    """Distinct URLs of (gz) JSON lines; a malformed line fails the read."""
    return spark.read.schema("url string").option("mode", "FAILFAST").json(path).select("url").distinct()


def cdx_columns(line: Column) -> list[Column]:
    """Index line ``<key> <time> <json>``: the JSON starts after the second blank; numbers come as text there."""
    told = F.from_json(F.regexp_extract(line, r"^[^ ]* [^ ]* (.*)$", 1), CDX)
    return [told["url"].alias("url"), told["filename"].alias("filename"), told["offset"].cast("bigint").alias("offset"), told["length"].cast("bigint").alias("length")]


def read_cdx(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").text(path).select(*cdx_columns(F.col("value")))


def wanted(index: DataFrame, urls: DataFrame) -> DataFrame:
    """Index rows of the given URLs, repeated captures included. AQE sends the smaller side if it is small enough."""
    return index.join(urls.select("url"), "url", "left_semi")


def warc_index(index: DataFrame) -> DataFrame:
    """(filename, ranges) with each file's distinct (offset, length), sorted."""
    ranges = F.array_sort(F.collect_set(F.struct("offset", "length")))
    return index.groupBy("filename").agg(ranges.alias("ranges"))


def byte_range_requests(index: DataFrame, per_request: int = 100) -> DataFrame:
    """(filename, request_no, header): a file's ranges in batches, as multi-range headers with inclusive ends."""
    starts = F.sequence(F.lit(0), F.size("ranges") - 1, F.lit(per_request))
    each = index.filter(F.size("ranges") > 0).select("filename", "ranges", F.posexplode(starts).alias("request_no", "at"))
    part = F.transform(F.slice("ranges", F.col("at") + 1, F.lit(per_request)), lambda r: F.concat(r["offset"].cast("string"), F.lit("-"), (r["offset"] + r["length"] - 1).cast("string")))
    return each.select("filename", "request_no", F.concat(F.lit("bytes="), F.array_join(part, ", ")).alias("header"))


def listed(spark: SparkSession, path: str, suffix: str = ".json.gz") -> DataFrame:
    """(path, length) of the objects below ``path`` that end in ``suffix``; their contents are not read.

    A folder that does not exist holds none; files of no bytes are not listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
    try:
        return files.load(path).select("path", "length")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, length long")


def damaged(spark: SparkSession, path: str, suffix: str = ".gz") -> DataFrame:
    """(path) of the gzip files below ``path`` that end early or fail their checksum; files of no bytes are not read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"path": [p for p, raw in zip(batch["path"], batch["content"], strict=True) if not gzip_whole(bytes(raw))]}, dtype=object)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}")
    return files.load(path).select("path", "content").mapInPandas(run, "path string")


def gzip_whole(raw: bytes, step: int = 1 << 20) -> bool:
    try:
        with gzip.GzipFile(fileobj=io.BytesIO(raw)) as f:
            while f.read(step):
                pass
    except (OSError, EOFError, zlib.error):
        return False
    return bool(raw)


# ---- records ---------------------------------------------------------------------------------------------------


def gunzip_members(raw: bytes, step: int = 1 << 14) -> Iterator[bytes]:
    """The members of a gzip stream one by one, each in time linear in its size; a damaged end is left out."""
    view, at = memoryview(raw), 0
    while at < len(view):
        d, parts = zlib.decompressobj(31), []
        while not d.eof and at < len(view):
            piece = view[at : at + step]
            try:
                parts.append(d.decompress(piece))
            except zlib.error:
                return
            at += len(piece)
        if not d.eof:
            return
        at -= len(d.unused_data)
        yield b"".join(parts)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of an uncompressed WARC stream."""
    f = io.BytesIO(data)
    while line := f.readline():
        if not line.startswith(b"WARC/"):
            continue
        headers: dict[str, str] = {}
        while (line := f.readline()) and line.strip():
            k, _, v = line.decode("utf-8", "replace").partition(":")
            headers[k.strip().lower()] = v.strip()
        yield headers, f.read(int(headers.get("content-length", 0)))


def http_payload(block: bytes) -> bytes:
    """A response's body, unchunked and unzipped where its headers say so."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return block
    told = head.lower()
    if b"transfer-encoding: chunked" in told:
        out, rest = [], body
        while rest:
            size, _, rest = rest.partition(b"\r\n")
            try:
                n = int(size.split(b";")[0], 16)
            except ValueError:
                break
            if not n:
                break
            out.append(rest[:n])
            rest = rest[n + 2 :]
        body = b"".join(out)
    if b"content-encoding: gzip" in told:
        body = b"".join(gunzip_members(body)) or body
    return body


def warc_rows(path: str, raw: bytes) -> Iterator[tuple]:
    """Response records of a file's bytes. A zipped file is inflated member by member (a member holds whole records)."""
    for data in gunzip_members(raw) if raw[:2] == b"\x1f\x8b" else (raw,):
        for h, block in parse_warc(data):
            if h.get("warc-type", "response") == "response" and "warc-target-uri" in h:
                yield h["warc-target-uri"], path, h.get("warc-date"), h.get("warc-block-digest"), http_payload(block)


NAMES = ["url", "warc_file", "warc_date", "warc_block_digest", "payload"]


def frames(rows: Iterator[tuple], limit: int = 16 << 20) -> Iterator[pd.DataFrame]:
    """The rows in frames of about ``limit`` bytes of payload."""
    pool, size = [], 0
    for row in rows:
        pool.append(row)
        size += len(row[-1])
        if size >= limit:
            yield pd.DataFrame(pool, columns=NAMES)
            pool, size = [], 0
    if pool:
        yield pd.DataFrame(pool, columns=NAMES)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response records of all WARC files below a path, keyed by a digest of what identifies a capture.

    A task holds one file as stored, and inflates and hands on its records a bounded number of bytes at a time.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for p, raw in zip(batch["path"], batch["content"], strict=True):
                yield from frames(warc_rows(p, bytes(raw)))

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.warc*").load(path)
    return with_id(files.select("path", "content").mapInPandas(run, RECORD))


def with_id(records: DataFrame) -> DataFrame:
    """A reproducible id in place of a random one, which a retried task would draw anew."""
    key = F.concat_ws("|", "warc_file", "url", "warc_date", "warc_block_digest")
    return records.select(F.sha2(key, 256).alias("id"), "*")


# ---- answers to range requests ---------------------------------------------------------------------------------


def parse_range_answer(status: int, content_type: str, body: bytes) -> list[bytes]:
    """Unzipped parts of a partial answer; other answers, and parts that are no gzip, give nothing."""
    if status != 206:
        return []
    kind, _, rest = content_type.partition(";")
    if kind.strip().lower() == "multipart/byteranges":
        mark = rest.partition("boundary=")[2].split(";")[0].strip().strip('"')
        pieces = []
        for part in body.split(b"--" + mark.encode()):
            head, found, data = part.partition(b"\r\n\r\n")
            if found and b"content-range" in head.lower():
                pieces.append(data[:-2] if data.endswith(b"\r\n") else data)
    elif kind.strip().lower() == "application/octet-stream":
        pieces = [body]
    else:
        return []
    out = []
    for p in pieces:
        try:
            out.append(gzip.decompress(p))
        except (OSError, EOFError, zlib.error):
            continue
    return out


Fetch = Callable[[str, str], tuple[int, str, bytes]]
#: Answers that are worth another try.
RETRY_STATUS = (500, 503, 403, 429)


def answered(fetch: Fetch, name: str, header: str, attempts: int, pause: float) -> tuple[int, str, bytes]:
    """The answer to one request: tried again, after twice the pause each time, when it raises or its status says so."""
    for n in range(attempts):
        try:
            answer = fetch(name, header)
            if answer[0] not in RETRY_STATUS:
                return answer
            why: Exception = OSError(f"status {answer[0]} for {header} of {name}")
        except OSError as e:
            why = e
        if n + 1 < attempts:
            time.sleep(min(pause * 2**n, 60))
    raise why


def fetch_documents(requests: DataFrame, fetch: Fetch, attempts: int = 10, pause: float = 1.0) -> DataFrame:
    """Records behind (filename, request_no, header) rows, through an injected ``fetch(filename, header)``.

    A request that never succeeds, and an answer other than 206, fail the task, and Spark's retry takes over: nothing is
    lost without notice.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, header in zip(batch["filename"], batch["header"], strict=True):
                answer = answered(fetch, name, header, attempts, pause)
                if answer[0] != 206:
                    raise OSError(f"status {answer[0]} for {header} of {name}")
                yield from frames(r for part in parse_range_answer(*answer) for r in warc_rows(name, part))

    return with_id(requests.select("filename", "header").mapInPandas(run, RECORD))
