"""Sinks of the stages: sharded Parquet, typed Parquet, JSON lines, index JSON, zipped WARC files."""

from __future__ import annotations

import gzip
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..operators.batching import shard_of_path


def write_sharded(df: DataFrame, path: str, by: tuple[str, ...] = ("dump",), mode: str = "overwrite") -> None:
    """gzip Parquet by partition columns; in a re-run only the partitions that it holds are replaced."""
    (
        df.write.mode(mode).option("compression", "gzip").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).parquet(path)
    )


def write_by_source_shard(df: DataFrame, path: str, shard: str = "shard", order: str | None = None) -> None:
    """Rows back in the layout they came from: one folder per dump and shard named in ``shard``'s path, one file each.

    A path that names no shard fails the write, for its rows would have no place.
    """
    dump, name = shard_of_path(F.col(shard))
    known = F.when(name != "", name).otherwise(F.raise_error(F.concat(F.lit("no shard in "), F.coalesce(F.col(shard), F.lit("null")))))
    placed = df.withColumns({"dump": dump, "__shard": known}).drop(shard).withColumnRenamed("__shard", "shard")
    placed = placed.repartition("dump", "shard").sortWithinPartitions("dump", "shard", *([order] if order else []))
    write_sharded(placed, path, ("dump", "shard"))


def write_text(df: DataFrame, path: str) -> None:
    """The text stage's fixed schema."""
    df.select(F.col("id").cast("string"), F.col("text").cast("string")).write.mode("overwrite").parquet(path)


def write_index(index: DataFrame, path: str) -> None:
    index.write.mode("overwrite").option("compression", "gzip").json(path)


def write_predictions(rows: DataFrame, path: str, order: str | Column | None = None) -> None:
    """JSON lines; files and rows follow ``order``, if given, by a range exchange."""
    (rows.orderBy(order) if order is not None else rows).write.mode("overwrite").json(path)


# ---- zipped WARC files -----------------------------------------------------------------------------------------


def warc_record(url: str, date: str | None, digest: str | None, payload: bytes) -> bytes:
    """A response record as one gzip member, the same bytes for the same record."""
    block = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    head = [("WARC-Type", "response"), ("WARC-Target-URI", url), ("WARC-Date", date), ("WARC-Block-Digest", digest), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return gzip.compress(f"WARC/1.0\r\n{lines}\r\n".encode() + block + b"\r\n\r\n", mtime=0)


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    records: int


class WarcWriter(DataSourceWriter):
    """Each task writes a hidden file; the driver gives those of successful tasks their names. Empty ones are not kept."""

    def __init__(self, path: str, run: str) -> None:
        self.path, self.run = path, run

    def _store(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.path or self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def write(self, iterator: Iterator[Row]) -> Written:
        first = next(iterator, None)
        if first is None:
            return Written(None, 0)
        store, top = self._store()
        store.create_dir(top, recursive=True)
        name, n = f"{self.run}-{uuid.uuid4().hex}.warc.gz", 0
        with store.open_output_stream(f"{top}/.tmp-{name}", compression=None) as out:
            row = first
            while row is not None:
                out.write(warc_record(row["url"], row["warc_date"], row["warc_block_digest"], bytes(row["payload"])))
                n, row = n + 1, next(iterator, None)
        return Written(name, n)

    def commit(self, messages: list[Written | None]) -> None:
        store, top = self._store()
        for m in messages:
            if m is not None and m.name:
                store.move(f"{top}/.tmp-{m.name}", f"{top}/{m.name}")
        self.abort([])

    def abort(self, messages: list[Written | None]) -> None:
        """Removes what failed or doubled attempts of this run left behind."""
        store, top = self._store()
        for f in store.get_file_info(fs.FileSelector(top, allow_not_found=True)):
            if f.base_name.startswith(f".tmp-{self.run}-"):
                store.delete_file(f.path)


class WarcSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc_gz"

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], uuid.uuid4().hex)


def write_warc(records: DataFrame, path: str) -> None:
    """(url, warc_date, warc_block_digest, payload) as zipped WARC files, one per partition that has rows; adds to ``path``.

    Rows without url or payload are no records and are left out.
    """
    records.sparkSession.dataSource.register(WarcSink)
    rows = records.select("url", "warc_date", "warc_block_digest", "payload").filter("url is not null and payload is not null")
    rows.write.format("warc_gz").mode("append").option("path", path).save()
