"""Image archives: tar files of pictures with facts beside them, read by ranges of their members, written in bounded shards.

Reading makes an index first: a task walks an archive's headers and skips what is between, so an archive is never held.
The facts name the addresses; which member an address takes is settled on these small rows, and only the pictures that
stay are then read, by ranges, over as many tasks as there are bytes.

Writing is a data source: each task streams its rows into shards of a bounded number of members in a temporary folder;
shards and the side files beside them get their names when all tasks are done, and none remains of a job that fails.
"""

from __future__ import annotations

import io
import json
import tarfile
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from .calls import backoff, in_flight, tried
from .ranges import StoreReader, read_ranges, store_of
from .shared import cut

AHEAD = 1 << 13  # bytes that are read with a header: mostly the facts and the next header, too


class HeaderFile(io.RawIOBase):
    """A seekable file of which only what is asked for, and a little ahead, is read."""

    def __init__(self, name: str, size: int):
        self.name_, self.size, self.at, self.low, self.held, self.source = name, size, 0, 0, b"", StoreReader()

    def seekable(self) -> bool:
        return True

    def readable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        self.at = offset + (0, self.at, self.size)[whence]
        return self.at

    def read(self, n: int = -1) -> bytes:
        n = self.size - self.at if n < 0 else min(n, max(0, self.size - self.at))
        if not self.low <= self.at <= self.at + n <= self.low + len(self.held):
            self.low, self.held = self.at, self.source.read(self.name_, self.at, max(n, AHEAD)) if n else b""
        out = self.held[self.at - self.low : self.at - self.low + n]
        self.at += len(out)
        return out


def members(spark: SparkSession, path: str) -> DataFrame:
    """(archive, name, offset, size) of all files in the archives of a path or pattern."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")  # the contents are not read here

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, size in zip(frame["path"], frame["length"], strict=True):
                rows = []
                with tarfile.open(fileobj=HeaderFile(archive, size), mode="r:") as tar:
                    for member in tar:
                        if member.isfile():
                            rows.append((archive, member.name, member.offset_data, member.size))
                        tar.members.clear()  # an archive of any number of members takes no more room
                        if len(rows) == 10_000:
                            yield pd.DataFrame(rows, columns=["archive", "name", "offset", "size"])
                            rows = []
                yield pd.DataFrame(rows, columns=["archive", "name", "offset", "size"])

    return files.repartition("path").mapInPandas(run, "archive string, name string, offset long, size long")


def images(spark: SparkSession, path: str, **reading) -> DataFrame:
    """(url, image) of archives of .jpg files with .json facts whose status is "success"; the last name of an address stays.

    The index, and the places of the pictures that stay, are made once, as small tables in the shared folder.
    """
    stem, kind = F.regexp_extract("name", r"^(.*)\.[^.]*$", 1), F.regexp_extract("name", r"\.([^.]*)$", 1)
    index = cut(members(spark, path).select("archive", stem.alias("stem"), kind.alias("kind"), "offset", "size"))
    facts = read_ranges(index.where("kind = 'json'"), ("archive", "offset", "size"), ("data", "error"), StoreReader, **reading)
    said = F.from_json(F.col("data").cast("string"), "url string, status string")
    named = facts.select("archive", "stem", said.alias("said")).where("said.status = 'success'").select("archive", "stem", F.col("said.url").alias("url"))
    pictures = named.join(index.where("kind = 'jpg'").select("archive", "stem", "offset", "size"), ["archive", "stem"])
    last = pictures.groupBy("url").agg(F.max_by(F.struct("archive", "offset", "size"), F.concat("archive", F.lit("/"), "stem")).alias("p"))
    read = read_ranges(cut(last.select("url", "p.*")), ("archive", "offset", "size"), ("image", "error"), StoreReader, **reading)
    return read.select("url", F.when(F.col("error") == "", F.col("image")).otherwise(F.raise_error(F.concat("archive", F.lit(": "), "error")).cast("binary")).alias("image"))


# --- Download ------------------------------------------------------------------------------------------------------


class Fetcher(Protocol):
    """Gets the bytes of an address, or raises; used by several threads, one is made per partition."""

    def get(self, url: str) -> bytes: ...


FETCHED = "url string, image binary, status string, error string"


def fetch(urls: DataFrame, fetcher: Callable[[], Fetcher], threads: int = 128, attempts: int = 1, resize: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """(url, image, status, error) of each different address in ``url``, with ``threads`` requests in flight in a task.

    ``resize`` turns what was fetched into what is stored. A failure is a row, too; status is "success" or what it failed in.
    """
    waits = backoff(attempts)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source = fetcher()

        def get(url: str) -> tuple:
            step = "failed_to_download"
            try:
                image = tried(lambda: source.get(url), waits)
                step = "failed_to_resize"
                return url, resize(image) if resize else image, "success", ""
            except Exception as e:
                return url, None, step, repr(e)

        rows, size = [], 0
        for _, row in in_flight(get, (u for frame in frames for u in frame["url"]), threads):
            rows.append(row)
            size += len(row[1] or b"")
            if len(rows) == 1000 or size > 1 << 24:
                yield pd.DataFrame(rows, columns=["url", "image", "status", "error"])
                rows, size = [], 0
        yield pd.DataFrame(rows, columns=["url", "image", "status", "error"])

    return urls.select("url").where("url is not null").distinct().mapInPandas(run, FETCHED)


@dataclass
class Shards(WriterCommitMessage):
    names: list[str]


class ShardWriter(DataSourceWriter):
    """Rows (url, image, status, error) to tar shards; a row without an image is listed in the side files only."""

    def __init__(self, address: str, per_shard: int, shard_bytes: int):
        self.address, self.per_shard, self.shard_bytes, self.job = address.rstrip("/"), per_shard, shard_bytes, uuid.uuid4().hex

    def temporary(self) -> str:
        return f"{store_of(self.address)[1]}/_temporary/{self.job}"

    def write(self, rows: Iterator[Row]) -> Shards:
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        store, _ = store_of(self.address)  # the job's folder is there already; once it is gone, a late task fails
        context, names, rows = TaskContext.get(), [], iter(rows)
        row = next(rows, None)
        while row is not None:
            name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{len(names):05d}"
            table, n, size = {c: [] for c in ("key", "url", "status", "error")}, 0, 0
            with store.open_output_stream(f"{self.temporary()}/{name}.tar") as out, tarfile.open(fileobj=out, mode="w|") as tar:
                while row is not None and n < self.per_shard and (not size or size + len(row.image or b"") <= self.shard_bytes):
                    key = f"{n:09d}"
                    for column, value in zip(table, (key, row.url, row.status, row.error), strict=True):
                        table[column].append(value)
                    if row.image is not None:
                        facts = json.dumps({"key": key, "url": row.url, "status": row.status, "error_message": row.error or None}).encode()
                        for kind, content in (("jpg", bytes(row.image)), ("json", facts)):
                            member = tarfile.TarInfo(f"{key}.{kind}")
                            member.size = len(content)
                            tar.addfile(member, io.BytesIO(content))
                            size += len(content)
                    n += 1
                    row = next(rows, None)
            with store.open_output_stream(f"{self.temporary()}/{name}.parquet") as out:
                pq.write_table(pa.table({c: pa.array(v, pa.string()) for c, v in table.items()}), out)
            with store.open_output_stream(f"{self.temporary()}/{name}_stats.json") as out:
                out.write(json.dumps({"count": n, "successes": sum(s == "success" for s in table["status"]), "bytes": size, "status": dict(sorted(Counter(table["status"]).items()))}).encode())
            names.append(name)
        return Shards(names)

    def commit(self, messages: list[Shards | None]) -> None:
        store, path = store_of(self.address)
        named = sorted(n for m in messages if m for n in m.names)
        for shard, name in enumerate(named):
            for kind in (".tar", ".parquet", "_stats.json"):
                store.move(f"{self.temporary()}/{name}{kind}", f"{path}/{shard:06d}{kind}")
        self.clear()
        with store.open_output_stream(f"{path}/_SUCCESS"):
            pass

    def abort(self, messages: list[Shards | None]) -> None:
        self.clear()

    def clear(self) -> None:
        """The job's folder goes; tasks that are being stopped may still write to it, so this is tried again."""
        from pyarrow import fs

        store, path = store_of(self.address)
        there = lambda p: store.get_file_info(p).type != fs.FileType.NotFound
        if there(self.temporary()):
            tried(lambda: store.delete_dir(self.temporary()), [0.2] * 50)
        if there(f"{path}/_temporary") and not store.get_file_info(fs.FileSelector(f"{path}/_temporary")):
            store.delete_dir(f"{path}/_temporary")


class ImageArchives(DataSource):
    """Writes rows (url, image, status, error) to ``path``; options per_shard (members) and shard_bytes."""

    @classmethod
    def name(cls) -> str:
        return "image_archives"

    def schema(self) -> str:
        return FETCHED

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        from pyarrow import fs

        address = self.options["path"]
        store, path = store_of(address)
        if store.get_file_info(f"{path}/_SUCCESS").type != fs.FileType.NotFound:
            raise ValueError(f"{address} already has shards")
        made = ShardWriter(address, int(self.options.get("per_shard", 10_000)), int(self.options.get("shard_bytes", 1 << 30)))
        store.create_dir(made.temporary(), recursive=True)
        return made


def write_archives(rows: DataFrame, path: str, per_shard: int = 10_000, shard_bytes: int = 1 << 30) -> None:
    """Shards of at most ``per_shard`` members and about ``shard_bytes`` bytes, with a table and counts beside each."""
    rows.sparkSession.dataSource.register(ImageArchives)
    rows.select("url", "image", "status", "error").write.format("image_archives").mode("append").option("path", path).option("per_shard", per_shard).option("shard_bytes", shard_bytes).save()


def download(urls: DataFrame, fetcher: Callable[[], Fetcher], path: str, threads: int = 128, attempts: int = 1, resize: Callable[[bytes], bytes] | None = None, per_shard: int = 10_000) -> None:
    """Fetch different addresses and write what was found as archives."""
    write_archives(fetch(urls, fetcher, threads, attempts, resize), path, per_shard)
