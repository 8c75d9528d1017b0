"""Ranged reads: pointers sorted by place, near ones joined into one read, several reads in flight, failures tried again."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .calls import backoff, in_flight, tried


class RangeReader(Protocol):
    """Reads ``length`` bytes at ``offset`` of a named object, fewer at its end; used by several threads, one is made per partition."""

    def read(self, name: str, offset: int, length: int) -> bytes: ...


class LocalReader:
    """Ranges of files below a folder that all executors see."""

    def __init__(self, root: str):
        self.root = root

    def read(self, name: str, offset: int, length: int) -> bytes:
        with open(f"{self.root}/{name}", "rb") as f:
            f.seek(offset)
            return f.read(length)


class StoreReader:
    """Ranges of objects named by address, in any store that Arrow's file systems know; a name without a scheme is a local path."""

    def read(self, name: str, offset: int, length: int) -> bytes:
        store, path = store_of(name)
        with store.open_input_file(path) as f:
            f.seek(offset)
            return f.read(length)

    def size(self, name: str) -> int:
        store, path = store_of(name)
        return store.get_file_info(path).size


def store_of(address: str):
    """The file system of an address, and the path there."""
    from pyarrow import fs

    if address.startswith("file:"):
        return fs.LocalFileSystem(), "/" + address.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(address) if "://" in address else (fs.LocalFileSystem(), address)


GAP, MOST, PART = 1 << 16, 1 << 24, 1 << 28  # bytes between joined ranges, of a joined read, and of a task


def joined(places: list[tuple], gap: int = GAP, most: int = MOST) -> list[tuple[int, int]]:
    """Consecutive places (name, offset, length) that one read covers, as ranges of their numbers; None stays alone."""
    out, begin, end = [], 0, 0
    for k, x in enumerate(places):
        if k and x and places[k - 1]:
            (name, first, _), (mine, offset, length) = places[begin], x
            if name == mine and first <= offset <= end + gap and max(end, offset + length) - first <= most:
                end = max(end, offset + length)
                continue
        if k:
            out.append((begin, k))
        begin, end = k, x[1] + x[2] if x else 0
    return [*out, (begin, len(places))] if places else []


def read_ranges(
    rows: DataFrame, place: tuple[str, str, str], into: tuple[str, str], reader: Callable[[], RangeReader],
    gap: int = GAP, most: int = MOST, attempts: int = 10, first_wait: float = 0.1, at_once: int = 8, part: int = PART,
) -> DataFrame:
    """``rows`` with the bytes at ``place`` (name, offset, length) and an error ("" if none) in the two columns ``into``.

    Rows that already have bytes and no error keep them. Rows are dealt out by place, so that one much-read file spreads
    over tasks of about ``part`` bytes, and a task holds ``at_once`` reads of ``most`` bytes (or of one longer range). A joined
    read that fails is split into its rows, so a bad range fails alone, with empty bytes. Null or repeated places give each
    row its own result.
    """
    data, error = into
    for name, kind in ((data, "binary"), (error, "string")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    name, offset, length = place
    todo = F.when(F.col(data).isNull() | (F.coalesce(F.col(error), F.lit("")) != ""), F.greatest(F.col(length), F.lit(0)))
    tasks = 1 + (rows.agg(F.sum(todo)).first()[0] or 0) // part
    tasks = max(tasks, min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), tasks * 8))
    dealt = rows.repartitionByRange(int(tasks), name, offset).sortWithinPartitions(name, offset)
    schema, waits = to_arrow_schema(rows.schema), backoff(attempts, first_wait)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = reader()

        def one(x: tuple) -> tuple[bytes, str]:
            try:
                return tried(lambda: source.read(*x), waits), ""
            except Exception as e:
                return b"", repr(e)

        def fetch(group: tuple) -> list[tuple[bytes, str]]:
            places = group[0]
            if len(places) > 1:
                low = places[0][1]
                high = max(o + n for _, o, n in places)
                try:
                    whole = tried(lambda: source.read(places[0][0], low, high - low), waits[:2])
                    if len(whole) == high - low:
                        return [(whole[o - low : o - low + n], "") for _, o, n in places]
                except Exception:
                    pass  # each by itself
            return [one(x) for x in places]

        def groups() -> Iterator[tuple]:
            for batch in batches:
                held, said = batch.column(batch.schema.get_field_index(data)), batch.column(batch.schema.get_field_index(error)).to_pylist()
                columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in place]
                ready = [h and not e for h, e in zip(held.is_valid().to_pylist(), said, strict=True)]
                places = [None if done or None in x else (x[0], int(x[1]), int(x[2])) for done, x in zip(ready, zip(*columns, strict=True), strict=True)]
                for lo, hi in joined(places, gap, most):
                    yield [x for x in places[lo:hi] if x], batch.slice(lo, hi - lo), ready[lo]

        for (places, batch, ready), got in in_flight(fetch, groups(), at_once):
            if ready:
                new = {error: [""]}
            elif not places:
                new = {data: [b""], error: ["no place to read"]}
            else:
                new = {data: [x for x, _ in got], error: [e for _, e in got]}
            columns = [pa.array(new[f.name], f.type) if f.name in new else batch.column(k).cast(f.type) for k, f in enumerate(schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return dealt.mapInArrow(run, rows.schema)
