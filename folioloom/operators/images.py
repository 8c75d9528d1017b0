"""Image tables: joins of documents with stored images, header probes, batched classifiers."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..functions.urls import is_banned


def one_per_url(store: DataFrame, order: str) -> DataFrame:
    """The last row of each url by ``order``."""
    return store.groupBy("url").agg(F.max_by(F.struct("*"), order).alias("r")).select("r.*")


def attach(rows: DataFrame, store: DataFrame, url: str = "src", ban: bool = True) -> DataFrame:
    """Left join of image rows with a store that has one row per url; banned addresses get no image."""
    found = rows.join(store.withColumnRenamed("url", url), url, "left")
    if ban:
        others = [c for c in store.columns if c != "url"]
        found = found.withColumns({c: F.when(~is_banned(F.col(url)), F.col(c)) for c in others})
    return found


def header(data: bytes | None) -> tuple[str, int, int] | None:
    """(format, width, height) of JPEG, PNG, GIF or WebP bytes."""
    if not data:
        return None
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return "png", *struct.unpack(">II", data[16:24])
    if data[:4] in (b"GIF8",) and len(data) >= 10:
        return "gif", *struct.unpack("<HH", data[6:10])
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP" and len(data) >= 30:
        kind = data[12:16]
        if kind == b"VP8 ":
            w, h = struct.unpack("<HH", data[26:30])
            return "webp", w & 0x3FFF, h & 0x3FFF
        if kind == b"VP8L":
            bits = int.from_bytes(data[21:25], "little")
            return "webp", (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
        if kind == b"VP8X":
            return "webp", int.from_bytes(data[24:27], "little") + 1, int.from_bytes(data[27:30], "little") + 1
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            kind, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
            if 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                return "jpeg", w, h
            at += 2 + size
    return None


@F.pandas_udf(StructType([StructField("format", StringType()), StructField("width", IntegerType()), StructField("height", IntegerType())]))
def probe(images: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([header(x) or (None, None, None) for x in images], columns=["format", "width", "height"]).astype({"width": "Int32", "height": "Int32"})


def classify(images: DataFrame, score: Callable[[list[bytes]], list[dict[str, float]]], names: list[str]) -> DataFrame:
    """url and a score per name, from a model that takes a batch of image bytes; the model loads once per worker."""
    schema = "url string, " + ", ".join(f"{n} double" for n in names)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = score(list(frame["image"]))
            yield pd.DataFrame({"url": frame["url"]} | {n: [s.get(n, 0.0) for s in found] for n in names})

    return images.select("url", "image").mapInPandas(run, schema)


def offenders(scores: DataFrame, limits: dict[str, float]) -> DataFrame:
    """Rows with any score above its limit."""
    above: Column = F.lit(False)
    for name, limit in limits.items():
        above = above | (F.col(name) > limit)
    return scores.where(above)
