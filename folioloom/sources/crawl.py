"""Crawl records: ranged reads of WARC files, HTML of records, image archives."""

from __future__ import annotations

import gzip
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import archives
from .charsets import detect
from .ranges import LocalReader, RangeReader, read_ranges

__all__ = ["LocalReader", "RangeReader", "download_warc", "extract_html", "html_of", "http_response", "images_from_tars", "write_image_urls", "write_shards"]


def download_warc(pointers: DataFrame, reader: Callable[[], RangeReader], **reading) -> DataFrame:
    """Adds warc and warc_error to rows with warc_filename, warc_record_offset and warc_record_length.

    Rows that already have a record without an error are left as they are, so a failed run can be taken up again. Near
    records are read together, and failed reads are tried again (see ``ranges.read_ranges``).
    """
    return read_ranges(pointers, ("warc_filename", "warc_record_offset", "warc_record_length"), ("warc", "warc_error"), reader, **reading)


def http_response(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes] | None:
    """(record headers, HTTP headers, body) of the first response record, plain or gzipped."""
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            return None
        fields = _headers(data[at:end])
        size = int(fields.get("content-length", "0"))
        block = data[end + 4 : end + 4 + size]
        if fields.get("warc-type") == "response":
            head, _, body = block.partition(b"\r\n\r\n")
            http = _headers(head)
            if "chunked" in http.get("transfer-encoding", "").lower():
                body = _unchunk(body)
            if http.get("content-encoding", "").lower() == "gzip":
                body = gzip.decompress(body)
            return fields, http, body
        at = end + 4 + size
        while data[at : at + 2] == b"\r\n":
            at += 2
    return None


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if v}


def _unchunk(body: bytes) -> bytes:
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        size = int(body[at:end].split(b";")[0] or b"0", 16)
        if not size:
            break
        out.append(body[end + 2 : end + 2 + size])
        at = end + 4 + size
    return b"".join(out)


def html_of(data: bytes | None) -> tuple[str, str]:
    """(html, error) of a WARC record: the first response, decoded by the record's, the server's or the page's charset, or the likeliest."""
    try:
        found = http_response(data or b"")
        if not found or not found[2]:
            return "", "Not page or encoding"
        fields, http, body = found
        named = [fields.get("warc-identified-content-charset")]
        named += re.findall(r"charset=[\"']?([\w-]+)", http.get("content-type", "") + " " + body[:2048].decode("latin-1"), re.I)
        for charset in [*filter(None, named), detect(body)]:
            try:
                return body.decode(charset), ""
            except (LookupError, UnicodeDecodeError):
                continue
        return body.decode("latin-1"), ""
    except Exception as e:
        return "", str(e)


@F.pandas_udf(StructType([StructField("html", StringType()), StructField("html_error", StringType())]))
def _html(warcs: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([html_of(w) for w in warcs], columns=["html", "html_error"])


def extract_html(rows: DataFrame) -> DataFrame:
    """Adds html and html_error; keeps pages already extracted, and passes on failed downloads as "no WARC"."""
    for name in ("html", "html_error"):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(""))
    done = (F.col("html") != "") & (F.col("html_error") == "")
    lost = F.col("warc_error") != ""
    new = _html(F.when(~done & ~lost, F.col("warc")))
    rows = rows.withColumn("_new", new)
    html = F.when(done, F.col("html")).when(lost, "").otherwise(F.col("_new.html"))
    error = F.when(done, "").when(lost, "no WARC").otherwise(F.col("_new.html_error"))
    return rows.withColumns({"html": html, "html_error": error}).drop("_new")


def images_from_tars(spark: SparkSession, path: str) -> DataFrame:
    """(url, image) of archives of .jpg files with .json sidecars whose status is "success"; the last name of a url stays."""
    return archives.images(spark, path)


def write_image_urls(docs: DataFrame, path: str) -> None:
    """Distinct image addresses as text, one a line."""
    from ..operators.documents import image_sources

    docs.select(F.explode(image_sources(F.col("nodes"))).alias("value")).distinct().write.text(path)


def write_shards(rows: DataFrame, path: str) -> None:
    """Rows with split and shard as a partitioned Parquet table."""
    rows.write.partitionBy("split", "shard").parquet(path)
