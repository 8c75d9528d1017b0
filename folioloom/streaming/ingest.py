"""Streaming ingest of pages: an extension that uses the batch functions on micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.html import ExtractOptions, web_documents


def pages_stream(spark: SparkSession, folder: str, schema: str = "page_id long, url string, html string") -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def first_per_url(stream: DataFrame, time: str = "fetched", delay: str = "1 hour") -> DataFrame:
    """The first row of each url within the watermark."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["url"])


def write_documents(stream: DataFrame, out: str, checkpoint: str, options: ExtractOptions | None = None) -> StreamingQuery:
    """Web documents of each micro-batch as Parquet, once each: a batch that is run again overwrites its folder."""

    def write(batch: DataFrame, number: int) -> None:
        web_documents(batch, options=options).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
