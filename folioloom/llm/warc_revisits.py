"""WARC revisit resolution: an as-of join of not-modified records to the latest earlier full response.

Records are joined by canonical URL. The join is by time buckets, so that a URL with any number of records is spread:
within a bucket a window carries the last response forward; across buckets only the last response of each bucket is
carried, over one row per bucket. A revisit resolves when the validators agree: ETags if both have one, compared weakly, as
If-None-Match is (a ``W/`` before either doesn't count), else equal Last-Modified times, else equal payload digests. The
stored response's headers are then updated with those that a 304 may change: not those that describe the stored content,
nor those of one connection or proxy, the ones that a Connection header names among them.

Records at the same instant are ordered by type (responses first) and id. Defined results: a revisit without an
earlier response is "orphan", one whose validators differ or are all missing is "mismatch"; a null URL or time matches
nothing; null header maps count as empty; repeated rows are resolved each; an empty table gives an empty result; columns
but those named in ``resolve`` are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Headers that a 304 response must not change in a stored response (lower case).
FROZEN = [
    "content-encoding", "content-length", "content-md5", "content-range", "content-type", "connection", "keep-alive", "te", "trailer", "transfer-encoding", "upgrade",
    "proxy-authenticate", "proxy-authentication-info", "proxy-authorization", "proxy-connection",
]
TRACKING = r"^(utm_[a-z]+|fbclid|gclid|ref)="


def canonical(url: Column) -> Column:
    """Host in lower case without www. and default port; no scheme, fragment, tracking parameter or final slash; parameters sorted."""
    bare = F.regexp_replace(F.trim(url), "(?s)#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"(?s)\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def resolve(records: DataFrame, bucket_seconds: int = 6 * 3600) -> DataFrame:
    """For each revisit of ``records`` (record_id, url, ts, type, etag, last_modified, digest, headers) what it stands for.

    ``type`` is "response" or "revisit". Gives record_id, url_key, ts, status, response_id, response_ts, matched_by, headers.
    """
    kept = records.where(F.col("type").isin("response", "revisit")).select(
        "record_id", canonical(F.col("url")).alias("url_key"), "ts", "type", "etag", "last_modified", "digest", F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
        F.floor(F.unix_timestamp("ts") / bucket_seconds).alias("bucket"), F.when(F.col("type") == "response", 0).otherwise(1).alias("order"),
    )
    named = kept.where("url_key is not null and ts is not null")
    full = F.when(F.col("order") == 0, F.struct("ts", "record_id", "etag", "last_modified", "digest", "headers"))
    ends = named.where("order = 0").groupBy("url_key", "bucket").agg(F.max_by(F.struct("ts", "record_id", "etag", "last_modified", "digest", "headers"), F.struct("ts", "record_id")).alias("end"))
    spots = named.select("url_key", "bucket").distinct().join(ends, ["url_key", "bucket"], "left")
    before = Window.partitionBy("url_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = spots.select("url_key", "bucket", F.last("end", ignorenulls=True).over(before).alias("carried"))
    within = Window.partitionBy("url_key", "bucket").orderBy("ts", "order", "record_id").rowsBetween(Window.unboundedPreceding, 0)
    found = named.withColumn("inside", F.last(full, ignorenulls=True).over(within)).where("order = 1")
    found = found.join(carried, ["url_key", "bucket"], "left").withColumn("base", F.coalesce("inside", "carried")).drop("inside", "carried")
    lost = kept.where("order = 1 and (url_key is null or ts is null)").withColumn("base", F.lit(None).cast(found.schema["base"].dataType))
    found = found.unionByName(lost)
    opaque = lambda tag: F.regexp_replace(tag, "^W/", "")
    tags, times, sums = (opaque("etag"), opaque("base.etag")), (F.col("last_modified"), F.col("base.last_modified")), (F.col("digest"), F.col("base.digest"))
    by = F.when(tags[0].isNotNull() & tags[1].isNotNull(), F.when(tags[0] == tags[1], "etag"))
    by = F.when(tags[0].isNotNull() & tags[1].isNotNull(), by).when(times[0].isNotNull() & times[1].isNotNull(), F.when(times[0] == times[1], "last-modified")).when(sums[0] == sums[1], "digest")
    told = F.filter(F.map_entries("headers"), lambda e: F.lower(e["key"]) == "connection")
    named_there = F.transform(F.flatten(F.transform(told, lambda e: F.split(F.coalesce(e["value"], F.lit("")), ","))), lambda name: F.lower(F.trim(name)))
    free = F.map_filter("headers", lambda name, _: ~F.lower(name).isin(FROZEN) & ~F.array_contains(named_there, F.lower(name)))
    over = F.transform(F.map_keys(free), lambda name: F.lower(name))
    merged = F.map_concat(F.map_filter("base.headers", lambda name, _: ~F.array_contains(over, F.lower(name))), free)
    out = found.withColumn("matched_by", by)
    good = F.col("matched_by").isNotNull()
    return out.select(
        "record_id", "url_key", "ts", F.when(F.col("base").isNull(), "orphan").when(good, "resolved").otherwise("mismatch").alias("status"),
        F.when(good, F.col("base.record_id")).alias("response_id"), F.when(good, F.col("base.ts")).alias("response_ts"), "matched_by",
        F.when(good, merged).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Crawl records of ``pages`` (page_id, url, html), by a rule: each page is fetched once and revisited twice.

    Every seventh page changed before its second revisit, every eleventh has no ETag, every thirteenth neither validator.
    """
    day = F.timestamp_seconds(F.lit(1_600_000_000) + F.pmod("page_id", F.lit(1000)) * 86_400)
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    base = pages.select("page_id", "url", day.alias("day"), tag.alias("tag"), F.sha1(F.coalesce("html", F.lit(""))).alias("sum"), F.length("html").alias("size"))
    base = base.withColumn("visit", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    changed = (F.col("visit") == 2) & (F.pmod("page_id", F.lit(7)) == 0)
    headers = F.when(
        F.col("visit") == 0,
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("Content-Length"), F.col("size").cast("string"), F.lit("Cache-Control"), F.lit("max-age=60")),
    ).otherwise(F.create_map(F.lit("cache-control"), F.concat(F.lit("max-age="), F.col("visit") * 600), F.lit("Content-Length"), F.lit("0")))
    bare = F.pmod("page_id", F.lit(13)) == 0
    return base.select(
        (F.col("page_id") * 3 + F.col("visit")).alias("record_id"), "url", (F.col("day") + F.make_dt_interval(F.col("visit") * 3)).alias("ts"),
        F.when(F.col("visit") == 0, "response").otherwise("revisit").alias("type"),
        F.when(~bare & (F.pmod("page_id", F.lit(11)) != 0), F.when(changed, F.lit('"new"')).otherwise(F.col("tag"))).alias("etag"),
        F.when(~bare, F.when(changed, F.col("day") + F.make_dt_interval(F.lit(4))).otherwise(F.col("day"))).alias("last_modified"),
        F.when(changed, F.lit("changed")).otherwise(F.col("sum")).alias("digest"), headers.alias("headers"),
    )
