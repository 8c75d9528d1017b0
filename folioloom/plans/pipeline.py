"""The steps from pointers to final documents, each one lazy plan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import clean, dedup, filters, stats
from ..operators.documents import NODE, image_sources, is_media
from ..sources import crawl
from .html import ExtractOptions, web_documents


def download(pointers: DataFrame, reader: Callable[[], crawl.RangeReader]) -> DataFrame:
    return crawl.download_warc(pointers, reader)


def extract(rows: DataFrame, options: ExtractOptions | None = None) -> DataFrame:
    """WARC rows to web documents."""
    return web_documents(crawl.extract_html(rows), options=options)


def filter_documents(
    docs: DataFrame, nodes: filters.TextLimits, whole: filters.TextLimits, language: Callable[[Column], Column] | None = None, perplexity: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Node filter, image count, then all document checks on the joined text; ``language`` says if a text is of the wanted one."""
    out = filters.filter_nodes(docs, nodes, filters.image_ok)
    text = F.array_join(F.filter(F.transform("nodes", lambda n: n["text"]), lambda t: t.isNotNull() & (t != "")), "\n\n")
    out = out.where(filters.image_count_ok(F.size(image_sources(F.col("nodes"))))).where(filters.text_reason(text, whole).isNull())
    return out.where(filters.scored_reason(text, whole, language, perplexity).isNull())


def remove_image_nodes(docs: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """Documents without the image nodes whose source is listed (src); any ``key``, null or repeated, keeps its rows.

    Only sources are regrouped, by what the nodes hold; the nodes are filtered where they stand.
    """
    marked = docs.withColumn("_same", F.md5(F.to_json("nodes")))
    rows = marked.select("_same", F.explode(F.array_distinct(image_sources(F.col("nodes")))).alias("src")).distinct()
    gone = dedup.keep_listed(rows, "src", listed).groupBy("_same").agg(F.collect_set("src").alias("_gone"))
    left = F.filter("nodes", lambda n: F.coalesce(~F.array_contains("_gone", n["meta"]["src"]), F.lit(True)))
    return marked.join(gone, "_same", "left").withColumn("nodes", left).drop("_same", "_gone")


def with_probed_sizes(docs: DataFrame, facts: DataFrame) -> DataFrame:
    """Image nodes with the ``format``, width and height that ``facts`` (src, format, width, height) has of their source.

    A source that is not known keeps what its nodes say. Only sources are regrouped, into one map for all documents with
    the same sources, and the nodes are changed where they stand; of several facts of a source the greatest counts. Sources
    alone are written out to tell documents apart, and are met by their facts as they stand: what is equal is one in a task.
    """
    sources = F.array_sort(F.array_distinct(image_sources(F.col("nodes"))))
    marked = docs.withColumn("_same", F.unhex(F.md5(F.to_json(sources))))
    one = facts.where("src is not null").groupBy("src").agg(F.max(F.struct("format", "width", "height")).alias("fact"))
    rows = marked.select("_same", F.explode(sources).alias("src"))
    known = rows.join(one, "src").groupBy("_same").agg(F.map_from_entries(F.collect_set(F.struct("src", "fact"))).alias("_facts"))

    def sized(n: Column) -> Column:
        fact, meta = F.try_element_at(F.col("_facts"), n["meta"]["src"]), n["meta"]
        changed = meta.withField("format", fact["format"]).withField("original_width", fact["width"].cast("int")).withField("original_height", fact["height"].cast("int"))
        return F.struct(n["text"].alias("text"), F.when(fact.isNotNull() & ~is_media(meta), changed).otherwise(meta).alias("meta"))

    out = marked.join(known, "_same", "left")
    return out.withColumn("nodes", F.when(F.col("_facts").isNull(), F.col("nodes")).otherwise(F.transform("nodes", sized))).drop("_same", "_facts")


def remove_frequent_images(docs: DataFrame, key: str, threshold: int = 10) -> DataFrame:
    rows = docs.select(F.explode(image_sources(F.col("nodes"))).alias("src"))
    return remove_image_nodes(docs, key, dedup.too_frequent(rows, "src", threshold))


def line_dedup(docs: DataFrame, key: str, url: str = "url", drop_emptied: bool = False, **how) -> DataFrame:
    """Paragraphs repeated within a site go from all text nodes; a node that this empties stays as an empty text or goes, too.

    Any ``key``, null or repeated, keeps its rows: what goes depends on the site and the nodes alone, so only places are
    regrouped, and the nodes are cut where they stand.
    """
    marked = docs.withColumns({"_domain": U.netloc(F.col(url)), "_same": F.md5(F.to_json("nodes"))})
    of_node = lambda rows: rows.select("_domain", "_same", F.posexplode("nodes").alias("_node", "node")).where("node.text is not null")
    of_text = lambda rows: of_node(rows).select("_domain", "_same", "_node", F.posexplode(F.split("node.text", "\n\n")).alias("_pos", "paragraph"))
    repeated = dedup.duplicated_paragraphs(of_text(marked), "_domain", "paragraph", **how)
    once = of_text(marked.dropDuplicates(["_domain", "_same"]))
    gone = once.join(repeated, ["_domain", "paragraph"]).groupBy("_domain", "_same").agg(F.collect_set(F.struct("_node", "_pos")).alias("_gone"))

    def cut(n: Column, k: Column) -> Column:
        left = F.filter(F.split(n["text"], "\n\n"), lambda _, j: ~F.array_contains("_gone", F.struct(k.alias("_node"), j.alias("_pos"))))
        return F.struct(F.when(n["text"].isNotNull(), F.array_join(left, "\n\n")).alias("text"), n["meta"].alias("meta"))

    nodes = F.transform("nodes", cut)
    if drop_emptied:
        nodes = F.filter(nodes, lambda n: n["text"].isNull() | (n["text"] != "") | n["meta"].isNotNull())
    out = marked.join(gone, ["_domain", "_same"], "left")
    return out.withColumn("nodes", F.when(F.col("_gone").isNull(), F.col("nodes")).otherwise(nodes)).drop("_domain", "_same", "_gone")


def finish(docs: DataFrame) -> DataFrame:
    return clean.final_documents(docs, NODE)


def report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row and image counts before and after a step."""
    each = lambda d, name: d.agg(F.lit(name).alias("step"), F.count("*").alias("n_docs"), F.sum(F.size(image_sources(F.col("nodes")))).alias("n_images"))
    return each(before, "before").unionByName(each(after, "after"))


success_rate = stats.success_rate
