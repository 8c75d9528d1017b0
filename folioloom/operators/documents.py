"""The web document as a column: ``nodes``, an array in reading order.

A node has ``text`` or the metadata ``meta`` of an image, or of a video or audio, which ``media`` then names; an image that
was lost has neither. The wire form (parallel lists
``texts``, ``images`` and JSON ``metadata``) is converted at the edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

META = (
    "struct<document_url:string,unformatted_src:string,src:string,formatted_filename:string,alt_text:string,rendered_width:string,"
    "rendered_height:string,original_width:int,original_height:int,format:string,media:string>"
)
NODE = f"struct<text:string,meta:{META}>"
GENERAL = "struct<url:string,warc_filename:string,warc_record_offset:bigint,warc_record_length:bigint>"


def from_wire(df: DataFrame) -> DataFrame:
    """texts, images, metadata, general_metadata to nodes and general."""
    metas = F.from_json("metadata", f"array<{META}>")
    nodes = F.transform(F.col("texts"), lambda t, k: F.struct(t.alias("text"), F.get(metas, k).alias("meta")))
    general = F.from_json("general_metadata", GENERAL)
    return df.withColumn("nodes", nodes).withColumn("general", general).drop("texts", "images", "metadata", "general_metadata")


def to_wire(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "texts": F.transform("nodes", lambda n: n["text"]),
        "images": F.transform("nodes", lambda n: n["meta"]["src"]),
        "metadata": F.to_json(F.transform("nodes", lambda n: n["meta"])),
    })


def exploded(df: DataFrame, keys: list[str], nodes: str = "nodes") -> DataFrame:
    """A row per node: keys, pos, node."""
    return df.select(*keys, F.posexplode(nodes).alias("pos", "node"))


def regrouped(rows: DataFrame, keys: list[str], node: Column, name: str = "nodes") -> DataFrame:
    """The inverse of ``exploded``: nodes in the order of ``pos``."""
    pairs = F.array_sort(F.collect_list(F.struct("pos", node.alias("node"))))
    return rows.groupBy(*keys).agg(F.transform(pairs, lambda p: p["node"]).alias(name))


def is_media(meta: Column) -> Column:
    """Of a video or audio; never null."""
    return meta["media"].isNotNull()


def image_sources(nodes: Column) -> Column:
    return F.transform(F.filter(nodes, lambda n: n["meta"]["src"].isNotNull() & (n["meta"]["src"] != "") & ~is_media(n["meta"])), lambda n: n["meta"]["src"])


def texts_of(nodes: Column) -> Column:
    return F.filter(F.transform(nodes, lambda n: n["text"]), lambda t: t.isNotNull() & (t != ""))


def found_counts(nodes: Column) -> tuple[Column, Column]:
    """Images found and not found, by whether the node still has its source."""
    wanted = F.filter(nodes, lambda n: n["meta"].isNotNull() & ~is_media(n["meta"]))
    return F.size(F.filter(wanted, lambda n: n["meta"]["src"].isNotNull())), F.size(F.filter(wanted, lambda n: n["meta"]["src"].isNull()))
