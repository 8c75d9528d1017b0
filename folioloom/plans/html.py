"""Pages to web documents: a small Arrow UDF parses, all else is columns: string passes, the tree's steps (``dom``), addresses."""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, MapType, StringType, StructField, StructType

from ..functions import text as T
from ..functions import urls as U
from ..functions.constants import EOD, IMAGE_SOURCES, MEDIA_TAGS, UNWRAP_TAGS
from ..operators.documents import META, NODE
from . import dom
from .dom import BREAK

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCKS = {"address", "article", "aside", "blockquote", "center", "dl", "div", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul"}


@dataclass
class ExtractOptions:
    """Every step can be turned off; class rules are ``class`` tokens."""

    strip_linebreaks: bool = True
    strip_spaces: bool = True
    remove_comments: bool = True
    replace_breaks: bool = True
    remove_classes: tuple[str, ...] = ("footer", "site-info")
    replace_classes: dict[str, str] = field(default_factory=lambda: {"more-link": f"\n\n{EOD}\n\n"})
    unwrap: bool = True
    strip_tags: bool = True
    strip_special_divs: bool = True
    remove_dates: bool = True
    remove_empty: bool = True
    unnest: bool = True
    only_text_and_images: bool = True
    format_texts: bool = True
    merge_texts: bool = True


class Element:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []

    def elements(self) -> list[Element]:
        return [c for c in self.children if isinstance(c, Element)]


class Builder(HTMLParser):
    """Elements as browsers nest them in the common cases: void tags, implied ends, stray end tags."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("html")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        found = {k: v or "" for k, v in attrs}
        if tag == "html":
            self.root.attrs |= found
            return
        ends = CLOSES.get(tag, {"p"} if tag in BLOCKS else set())
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in ends:
                del self.open[k:]
                break
            if self.open[k].tag not in UNWRAP_TAGS and self.open[k].tag not in ends:
                break
        new = Element(tag, found)
        self.open[-1].children.append(new)
        if tag not in VOID:
            self.open.append(new)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag and tag != "html":
            self.open.pop()

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Element:
    b = Builder()
    b.feed(html)
    b.close()
    return b.root


# As ``dom.FLAT``; written out, as workers without a session read this module, too.
FLAT_TYPE = ArrayType(StructType([
    StructField("end", IntegerType()), StructField("up", ArrayType(IntegerType())), StructField("tag", StringType()),
    StructField("attrs", MapType(StringType(), StringType())), StructField("text", StringType()),
]))
# Attributes that some step reads, of any tag and of media.
READ, READ_OF_MEDIA = {"class", "id", "title"}, {"alt", "width", "height", *IMAGE_SOURCES}


def flat(html: str) -> list[dict]:
    """All nodes of a page in reading order: where the subtree ends, the ancestors' numbers, tag, attributes, text; any depth."""
    out: list[dict] = []
    stack: list = [(parse(html), [])]
    while stack:
        node, up = stack.pop()
        if isinstance(node, int):  # all in this element have been listed
            out[node]["end"] = len(out)
        elif isinstance(node, str):
            out.append({"end": len(out) + 1, "up": up, "tag": dom.TEXT, "attrs": None, "text": node})
        else:
            read = READ | READ_OF_MEDIA if node.tag in MEDIA_TAGS or node.tag == "source" else READ
            out.append({"end": 0, "up": up, "tag": node.tag, "attrs": {k: v for k, v in node.attrs.items() if k in read}, "text": None})
            inside = [*up, len(out) - 1]
            stack.append((len(out) - 1, up))
            stack += [(c, inside) for c in reversed(node.children)]
    return out


def prepared(html: Column, o: ExtractOptions) -> Column:
    for wanted, pattern, by in (
        (o.strip_linebreaks, "\n{2,}", "\n"), (o.strip_spaces, " {2,}", " "), (o.remove_comments, "(?s)<!--.*?-->", ""), (o.replace_breaks, "<br>|<br/>|<br />|</br>", BREAK),
    ):
        html = F.regexp_replace(html, pattern, by) if wanted else html
    return html


def image_meta(attrs: Column, page_url: Column) -> Column:
    """Metadata of an image, video or audio from attributes; null when the address is not valid. A video's sizes stay as they are given."""
    raw = attrs["_source"]
    src = F.when(raw.startswith("http"), raw).otherwise(U.absolute(page_url, raw))
    name = F.nullif(U.readable_name(src), F.lit(""))
    none = F.lit(None)
    meta = F.struct(
        page_url.alias("document_url"), raw.alias("unformatted_src"), src.alias("src"), name.alias("formatted_filename"), F.nullif(attrs["alt"], F.lit("")).alias("alt_text"),
        U.size_text(attrs["width"]).alias("rendered_width"), U.size_text(attrs["height"]).alias("rendered_height"),
        none.alias("original_width"), none.alias("original_height"), none.alias("format"), none.alias("media"),
    )
    video = attrs["_media"] == "video"  # an audio has an address alone
    other = F.struct(
        page_url.alias("document_url"), raw.alias("unformatted_src"), src.alias("src"), none.alias("formatted_filename"), none.alias("alt_text"),
        F.when(video, attrs["width"]).alias("rendered_width"), F.when(video, attrs["height"]).alias("rendered_height"),
        none.alias("original_width"), none.alias("original_height"), none.alias("format"), attrs["_media"].alias("media"),
    )
    meta = F.when(attrs["_media"].isNotNull(), other.cast(META)).otherwise(meta.cast(META))
    return F.when(U.is_valid(src), meta)


PARSED = StructType([StructField("error", StringType()), StructField("nodes", FLAT_TYPE)])
SLICE = 16  # pages that are Python objects at once


@F.arrow_udf(PARSED)
def parsed(texts: pa.Array) -> pa.Array:
    """(error, nodes): a page that breaks the parser must not break the job. The nodes of a few pages at once are Python objects."""
    kind, parts = to_arrow_type(PARSED), []
    for lo in range(0, len(texts), SLICE):
        rows = []
        for t in texts.slice(lo, SLICE).to_pylist():
            try:
                rows.append({"error": "", "nodes": flat(t or "")})
            except Exception as e:
                rows.append({"error": repr(e), "nodes": None})
        parts.append(pa.array(rows, kind))
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def web_documents(pages: DataFrame, html: str = "html", url: str = "url", options: ExtractOptions | None = None) -> DataFrame:
    """``pages`` without ``html``, with ``nodes`` and ``extract_error`` ("" if none; a failed page has no nodes)."""
    o = options or ExtractOptions()
    kept = [F.col(f"`{c}`") for c in pages.columns if c != html]
    found = pages.select(*kept, F.col(url).alias("_url"), parsed(prepared(F.col(html), o)).alias("_found"))
    # Made once: what follows reads it many times.
    found = found.withColumn("_nodes", T.let(F.col("_found.nodes"), lambda n: dom.extracted(n, o)))
    nodes = F.transform("_nodes", lambda n: F.struct(n["text"].alias("text"), F.when(n["attrs"].isNotNull(), image_meta(n["attrs"], F.col("_url"))).alias("meta")).cast(NODE))
    nodes = F.filter(nodes, lambda n: n["text"].isNotNull() | n["meta"].isNotNull())
    return found.select(*kept, F.coalesce(nodes, F.array().cast(f"array<{NODE}>")).alias("nodes"), F.col("_found.error").alias("extract_error"))


def dom_levels(pages: DataFrame, html: str = "html", options: ExtractOptions | None = None) -> DataFrame:
    """A row per node of the simplified tree: page columns, pos, tag, level, text."""
    o = options or ExtractOptions()
    kept = [F.col(f"`{c}`") for c in pages.columns if c != html]
    left = T.let(F.col("_found.nodes"), lambda n: dom.simplified(n, o))
    told = F.transform(left, lambda x: F.struct(x["tag"].alias("tag"), F.size(x["path"]).alias("level"), x["text"].alias("text")))
    rows = pages.select(*kept, parsed(prepared(F.col(html), o)).alias("_found"))
    return rows.select(*kept, F.posexplode(told).alias("pos", "n")).select(*kept, "pos", "n.*")
