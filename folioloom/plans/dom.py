"""Pages as flat trees: simplification and extraction as array functions over one row per page, without a shuffle.

The parser alone is Python: it gives a page's nodes in reading order, each with its tag, the attributes that matter, where
its subtree ends, and the numbers of its ancestors. A node's fate depends on its own attributes, on its ancestors, or on
what its subtree holds, so each step is one pass of array functions that looks flags up by number. Work grows with the
nodes times their depth. Arrays are bound once (``let``), so no step is computed again inside another.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.constants import IMAGE_SOURCES, KEPT_TAGS, MEDIA_TAGS, NAVIGATION, SEPARATORS, UNWRAP_TAGS
from ..functions.text import let

TEXT = "-text"
BREAK = "#BR_TAG#"
FLAT = "array<struct<end:int,up:array<int>,tag:string,attrs:map<string,string>,text:string>>"
# White space of texts is that of Unicode, and the four separators of ASCII.
SPACE = r"[\s\x{1c}-\x{1f}]"
KEEP, DROP, REPLACE, UNWRAP = range(4)


def numbers(count: Column) -> Column:
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))


def filled(text: Column) -> Column:
    return F.coalesce(text.rlike(rf"(?U)[^\s\x{{1c}}-\x{{1f}}]"), F.lit(False))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+\z", "")


def tokens(attrs: Column) -> Column:
    return F.split(F.coalesce(attrs["class"], F.lit("")), r"(?U)\s+")


def plain_address(a: Column) -> Column:
    """An address without comma or space, or null."""
    return F.when((a != "") & ~a.rlike("[, ]"), a)


def fates(n: Column, o) -> Column:
    """What becomes of each node by itself: kept, dropped with all in it, replaced by a text, or unwrapped (what is in it stays)."""

    def one(x: Column, k: Column) -> Column:
        has = lambda names: F.exists(tokens(x["attrs"]), lambda c: c.isin(list(names)))
        out = F.when((k == 0) | (x["tag"] == TEXT), KEEP)
        if o.remove_classes:
            out = out.when(has(o.remove_classes), DROP)
        if o.replace_classes:
            out = out.when(has(o.replace_classes), REPLACE)
        if o.unwrap:
            out = out.when(x["tag"].isin(sorted(UNWRAP_TAGS)), UNWRAP)
        if o.strip_tags:
            out = out.when(~F.regexp_replace(x["tag"], r"\d+", "").isin(sorted(KEPT_TAGS)), DROP)
        if o.strip_special_divs:
            named = [F.coalesce(x["attrs"][a].isin(sorted(NAVIGATION)), F.lit(False)) for a in ("id", "class", "title")]
            out = out.when((x["tag"] == "div") & (named[0] | named[1] | named[2]), DROP)
        return out.otherwise(KEEP)

    return F.transform(n, one)


def texts(n: Column, own: Column, o) -> Column:
    """The text of each text node, those that replace an element included; null for elements."""

    def one(x: Column, k: Column) -> Column:
        put = F.lit(None).cast("string")
        for name, text in reversed(o.replace_classes.items()):
            put = F.when(F.array_contains(tokens(x["attrs"]), name), text).otherwise(put)
        return F.when(F.get(own, k) == REPLACE, put).when(x["tag"] == TEXT, x["text"])

    return F.transform(n, one)


def sources(n: Column, alive: Column) -> Column:
    """The address of each image, video or audio: of the known attributes, or of a source inside; null without one."""

    def one(x: Column, k: Column) -> Column:
        image = F.coalesce(*(plain_address(x["attrs"][a]) for a in IMAGE_SOURCES))
        inside = F.filter(F.sequence(k, x["end"] - 1), lambda c: (F.get(n, c)["tag"] == "source") & (F.get(n, c)["attrs"]["src"] != "") & F.get(alive, c))
        own = F.when(x["attrs"]["src"] != "", x["attrs"]["src"])
        other = plain_address(F.coalesce(own, F.get(n, F.get(inside, F.lit(0)))["attrs"]["src"]))
        return F.when(x["tag"] == "img", image).when(x["tag"].isin("video", "audio"), other)

    return F.transform(n, one)


def is_medium(x: Column) -> Column:
    return x["tag"].isin(sorted(MEDIA_TAGS))


def simplified(n: Column, o) -> Column:
    """The nodes that are left, in reading order, neighbouring texts joined: (path, tag, text, attrs, source); media are leaves."""

    def with_fates(own: Column) -> Column:
        gone = lambda x, k: (F.get(own, k) == DROP) | F.exists(x["up"], lambda a: F.get(own, a).isin(DROP, REPLACE))
        parents = F.transform(n, lambda x, k: F.element_at(F.concat(F.array(F.lit(-1)), F.filter(x["up"], lambda a: F.get(own, a) == KEEP)), -1))
        return let(parents, lambda par: let(texts(n, own, o), lambda said: let(F.transform(n, lambda x, k: ~gone(x, k)), lambda alive: undated(own, par, said, alive))))

    def undated(own: Column, par: Column, said: Column, alive: Column) -> Column:
        if not o.remove_dates:
            return let(sources(n, alive), lambda src: nonempty(own, par, said, alive, src))
        of_date = lambda k: F.coalesce((F.get(n, F.get(par, k))["tag"] == "div") & F.get(n, F.get(par, k))["attrs"]["class"].contains("date"), F.lit(False))
        left = F.transform(alive, lambda v, k: v & ~(F.get(said, k).isNotNull() & of_date(k)))
        return let(left, lambda v: let(sources(n, v), lambda src: nonempty(own, par, said, v, src)))

    def nonempty(own: Column, par: Column, said: Column, alive: Column, src: Column) -> Column:
        if not o.remove_empty:
            return unnested(own, par, said, alive, src)
        bad = F.transform(n, lambda x, k: (F.get(own, k) == KEEP) & is_medium(x) & F.get(src, k).isNull())

        def anchors(lost: Column) -> Column:
            """What keeps all that it is in: a text that is not blank, a medium with an address, a source."""
            inside = lambda x, k: ~F.get(lost, k) & ~F.exists(x["up"], lambda a: F.get(lost, a))
            holds = lambda x, k: F.when(F.get(said, k).isNotNull(), filled(F.get(said, k))).otherwise((F.get(own, k) == KEEP) & (is_medium(x) | (x["tag"] == "source")))
            return F.transform(n, lambda x, k: F.get(alive, k) & inside(x, k) & holds(x, k))

        def kept_elements(firm: Column) -> Column:
            return F.transform(n, lambda x, k: (k == 0) | F.get(firm, k) | F.get(said, k).isNull() & F.array_contains(F.slice(firm, k + 2, x["end"] - k - 1), True))

        def after(kept: Column) -> Column:
            left = F.transform(n, lambda x, k: F.get(alive, k) & F.when(F.get(said, k).isNull(), F.get(kept, k)).otherwise((F.get(par, k) < 0) | F.get(kept, F.get(par, k))))
            return let(left, lambda v: unnested(own, par, said, v, src))

        return let(bad, lambda lost: let(anchors(lost), lambda firm: let(kept_elements(firm), after)))

    def unnested(own: Column, par: Column, said: Column, alive: Column, src: Column) -> Column:
        if not o.unnest:
            return let(F.transform(n, lambda x, k: k < 0), lambda folded: listed(own, par, said, alive, src, folded))

        def folds(x: Column, k: Column) -> Column:
            """Whether an element holds one of its own kind, and nothing else but blank text."""
            kids = F.filter(F.sequence(k, x["end"] - 1), lambda c: F.get(alive, c) & (F.get(par, c) == k) & (F.get(own, c) != UNWRAP))
            of = lambda ks: F.filter(ks, lambda c: F.get(said, c).isNull())
            same = lambda ks: (F.size(of(ks)) == 1) & (F.get(n, F.get(of(ks), F.lit(0)))["tag"] == x["tag"]) & ~F.exists(ks, lambda c: filled(F.get(said, c)))
            element = (k > 0) & F.get(alive, k) & (F.get(own, k) == KEEP) & F.get(said, k).isNull() & (x["end"] - k > 1)
            return F.when(element, let(kids, same)).otherwise(False)

        return let(F.transform(n, folds), lambda folded: listed(own, par, said, alive, src, folded))

    def listed(own: Column, par: Column, said: Column, alive: Column, src: Column, folded: Column) -> Column:
        is_text = lambda k: F.get(said, k).isNotNull()
        stays = lambda k: F.get(alive, k) & (F.get(own, k) != UNWRAP) & ~F.get(folded, k) & ~(is_text(k) & F.coalesce(F.get(folded, F.get(par, k)), F.lit(False)))

        def path(k: Column) -> Column:
            return F.filter(F.get(n, k)["up"], lambda a: (F.get(own, a) == KEEP) & ~F.get(folded, a))

        def joined(order: Column) -> Column:
            """Nodes by their place among all that stay; a text goes on while texts of one parent follow."""
            begins = lambda j: ~((j > 0) & is_text(F.get(order, j)) & is_text(F.get(order, j - 1)) & (F.get(par, F.get(order, j)) == F.get(par, F.get(order, j - 1))))

            def node(j: Column, i: Column, firsts: Column) -> Column:
                k, to = F.get(order, j), F.coalesce(F.get(firsts, i + 1), F.size(order))
                text = F.when(is_text(k), F.array_join(F.transform(F.slice(order, j + 1, to - j), lambda m: F.get(said, m)), ""))
                tag = F.when(is_text(k), TEXT).otherwise(F.get(n, k)["tag"])
                return F.struct(F.concat(path(k), F.array(k)).alias("path"), tag.alias("tag"), text.alias("text"), F.get(n, k)["attrs"].alias("attrs"), F.get(src, k).alias("source"))

            firsts = F.filter(numbers(F.size(order)), begins)
            return let(firsts, lambda f: F.transform(f, lambda j, i: node(j, i, f)))

        in_medium = lambda x: F.exists(x["path"], lambda a: (a != F.element_at(x["path"], -1)) & is_medium(F.get(n, a)))
        return F.filter(let(F.filter(numbers(F.size(n)), stays), joined), lambda x: ~in_medium(x))

    return let(fates(n, o), with_fates)


def formatted(text: Column) -> Column:
    """One line of single spaces; what stood for breaks becomes line ends, and a space at either end stays."""
    one = F.regexp_replace(F.translate(text, "\n\t", "  "), " {2,}", " ")
    return let(one, lambda t: F.concat(
        F.when(t.startswith(" "), " ").otherwise(""), F.array_join(F.transform(F.split(t, BREAK), stripped), "\n"), F.when((F.length(t) > 1) & t.endswith(" "), " ").otherwise(""),
    ))


def separator(x: Column, y: Column, tags: Column) -> Column:
    """Two texts with the strongest separator of their ends and of the tags in which their paths differ."""
    end, start = F.regexp_extract(F.right(x, F.lit(4)), r"( ?\n?(?:\n\n)?)\z", 1), F.regexp_extract(y, r"^((?:\n\n)?\n? ?)", 1)

    def put(ends: Column) -> Column:
        end, start = ends["end"], ends["start"]
        marks = lambda m: end.rlike(r"^ ?\n?(\n\n)\z" if m == 2 else r"^ ?\n(\n\n)?\z" if m == 1 else "^ ") | start.rlike(r"^\n\n" if m == 2 else r"^(\n\n)?\n ?\z" if m == 1 else r" \z")
        of = lambda s: F.exists(tags, lambda t: t.isin(sorted(k for k, v in SEPARATORS.items() if v == s and k != "br")))
        mark = F.when(marks(2) | of("\n\n"), "\n\n").when(marks(1) | of("\n"), "\n").when(marks(0), " ").otherwise("")
        return F.concat(F.substring(x, F.lit(1), F.length(x) - F.length(end)), mark, F.substring(y, F.length(start) + 1, F.length(y)))

    return let(F.struct(end.alias("end"), start.alias("start")), put)


def merged(items: Column, tag_of: Callable[[Column], Column]) -> Column:
    """Runs of neighbouring texts as one text each; everything else as it is."""
    is_text = lambda i: F.get(items, i)["text"].isNotNull()
    firsts = F.filter(numbers(F.size(items)), lambda i: ~(is_text(i) & (i > 0) & F.coalesce(is_text(i - 1), F.lit(False))))

    def differ(i: Column) -> Column:
        above = lambda x: F.slice(x["path"], F.lit(1), F.size(x["path"]) - 1)  # noqa: E731  a text has no tag, even if it replaces an element
        a, b = above(F.get(items, i - 1)), above(F.get(items, i))
        return F.transform(F.concat(F.array_except(a, b), F.array_except(b, a)), tag_of)

    def run(j: Column, i: Column, starts: Column) -> Column:
        to = F.coalesce(F.get(starts, i + 1), F.size(items))
        rest = F.when(to - j > 1, F.sequence(j + 1, to - 1)).otherwise(F.array().cast("array<int>"))
        text = F.aggregate(rest, F.get(items, j)["text"], lambda x, k: separator(x, F.get(items, k)["text"], differ(k)))
        return F.get(items, j).withField("text", F.when(is_text(j), stripped(text)))

    return let(firsts, lambda f: F.transform(f, lambda j, i: run(j, i, f)))


def extracted(n: Column, o) -> Column:
    """(text, attrs) of texts, and of images (if asked for, of video and audio, too) with their address, in reading order."""
    wanted = ["img"] if o.only_text_and_images else ["img", "video", "audio"]

    def items(left: Column) -> Column:
        shown = F.filter(left, lambda x: (x["tag"] == TEXT) | x["tag"].isin(wanted) & x["source"].isNotNull())
        if o.format_texts:
            shown = F.transform(shown, lambda x: x.withField("text", F.when(x["text"].isNotNull(), formatted(x["text"]))))
        shown = F.filter(shown, lambda x: x["text"].isNull() | (x["text"] != ""))
        out = let(shown, lambda i: merged(i, lambda k: F.get(n, k)["tag"])) if o.merge_texts else shown

        def node(x: Column) -> Column:
            named = F.array(F.struct(F.lit("_source").alias("key"), x["source"].alias("value")), F.struct(F.lit("_media").alias("key"), F.when(x["tag"] != "img", x["tag"]).alias("value")))
            attrs = F.map_concat(F.map_filter(x["attrs"], lambda k, _: ~k.isin("_source", "_media")), F.map_from_entries(named))
            return F.struct(x["text"].alias("text"), F.when(x["text"].isNull(), attrs).alias("attrs"))

        return F.transform(F.filter(out, lambda x: x["text"].isNull() | filled(x["text"])), node)

    return let(simplified(n, o), items)
