"""Final cleaning of nodes and paragraphs, within the row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import EOD, SPAM_SHARE
from ..functions.text import let, spam_ratio
from .filters import has_text_and_image, not_only_sentinels


def images_once(nodes: Column) -> Column:
    """Without the repeats of an image source after its first place in the document."""

    def of(bound: Column) -> Column:
        sources = F.transform(bound, lambda n: n["meta"]["src"])
        first = lambda listed: F.filter(bound, lambda n, k: n["meta"]["src"].isNull() | (F.array_position(listed, n["meta"]["src"]) == k + 1))
        return let(sources, first)

    return let(nodes, of)


def without_spam_paragraphs(t: Column, separator: str = "\n\n", most: float = SPAM_SHARE) -> Column:
    return F.array_join(F.filter(F.split(t, separator), lambda p: spam_ratio(p) < most), separator)


def merge_texts(nodes: Column, node_type: str, separator: str = "\n\n") -> Column:
    """Runs of texts become one node; empty texts and lost images do not break a run and go."""
    kept = F.filter(nodes, lambda n: n["meta"].isNotNull() | (n["text"].isNotNull() & (n["text"] != "")))

    def add(done: Column, n: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & n["meta"].isNull() & F.try_element_at(done, F.lit(-1))["meta"].isNull()
        joined = F.struct(F.concat(last["text"], F.lit(separator), n["text"]).alias("text"), n["meta"].alias("meta")).cast(node_type)
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(done, F.array(n.cast(node_type))))

    return F.aggregate(kept, F.array().cast(f"array<{node_type}>"), add)


def collapse_sentinels(t: Column, separator: str = "\n\n") -> Column:
    keep = lambda parts: F.filter(parts, lambda p, k: (k == 0) | (F.trim(p) != EOD) | (F.trim(F.get(parts, k - 1)) != EOD))
    return F.array_join(let(F.split(t, separator), keep), separator)


def strip_last_sentinel(t: Column, separator: str = "\n\n") -> Column:
    cut = lambda parts: F.when(F.element_at(parts, -1) == EOD, F.array_join(F.slice(parts, 1, F.size(parts) - 1), separator)).otherwise(t)
    return let(F.split(t, separator), cut)


def final_nodes(nodes: Column, node_type: str) -> Column:
    """Images once, no spam paragraphs, merged texts, single sentinels, none at the end, merged again."""

    def with_text(n: Column, t: Column) -> Column:
        return F.struct(F.when(n["text"].isNotNull(), t).alias("text"), n["meta"].alias("meta")).cast(node_type)

    def without_end(out: Column) -> Column:
        last = F.array_max(F.transform(out, lambda n, k: F.when(n["text"].isNotNull(), k)))
        return let(last, lambda at: F.transform(out, lambda n, k: F.when(k == at, with_text(n, strip_last_sentinel(n["text"]))).otherwise(n.cast(node_type))))

    out = F.transform(images_once(nodes), lambda n: with_text(n, without_spam_paragraphs(n["text"])))
    out = F.transform(merge_texts(out, node_type), lambda n: with_text(n, collapse_sentinels(n["text"])))
    return merge_texts(let(out, without_end), node_type)


def final_documents(docs: DataFrame, node_type: str) -> DataFrame:
    """``final_nodes`` and the document filters: a text besides sentinels, and both a text and an image."""
    texts = lambda nodes: F.transform(nodes, lambda n: n["text"])
    fine = lambda nodes: let(texts(nodes), lambda t: not_only_sentinels(t) & has_text_and_image(t))
    # One array of one document or none, exploded: so that the nodes are made once, and not again for a filter.
    return docs.withColumn("nodes", F.explode(F.filter(F.array(final_nodes(F.col("nodes"), node_type)), fine)))
