"""Deduplication by address, image frequency, image set and paragraph.

Counts are partial aggregates and removals are anti-joins on equal keys, so a key of any frequency is spread: before
the shuffle it is summed, and Spark may split it in the join. No list of keys is collected or broadcast by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import EOD


def frequencies(rows: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias(name))


def too_frequent(rows: DataFrame, key: str, threshold: int = 10) -> DataFrame:
    """Keys that occur more than ``threshold`` times."""
    return frequencies(rows.where(F.col(key).isNotNull()), key).where(F.col("n") > threshold)


def remove_listed(rows: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """Rows whose key is not in ``listed``; null keys stay."""
    return rows.join(listed.select(key).distinct(), key, "left_anti")


def keep_listed(rows: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    return rows.join(listed.select(key).distinct(), key, "left_semi")


def drop_documents_with(docs: DataFrame, rows: DataFrame, doc: str, key: str, listed: DataFrame) -> DataFrame:
    """Documents none of whose rows (images) has a listed key."""
    return docs.join(keep_listed(rows, key, listed).select(doc).distinct(), doc, "left_anti")


def keys_to_keep(rows: DataFrame, key: str, frequent: DataFrame) -> DataFrame:
    return remove_listed(rows.select(key).where(F.col(key).isNotNull()).distinct(), key, frequent)


def latest_per_url(docs: DataFrame, url: str, recency: str) -> DataFrame:
    """The most recent documents of each address; all that tie for it stay."""
    latest = docs.groupBy(url).agg(F.max(recency).alias("_latest"))
    return docs.join(latest, url).where(F.col(recency) == F.col("_latest")).drop("_latest")


def duplicate_totals(docs: DataFrame, key: str) -> DataFrame:
    """Keys that occur at least twice, the rows that have them, and how many of those may go."""
    counts = frequencies(docs, key).where("n > 1")
    return counts.agg(F.count("*").alias("n_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_removable"))


def duplicated_paragraphs(rows: DataFrame, domain: str, paragraph: str, min_count: int = 3, protect_eod: bool = True) -> DataFrame:
    """(domain, paragraph, n) with at least ``min_count`` occurrences, repeats inside a document included."""
    out = frequencies(rows, domain, paragraph).where(F.col("n") >= min_count)
    return out.where(~F.col(paragraph).contains(EOD)) if protect_eod else out


def remove_paragraphs(rows: DataFrame, duplicated: DataFrame, domain: str, paragraph: str) -> DataFrame:
    """Every occurrence of a duplicated paragraph goes; no first copy stays."""
    return rows.join(duplicated.select(domain, paragraph), [domain, paragraph], "left_anti")


def line_dedup(docs: DataFrame, keys: list[str], domain: str, text: str = "text", separator: str = "\n\n", **how) -> DataFrame:
    """keys and text without the paragraphs duplicated within their domain; a text may become empty, a null text is one.

    One row per row of ``docs``, whatever its keys: null keys and repeated rows stay as they are. What goes depends on the
    domain and the text alone, so only places are regrouped, and a text is cut where it stands.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)), F.col(domain).alias("_domain"), F.md5(whole).alias("_same"), whole.alias("_text"))
    pieces = F.split("_text", separator)
    repeated = duplicated_paragraphs(rows.select("_domain", F.explode(pieces).alias("_paragraph")), "_domain", "_paragraph", **how)
    each = rows.dropDuplicates(["_domain", "_same"]).select("_domain", "_same", F.posexplode(pieces).alias("_pos", "_paragraph"))
    gone = each.join(repeated, ["_domain", "_paragraph"]).groupBy("_domain", "_same").agg(F.collect_set("_pos").alias("_gone"))
    out = rows.join(gone, ["_domain", "_same"], "left")
    left = F.array_join(F.filter(pieces, lambda _, k: ~F.array_contains("_gone", k)), separator)
    return out.select(*(F.col(f"_key{i}").alias(k) for i, k in enumerate(keys)), F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(left).alias("text"))


def set_signature(sources: Column, separator: str = "\u0001") -> Column:
    """Sorted distinct sources as one string; an empty separator gives the literal, collision-prone form."""
    return F.array_join(F.array_sort(F.array_distinct(sources)), separator)


def documents_to_remove_by_set(docs: DataFrame, signature: str, recency: str, order: str) -> DataFrame:
    """Of documents with one image set, all but the last by (recency, order)."""
    last = docs.groupBy(signature).agg(F.max(F.struct(recency, order)).alias("_last"))
    return docs.join(last, signature).where(F.struct(recency, order) != F.col("_last")).drop("_last")


def set_dedup(docs: DataFrame, url: str, signature: str, recency: str, order: str) -> DataFrame:
    """Removal by (url, recency): a kept document that shares that very pair with a removed one goes too.

    The signatures are grouped once: a group knows its last document, and a pair goes if any of its rows is not the last.
    A row whose signature is null is in no group, and goes only with another of its pair.
    """
    last = docs.groupBy(signature).agg(F.max(F.struct(recency, order)).alias("_last"), F.count("*").alias("_n")).where("_n > 1").select(signature, "_last")
    gone = docs.join(last, signature).where(F.struct(recency, order) != F.col("_last")).select(url, recency).distinct()
    return docs.join(gone, [url, recency], "left_anti")
