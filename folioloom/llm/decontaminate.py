"""Benchmark decontamination: windows of benchmark items in documents, by a prefix-filtered set join.

An item's windows are its runs of ``window`` words, or the whole of a shorter item, taken as sets of shingles of ``shingle``
words. A window is contained in a document only with all its shingles, so the necessary prefix of a window, its
shingles ordered by how rare they are in the documents, is the rarest one alone: documents are joined with windows on
it. A shingle's places in the window and in the document say where the window would begin, which must lie within the
document (position and length bound), and the words there are compared one by one, over a stretch of the item's size.

Two passes over the texts count item shingles and find prefix shingles; both pass over other words by a bitmap of
bounded size, on which no result depends. A task's words are numbered by array operations on UTF-8 bytes; words and
shingles are hashed, and a hash only proposes a place. Equal windows and equal items count once until the end, a text's
places are those of all its copies, and no step gathers more than the hits of one text.

Defined results: a null text has no words and no hits; an item without words is never found; several items of one id
are one, an item without an id is searched (its hits count) but not listed; short items are searched as they are, even
single words; repeated rows are treated alike; texts of any length are searched whole; with no documents or no items, nothing is contaminated; input
columns named like added ones are replaced, all others are passed on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import Scratch, bits_for, packed, passing, unpacked
from .fill_in_middle import bytes_of, slices

WINDOW, SHINGLE = 10, 5
TALL = 64  # places of a word that are told apart by its hash
_rng = np.random.default_rng(12)
LETTERS = _rng.integers(1 << 63, size=256 * TALL, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = _rng.integers(1 << 63, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


class Words:
    """All words of texts data[offsets[i]:offsets[i + 1]]: lower-cased bytes, begin and end of each, its text and hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        base = int(offsets[0])
        self.data = LOWER[data[base : offsets[-1]]]
        offsets = offsets - base
        word = IN_WORD[self.data]
        joined = np.zeros(len(word), bool)  # to the byte before, in one text
        joined[1:] = word[:-1]
        joined[offsets[:-1][offsets[:-1] < len(word)]] = False
        self.begins = np.flatnonzero(word & ~joined)
        letters = np.flatnonzero(word)
        first = np.searchsorted(letters, self.begins)
        sizes = np.diff(np.append(first, len(letters)))
        self.ends = self.begins + sizes
        self.text = np.searchsorted(offsets, self.begins, side="right") - 1
        self.first = np.searchsorted(self.begins, offsets)  # of each text
        place = (letters - np.repeat(self.begins, sizes)) % TALL
        found = LETTERS[self.data[letters].astype(np.int64) * TALL + place]
        self.hashes = np.add.reduceat(found, first) if len(first) else np.zeros(0, np.uint64)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes (as longs) of all runs of ``size`` words of one text."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = np.full(n, size, np.uint64)
        for k in range(size):
            h += self.hashes[k : k + n] * PLACES[k]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        whole = np.flatnonzero(self.text[:n] == self.text[size - 1 :])
        return whole, h[whole].view(np.int64)

    def joined(self, lo: int, hi: int) -> str:
        return b" ".join(self.data[b:e].tobytes() for b, e in zip(self.begins[lo:hi].tolist(), self.ends[lo:hi].tolist(), strict=True)).decode("utf-8", "replace")


def over_words(texts: DataFrame, fn: Callable[..., Iterator[tuple]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Rows that ``fn(words, keys)`` gives for batches of texts; ``texts`` has a text and perhaps a key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = bytes_of(batch.column(0))
            for lo, hi in slices(offsets):
                keys = batch.column(1).slice(lo, hi - lo) if batch.num_columns > 1 else None
                columns = fn(Words(data, offsets[lo : hi + 1]), keys)
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return texts.mapInArrow(run, schema)


def item_windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """(item, words, n, shingles): every window of each of the items (text, item), its words and hashes of its shingles."""
    arrow = pa.schema([("item", pa.string()), ("words", pa.string()), ("n", pa.int32()), ("shingles", pa.list_(pa.int64()))])

    def run(w: Words, ids: pa.Array):
        out = []
        hashes = {}
        for size in range(1, shingle + 1):
            at, h = w.shingles(size)
            hashes[size] = np.zeros(len(w.hashes), np.int64)
            hashes[size][at] = h
        for i, item in enumerate(ids.to_pylist()):
            lo, hi = int(w.first[i]), int(w.first[i + 1])
            n = min(window, hi - lo)
            size = min(shingle, n)
            for at in range(lo, hi - n + 1) if n else ():
                out.append((item, w.joined(at, at + n), n, hashes[size][at : at + n - size + 1].tolist()))
        return list(zip(*out, strict=True)) or [[]] * 4

    return over_words(items, run, "item string, words string, n int, shingles array<long>", arrow)


def shingle_counts(texts: DataFrame, sizes: list[int], maybe: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(h, times) of the shingles that may be an item's."""

    def run(w: Words, _):
        h = np.concatenate([w.shingles(s)[1] for s in sizes])
        return np.unique(h[maybe(h)], return_counts=True)

    counted = over_words(texts, run, "h long, n long", pa.schema([("h", pa.int64()), ("n", pa.int64())]))
    return counted.groupBy("h").agg(F.sum("n").alias("times"))


def found_places(texts: DataFrame, sizes: list[int], maybe: Callable[[np.ndarray], np.ndarray], window: int, shingle: int) -> DataFrame:
    """(key, h, at, n_words, near, back): places of shingles that may be a prefix, with the words of all windows around."""
    arrow = pa.schema([("key", pa.string()), ("h", pa.int64()), ("at", pa.int64()), ("n_words", pa.int64()), ("near", pa.string()), ("back", pa.int32())])

    def run(w: Words, keys: pa.Array):
        out = []
        for size in sizes:
            at, h = w.shingles(size)
            yes = maybe(h)
            reach = window if size == shingle else size  # a window of fewer words is one shingle
            for k, x in zip(at[yes].tolist(), h[yes].tolist(), strict=True):
                text = int(w.text[k])
                lo, hi = int(w.first[text]), int(w.first[text + 1])
                start = max(lo, k - (reach - size))
                out.append((keys[text].as_py(), x, k - lo, hi - lo, w.joined(start, min(hi, k + reach)), k - start))
        return list(zip(*out, strict=True)) or [[]] * 6

    return over_words(texts, run, "key string, h long, at long, n_words long, near string, back int", arrow)


@F.arrow_udf(LongType())
def word_counts(texts: pa.Array) -> pa.Array:
    data, offsets = bytes_of(texts)
    return pa.array(np.concatenate([np.diff(Words(data, offsets[lo : hi + 1]).first) for lo, hi in slices(offsets)] or [np.zeros(0, np.int64)]), pa.int64())


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside any occurrence of a window), spans (first word, words), items, contaminated.

    ``items`` has text and item_id. ``items`` lists the ids, as sorted strings, of which a window occurs in the document.
    """
    spark = docs.sparkSession
    work = Scratch(spark)
    windows = work.keep(item_windows(items.select("text", F.col("item_id").cast("string").alias("item")), window, shingle), "windows")
    distinct = windows.groupBy("words").agg(F.any_value("n").alias("n"), F.any_value("shingles").alias("shingles"))
    sizes = sorted(r[0] for r in windows.select(F.least("n", F.lit(shingle))).distinct().collect())  # at most ``shingle`` numbers
    texts = docs.select(F.col("text"), F.sha2("text", 256).alias("key"))
    shingles = distinct.select("words", "n", F.posexplode("shingles").alias("place", "h"))
    maybe = passing(shingles.select("h"), bits := bits_for(shingles.count()))
    counts = shingle_counts(texts.select("text"), sizes or [shingle], maybe)
    # The rarest shingle of each window; a window of which the documents lack one has none to join on.
    rarest = F.min(F.struct("times", "h", "place")).alias("p")
    prefix = shingles.join(counts, "h", "left").groupBy("words").agg(F.any_value("n").alias("n"), rarest, F.bool_and(F.col("times").isNotNull()).alias("all"))
    prefix = work.keep(prefix.where("all").select("words", "n", F.col("p.h").alias("h"), F.col("p.place").alias("place")), "prefix")

    places = found_places(texts, sizes or [shingle], passing(prefix.select("h"), bits), window, shingle)
    starts = F.col("at") - F.col("place")
    bounds = (starts >= 0) & (starts + F.col("n") <= F.col("n_words"))
    near = F.array_join(F.slice(F.split("near", " "), F.col("back") - F.col("place") + 1, F.col("n")), " ")
    met = places.join(prefix, "h").where(F.when(bounds, near == F.col("words")).otherwise(False))
    hits = work.keep(met.select("key", starts.alias("start"), F.col("n").cast("long").alias("n"), "words").distinct(), "hits")

    spans = hits.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "n"))).alias("spans"))
    # Items of equal windows are one class until the texts' classes are told apart.
    named = windows.where("item is not null")
    classes = named.groupBy("item").agg(F.sha2(F.array_join(F.array_sort(F.collect_set("words")), "\n"), 256).alias("class"))
    of_class = named.join(classes, "item").select("class", "words").distinct()
    met_classes = hits.select("key", "words").distinct().join(of_class, "words").select("key", "class").distinct()
    listed = met_classes.join(classes, "class").groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))

    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n")),
        lambda s, x: F.struct(F.greatest(s["to"], x["start"] + x["n"]).alias("to"), (s["n"] + F.greatest(F.lit(0), x["start"] + x["n"] - F.greatest(s["to"], x["start"]))).alias("n")),
    )["n"]
    # A table of its own, so that the join with all documents may deal out the copies of one text to several tasks.
    found = work.keep(spans.join(listed, "key", "left").select("key", "spans", covered.alias("n_hit"), "items"), "found")
    work.drop("windows", "prefix", "hits")
    rows = packed(docs).select("doc", word_counts(F.col("doc.text")).alias("n_words"), F.sha2("doc.text", 256).alias("key")).join(found, "key", "left")
    return rows.select(*unpacked(
        docs.columns, n_words=F.col("n_words"), n_hit=F.coalesce("n_hit", F.lit(0).cast("long")), spans=F.coalesce("spans", F.array().cast("array<struct<start:bigint,n:bigint>>")),
        items=F.coalesce("items", F.array().cast("array<string>")), contaminated=F.coalesce(F.col("n_hit") > 0, F.lit(False)),
    ))
