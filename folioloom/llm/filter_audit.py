"""Audit of filters that run in a row: what each removes, in every order, from a packed bitmap index.

Tasks pack what each document fails, and its labels, into bitmaps of one bit a document, by part and in blocks: the
index. From it, for each set of filters that may have run before another, the bits of that set are joined by OR, and
AND-NOT and a popcount tell what the other removes, finds already gone, and loses. Counts are summed over blocks, so
what is shuffled grows with parts and blocks, not with documents; all orders of the filters are read off the sums.

Defined results: a null text is an empty one; a null part is the empty string; a document without a label counts as
neither good nor toxic, one with several labels as what any of them says; repeated rows count each, and equal texts are
duplicates of the smallest doc_id only where theirs is larger (a null doc_id is never larger); texts of any length are
read whole; an empty table gives an empty report; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from .common import Scratch

FILTERS = "ABCDE"
BLOCK = 1 << 16  # documents of a bitmap at most
UPPER = bytes(range(65, 91))
SYMBOLS = b"#$%&|*"


def fails_by_itself(text: str) -> int:
    """The filters A to D that a text fails, as bits: few words, few different words, many capitals, symbols."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, bare = len(words), raw.translate(None, UPPER)
    few, same = n < 200, 100 * len(set(words)) < 50 * n
    loud, odd = 100 * (len(raw) - len(bare)) > 3 * len(text), len(bare) > len(bare.translate(None, SYMBOLS))
    return few | same << 1 | loud << 2 | odd << 3


@F.arrow_udf(IntegerType())
def failed_bits(texts: pa.Array) -> pa.Array:
    return pa.array([fails_by_itself(t.as_py() or "") for t in texts], pa.int32())


def judged(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, bits, good, toxic) of every document; bit k of bits says that it fails filter k."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), failed_bits(text).alias("bits"), F.sha2(text, 256).alias("key"))
    # The smallest id of each text that has several ids: few rows, and the only ones that a duplicate needs.
    ids = docs.groupBy(F.sha2(text, 256).alias("key")).agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("key", "low")
    ids = Scratch(docs.sparkSession).keep(ids, "ids")  # a table of its own, so that the join may deal out the copies of one text
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    rows = rows.join(ids, "key", "left").join(marks, "doc_id", "left")
    bits = F.col("bits").bitwiseOR(F.when(F.col("doc_id") > F.col("low"), 16).otherwise(0))
    return rows.select("part", bits.alias("bits"), F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def index(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(part, n, fails, good, toxic): bitmaps of at most ``block`` documents of a part, a list of one for each filter."""
    n_filters = len(FILTERS)

    def packed(part: str, bits: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict:
        fails = [np.packbits((bits >> k) & 1).tobytes() for k in range(n_filters)]
        return {"part": part, "n": len(bits), "fails": fails, "good": np.packbits(good).tobytes(), "toxic": np.packbits(toxic).tobytes()}

    schema = pa.schema([("part", pa.string()), ("n", pa.int64()), ("fails", pa.list_(pa.binary())), ("good", pa.binary()), ("toxic", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).sort_by("part")
            parts = table["part"].combine_chunks()
            _, runs = zip(*((r["values"], r["counts"]) for r in parts.value_counts().to_pylist()), strict=True)
            columns = [table[c].to_numpy() for c in ("bits", "good", "toxic")]
            out, at = [], 0
            for n in runs:
                for lo in range(at, at + n, block):
                    hi = min(lo + block, at + n)
                    out.append(packed(parts[lo].as_py(), *(c[lo:hi] for c in columns)))
                at += n
            held.clear()
            for lo in range(0, len(out), 1024):
                yield pa.RecordBatch.from_pylist(out[lo : lo + 1024], schema)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= block:
                yield from flush()
        if sum(b.num_rows for b in held):
            yield from flush()

    return rows.select("part", "bits", "good", "toxic").mapInArrow(run, "part string, n long, fails array<binary>, good binary, toxic binary")


def popcount(bits: np.ndarray) -> int:
    return int(np.bitwise_count(bits).sum())


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def prefix_counts(blocks: DataFrame) -> DataFrame:
    """(part, before, filter, counts): for each set of filters before (as bits) and each other filter, summed over blocks."""
    n_filters = len(FILTERS)
    everyone = (1 << n_filters) - 1
    schema = pa.schema([("part", pa.string()), ("before", pa.int32()), ("filter", pa.int32()), *((c, pa.int64()) for c in COUNTS)])

    def of(part: str, n: int, fails: list[bytes], good: bytes, toxic: bytes) -> Iterator[tuple]:
        f, good_, toxic_ = [np.frombuffer(x, np.uint8) for x in fails], np.frombuffer(good, np.uint8), np.frombuffer(toxic, np.uint8)
        gone = [np.zeros(len(good_), np.uint8)]  # by set of filters: the documents that any of them fails
        for s in range(1, everyone + 1):
            low = (s & -s).bit_length() - 1
            gone.append(gone[s & (s - 1)] | f[low])
        failing = [popcount(x) for x in gone]
        for k in range(n_filters):
            alone = popcount(f[k] & ~gone[everyone ^ (1 << k)])
            for s in range(everyone + 1):
                if not s >> k & 1:
                    new = f[k] & ~gone[s]
                    yield part, s, k, n - failing[s | 1 << k], (removed := popcount(new)), failing[1 << k] - removed, alone, popcount(new & good_), popcount(new & toxic_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                rows = [r for b in batch.slice(lo, 64).to_pylist() for r in of(**b)]
                yield pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    counted = blocks.mapInArrow(run, "part string, before int, filter int, " + ", ".join(f"{c} long" for c in COUNTS))
    return counted.groupBy("part", "before", "filter").agg(*(F.sum(c).alias(c) for c in COUNTS))


def audit(blocks: DataFrame) -> DataFrame:
    """(part, filter_order, step, counts, shapley) for every order of the filters and every step of it."""
    n_filters = len(FILTERS)
    steps = [
        (order, k + 1, sum(1 << FILTERS.index(x) for x in order[:k]), FILTERS.index(order[k]))
        for order in map("".join, permutations(FILTERS))
        for k in range(n_filters)
    ]
    orders = blocks.sparkSession.createDataFrame(steps, "filter_order string, step int, before int, filter int")
    sums = prefix_counts(blocks)
    size = sum((F.col("before").bitwiseAND(1 << k) / (1 << k)).cast("int") for k in range(n_filters))
    # Orders in which exactly these filters come before: theirs times those of the rest.
    ways = F.element_at(F.array(*(F.lit(factorial(k) * factorial(n_filters - 1 - k)) for k in range(n_filters))), size + 1).cast("long")
    listed = F.collect_list(F.struct("before", *COUNTS))  # one for each set of other filters
    by_filter = sums.withColumn("ways", ways).groupBy("part", "filter").agg(listed.alias("sets"), F.sum(F.col("ways") * F.col("removed")).alias("shapley"))
    rows = by_filter.select("part", "filter", "shapley", F.inline("sets"))
    return rows.join(F.broadcast(orders), ["before", "filter"]).select("part", "filter_order", "step", *COUNTS, "shapley")  # 600 rows
