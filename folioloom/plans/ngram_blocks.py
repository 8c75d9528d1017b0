"""The model of ``ngrams`` over blocks of texts (see ``blocks``): the same perplexities, with arrays shuffled in place of rows.

Words get numbers from buckets of words. A block sends its different triples with their counts to buckets of (u, v); these count
triples and contexts, and send different pairs to buckets of v, with the number of different u before each; these count pairs, and
ask buckets of w for the number of different v before a word. Probabilities go back the same way: of words, pairs, triples. A run that was not
counted has no share of its own, and a context that was not counted leaves all to the shorter one, so one rule serves all runs.
A very frequent v has its triples in ``SPREAD`` buckets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .ngrams import BEGIN, END

SPREAD = 8
LARGE = 31  # bits of a word's number at most


def words_asked(me: int, texts: pa.Table, blocks: int) -> pa.Table:
    words, _, _ = B.words_of(texts)
    return B.asked(me, B.buckets_of_words(words, blocks), {"words": words})


def words_numbered(me: int, table: pa.Table, blocks: int) -> pa.Table:
    words, ids = B.numbered(B.flat(table.column("words")))
    if len(words) * blocks + me >= 1 << LARGE:
        raise ValueError("more different words than numbers of 31 bits")
    return B.table_of(B.answered(me, table, "words", "ids", (ids * blocks + me).astype(np.int32)))


def unique_runs(*parts: np.ndarray, inverse: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Places of one of each different run of numbers below 2**31, in order, and each run's place among them."""
    key = parts[0].astype(np.int64)
    for k, p in enumerate(parts[1:], 1):
        if k > 1:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
        key = key << LARGE | p
    _, first, place = np.unique(key, return_index=True, return_inverse=True)
    return first, place


class Triples:
    """The different triples of a block's texts by numbers within the block, and the triple of each occurrence."""

    def __init__(self, texts: pa.Table, answers: pa.Table, blocks: int):
        words, ids, n = B.words_of(texts)
        number = B.told(answers, B.buckets_of_words(words, blocks), "ids").astype(np.int64)
        size = len(words)
        self.row = np.repeat(np.arange(len(n)), np.maximum(n - 2, 0))
        at = np.arange(len(self.row)) + 2 * (self.row + 1)  # each text begins with two marks
        key = ids[at - 2] * size + ids[at - 1]
        if size >= 1 << 21:
            kinds, key = np.unique(key, return_inverse=True)
            packed, self.place = np.unique(key * size + ids[at], return_inverse=True)
            pair, w = kinds[packed // size], packed % size
        else:
            packed, self.place = np.unique(key * size + ids[at], return_inverse=True)
            pair, w = packed // max(size, 1), packed % max(size, 1)
        self.u, self.v, self.w = (number[x].astype(np.int32) for x in (pair // max(size, 1), pair % max(size, 1), w))
        self.buckets = (B.mixed(self.v) + B.mixed(self.u) % SPREAD) % blocks
        self.tokens = np.maximum(n - 2, 0)


def triples_asked(me: int, texts: pa.Table, answers: pa.Table, blocks: int) -> pa.Table:
    t = Triples(texts, answers, blocks)
    trained = texts.column("train").to_numpy(zero_copy_only=False).astype(bool)
    n = np.bincount(t.place[trained[t.row]], minlength=len(t.u)).astype(np.int32)
    return B.asked(me, t.buckets, {"u": t.u, "v": t.v, "w": t.w, "n": n})


class Counted:
    """The triples of a bucket: counts, contexts and pairs."""

    def __init__(self, table: pa.Table, blocks: int):
        u, v, w, n = (B.flat_numbers(table, c) for c in "uvwn")
        first, self.place = unique_runs(u, v, w)
        self.n = np.bincount(self.place, n, len(first))
        self.u, self.v, self.w = u[first], v[first], w[first]
        at, self.pair = unique_runs(self.v, self.w)
        self.pair_v, self.pair_w = self.v[at], self.w[at]
        self.buckets = B.mixed(self.pair_v) % blocks


def pairs_asked(me: int, table: pa.Table, blocks: int) -> pa.Table:
    t = Counted(table, blocks)
    n = np.bincount(t.pair[t.n > 0], minlength=len(t.pair_v)).astype(np.int32)
    return B.asked(me, t.buckets, {"v": t.pair_v, "w": t.pair_w, "n": n}, once3=int((t.n == 1).sum()), twice3=int((t.n == 2).sum()))


class Pairs:
    """The pairs of a bucket, with the number of different words before each."""

    def __init__(self, table: pa.Table, blocks: int):
        v, w, n = (B.flat_numbers(table, c) for c in "vwn")
        first, self.place = unique_runs(v, w)
        self.n = np.bincount(self.place, n, len(first))
        self.v, self.w = v[first], w[first]
        self.words, self.word = np.unique(self.w, return_inverse=True)
        self.buckets = B.mixed(self.words) % blocks


def singles_asked(me: int, table: pa.Table, blocks: int) -> pa.Table:
    t = Pairs(table, blocks)
    n = np.bincount(t.word[t.n > 0], minlength=len(t.words)).astype(np.int32)
    passed_on = {c: int(B.pc.sum(table.column(c)).as_py() or 0) for c in ("once3", "twice3")}
    return B.asked(me, t.buckets, {"w": t.words.astype(np.int32), "n": n}, once2=int((t.n == 1).sum()), twice2=int((t.n == 2).sum()), **passed_on)


def singles_counted(me: int, table: pa.Table) -> pa.Table:
    """Of each word the number of different words before it; the first row has the bucket's part of all sums."""
    w, n = B.flat_numbers(table, "w"), B.flat_numbers(table, "n")
    _, place = np.unique(w, return_inverse=True)
    count = np.bincount(place, n).astype(np.int64)
    rows = B.answered(me, table, "w", "n", count[place])
    sums = {c: int(B.pc.sum(table.column(c)).as_py() or 0) for c in ("once3", "twice3", "once2", "twice2")}
    sums |= {"once1": int((count == 1).sum()), "twice1": int((count == 2).sum()), "total": int(count.sum()), "kinds": int((count > 0).sum())}
    return B.table_of(rows | {c: np.where(np.arange(table.num_rows) == 0, x, 0).astype(np.int64) for c, x in sums.items()})


SUMS = ("once3", "twice3", "once2", "twice2", "once1", "twice1", "total", "kinds")


def parts_of_sums(_: int, table: pa.Table) -> pa.Table:
    return pa.table({c: pa.array([B.pc.sum(table.column(c)).as_py() or 0], pa.int64()) for c in SUMS})


def discounts(sums: DataFrame) -> DataFrame:
    """One row: what is taken off counts of runs of three, two and one words, the sum and the number of words."""
    s = sums.agg(*(F.sum(c).alias(c) for c in SUMS))
    off = [F.when(F.col(f"once{k}") > 0, F.col(f"once{k}") / (F.col(f"once{k}") + 2 * F.col(f"twice{k}"))).otherwise(0.0).alias(f"d{k}") for k in (3, 2, 1)]
    return s.select(*off, F.coalesce("total", F.lit(0)).cast("double").alias("all"), F.coalesce("kinds", F.lit(0)).cast("double").alias("all_kinds"))


def constant(table: pa.Table, name: str) -> float:
    return table.column(name)[0].as_py()


def shares(n: np.ndarray, context: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
    """Each run's own share of its context, and what the context leaves."""
    totals, kinds = np.bincount(context, n), np.bincount(context, n > 0)
    known = totals > 0
    total = np.where(known, totals, 1.0)
    return np.maximum(n - d, 0.0) / total[context], np.where(known, d * kinds / total, 1.0)[context]


def pairs_likely(me: int, table: pa.Table, answers: pa.Table, blocks: int) -> pa.Table:
    t = Pairs(table, blocks)
    n = B.told(answers, t.buckets, "n")
    d1, d2, total, kinds = (constant(answers, c) for c in ("d1", "d2", "all", "all_kinds"))
    if total:
        one = np.maximum(n - d1, 0.0) / total + d1 * kinds / total / (kinds + 1)
    else:
        one = np.full(len(n), np.nan)
    own, left = shares(t.n, np.unique(t.v, return_inverse=True)[1], d2)
    return B.table_of(B.answered(me, table, "v", "p", (own + left * one[t.word])[t.place]))


def triples_likely(me: int, table: pa.Table, answers: pa.Table, blocks: int) -> pa.Table:
    t = Counted(table, blocks)
    two = B.told(answers, t.buckets, "p")
    own, left = shares(t.n, unique_runs(t.u, t.v)[1], constant(answers, "d3"))
    with np.errstate(divide="ignore"):
        logs = np.log10(own + left * two[t.pair])
    return B.table_of(B.answered(me, table, "u", "lp", logs[t.place]))


def texts_scored(me: int, texts: pa.Table, answers: pa.Table, blocks: int) -> pa.Table:
    t = Triples(texts, answers, blocks)
    logs = B.told(answers, t.buckets, "lp")
    sums = np.bincount(t.row, logs[t.place], len(t.tokens))
    return pa.table({"key": texts.column("key"), "lp": pa.array(sums, pa.float64()), "n": pa.array(t.tokens, pa.int64())})


def perplexity(docs: DataFrame, key: str, tokens: Column, trained: Column, blocks: int) -> DataFrame:
    """(key, perplexity) of all ``docs`` under a model of the ``trained`` ones, as ``ngrams.perplexity`` gives them."""
    k = blocks
    padded = F.concat(F.array(F.lit(BEGIN), F.lit(BEGIN)), tokens, F.array(F.lit(END)))
    texts = B.in_blocks(docs, padded, k, key=F.col(key), train=F.coalesce(trained, F.lit(False)))
    words = B.dealt(B.each(texts, lambda me, t: words_asked(me, t, k), "to int, asker int, words array<string>"), k)
    numbers = B.dealt(B.each(words, lambda me, t: words_numbered(me, t, k), "to int, asker int, ids array<int>"), k)
    triples = B.dealt(B.both(texts, numbers, lambda me, t, a: triples_asked(me, t, a, k), "to int, asker int, u array<int>, v array<int>, w array<int>, n array<int>"), k)
    pairs = B.dealt(B.each(triples, lambda me, t: pairs_asked(me, t, k), "to int, asker int, v array<int>, w array<int>, n array<int>, once3 long, twice3 long"), k)
    singles = B.dealt(B.each(pairs, lambda me, t: singles_asked(me, t, k), "to int, asker int, w array<int>, n array<int>, once2 long, twice2 long, once3 long, twice3 long"), k)
    counts = B.dealt(B.each(singles, singles_counted, "to int, asker int, n array<long>, " + ", ".join(f"{c} long" for c in SUMS)), k)
    one_row = F.broadcast(discounts(B.each(counts, parts_of_sums, ", ".join(f"{c} long" for c in SUMS))))
    pair_p = B.dealt(B.both(pairs, counts.crossJoin(one_row), lambda me, t, a: pairs_likely(me, t, a, k), "to int, asker int, p array<double>"), k)
    triple_p = B.dealt(B.both(triples, pair_p.crossJoin(one_row), lambda me, t, a: triples_likely(me, t, a, k), "to int, asker int, lp array<double>"), k)
    answers = numbers.withColumn("lp", F.lit(None).cast("array<double>")).unionByName(triple_p.withColumn("ids", F.lit(None).cast("array<int>")))
    kind = dict(docs.select(F.col(key).alias("key")).dtypes)["key"]
    sums = B.both(texts, answers, lambda me, t, a: texts_scored(me, t, a, k), f"key {kind}, lp double, n long").where("key is not null")
    sums = sums.groupBy("key").agg(F.sum("lp").alias("lp"), F.sum("n").alias("n"))
    scores = sums.select(F.col("key").alias(key), F.round(F.pow(F.lit(10.0), F.nanvl(-F.col("lp") / F.col("n"), F.lit(None).cast("double"))), 1).alias("perplexity"))
    return docs.select(key).join(scores, key, "left")
