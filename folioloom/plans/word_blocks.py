"""The plain models of ``models`` over blocks of texts (see ``blocks``): a block sends each of its different words once, not each document its own."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import blocks as B


def some(words: Column) -> Column:
    """Null for no words."""
    return T.let(words, lambda ws: F.when(F.size(ws) > 0, ws))


# --- Perplexity under unigram counts -------------------------------------------------------------------------------


def counts_asked(me: int, texts: pa.Table, blocks: int) -> pa.Table:
    words, ids, _ = B.words_of(texts)
    return B.asked(me, B.buckets_of_words(words, blocks), {"words": words, "n": np.bincount(ids, minlength=len(words)).astype(np.int64)})


def counts_told(me: int, table: pa.Table) -> pa.Table:
    words, ids = B.numbered(B.flat(table.column("words")))
    n = np.bincount(ids, B.flat_numbers(table, "n"), len(words)).astype(np.int64)
    first = np.arange(table.num_rows) == 0
    return B.table_of(B.answered(me, table, "words", "n", n[ids]) | {"total": np.where(first, n.sum(), 0), "kinds": np.where(first, len(words), 0)})


def sums_of(_: int, table: pa.Table) -> pa.Table:
    return pa.table({c: pa.array([pc.sum(table.column(c)).as_py() or 0], pa.int64()) for c in ("total", "kinds")})


def texts_scored(me: int, texts: pa.Table, answers: pa.Table, blocks: int) -> pa.Table:
    words, ids, size = B.words_of(texts)
    n = B.told(answers, B.buckets_of_words(words, blocks), "n")
    logs = np.log10((n + 1) / answers.column("all")[0].as_py())
    lp = np.bincount(np.repeat(np.arange(len(size)), size), logs[ids], len(size))
    return pa.table({"key": texts.column("key"), "lp": pa.array(lp, pa.float64()), "n": pa.array(size, pa.int64())})


def unigram_perplexity(docs: DataFrame, key: str, text: str, blocks: int) -> DataFrame:
    """(key, perplexity) as ``models.unigram_perplexity`` gives them."""
    k = blocks
    texts = B.in_blocks(docs, some(T.words(T.normalize(F.col(text)))), k, key=F.col(key))
    words = B.dealt(B.each(texts, lambda me, t: counts_asked(me, t, k), "to int, asker int, words array<string>, n array<long>"), k)
    counts = B.dealt(B.each(words, counts_told, "to int, asker int, n array<long>, total long, kinds long"), k)
    whole = B.each(counts, sums_of, "total long, kinds long").agg((F.sum("total") + F.sum("kinds")).cast("double").alias("all"))
    kind = dict(docs.select(F.col(key).alias("key")).dtypes)["key"]
    rows = B.both(texts, counts.crossJoin(F.broadcast(whole)), lambda me, t, a: texts_scored(me, t, a, k), f"key {kind}, lp double, n long")  # one row
    sums = rows.where("key is not null").groupBy("key").agg(F.sum("lp").alias("lp"), F.sum("n").alias("n"))
    scores = sums.select(F.col("key").alias(key), F.round(F.pow(F.lit(10.0), -F.col("lp") / (F.col("n") + 1)), 1).alias("perplexity"))
    return docs.select(key).join(scores, key, "left")


# --- Languages by words --------------------------------------------------------------------------------------------


def ragged(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all elements of lists that start at ``starts``, one list after another."""
    before = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else np.zeros(0, np.int64)
    return np.repeat(starts - before, size) + np.arange(size.sum())


def pairs_asked(me: int, texts: pa.Table, blocks: int) -> pa.Table:
    """Different (word, language) of a block with their counts, by buckets of words."""
    words, ids, size = B.words_of(texts)
    language = texts.column("language").combine_chunks()
    language = (pa.concat_arrays(language.chunks) if isinstance(language, pa.ChunkedArray) else language).dictionary_encode("encode")
    kinds = max(1, len(language.dictionary))
    pair, n = np.unique(ids * kinds + np.repeat(language.indices.to_numpy(zero_copy_only=False).astype(np.int64), size), return_counts=True)
    buckets = B.buckets_of_words(words, blocks)
    return B.asked(me, buckets[pair // kinds], {"words": words.take(pa.array(pair // kinds)), "languages": language.dictionary.take(pa.array(pair % kinds)), "n": n.astype(np.int64)})


def weights_told(me: int, table: pa.Table, prior: float) -> pa.Table:
    """For each asker, each of its words once, with the number of languages of the word, these and the weights."""
    words, ids = B.numbered(B.flat(table.column("words")))
    language = B.flat(table.column("languages")).dictionary_encode("encode")
    kinds = max(1, len(language.dictionary))
    pair, place = np.unique(ids * kinds + language.indices.to_numpy(zero_copy_only=False).astype(np.int64), return_inverse=True)
    n = np.bincount(place, B.flat_numbers(table, "n"), len(pair))
    of = pair // kinds
    weight = n / (np.bincount(of, n, len(words)) + prior)[of]
    start, size = np.searchsorted(of, np.arange(len(words))), np.bincount(of, minlength=len(words))
    ends, rows = B.offsets_of(table.column("words")), []
    for asker, lo, hi in zip(table.column("asker").to_pylist(), ends[:-1], ends[1:], strict=True):
        own = np.unique(ids[lo:hi])
        at = ragged(start[own], size[own])
        one = [np.array([0, len(own)]), np.array([0, len(at)])]
        rows.append(pa.RecordBatch.from_pydict({
            "to": pa.array([asker], pa.int32()), "asker": pa.array([me], pa.int32()), "k": B.lists(one[0], size[own].astype(np.int32)),
            "languages": B.lists(one[1], language.dictionary.take(pa.array(pair[at] % kinds))), "weights": B.lists(one[1], weight[at]),
        }))
    return pa.Table.from_batches(rows)


def texts_weighed(me: int, texts: pa.Table, answers: pa.Table, blocks: int) -> pa.Table:
    """(key, language, weight) of the languages that any word of a text has."""
    words, ids, size = B.words_of(texts)
    order = np.argsort(B.buckets_of_words(words, blocks), kind="stable")  # a bucket has its words in the same order
    answers = answers.take(pc.sort_indices(answers.column("asker")))
    word = np.repeat(order, B.flat_numbers(answers, "k"))
    language, weight = B.flat(answers.column("languages")).dictionary_encode("encode"), B.flat_numbers(answers, "weights")
    which, row, out = language.indices.to_numpy(zero_copy_only=False), np.repeat(np.arange(len(size)), size), []
    for k, name in enumerate(language.dictionary.to_pylist()):
        of_word = np.zeros(len(words))
        of_word[word[which == k]] = weight[which == k]
        sums = np.bincount(row, of_word[ids], len(size))
        at = np.flatnonzero(sums)
        out.append(pa.table({"key": texts.column("key").take(pa.array(at)), "language": pa.array([name] * len(at), pa.string()), "weight": pa.array(sums[at])}))
    return pa.concat_tables(out)


def identified_languages(docs: DataFrame, key: str, text: str, language: str, blocks: int, prior: float = 4.0) -> DataFrame:
    """(key, label, score) as ``models.identify_languages`` gives them by the profiles of the same documents."""
    k = blocks
    texts = B.in_blocks(docs, some(T.words(F.col(text))), k, key=F.col(key), language=F.col(language))
    pairs = B.dealt(B.each(texts, lambda me, t: pairs_asked(me, t, k), "to int, asker int, words array<string>, languages array<string>, n array<long>"), k)
    weights = B.dealt(B.each(pairs, lambda me, t: weights_told(me, t, prior), "to int, asker int, k array<int>, languages array<string>, weights array<double>"), k)
    kind = dict(docs.select(F.col(key).alias("key")).dtypes)["key"]
    rows = B.both(texts, weights, lambda me, t, a: texts_weighed(me, t, a, k), f"key {kind}, language string, weight double").where("key is not null")
    sums = rows.groupBy("key", "language").agg(F.sum("weight").alias("weight"))
    best = sums.groupBy(F.col("key").alias(key)).agg(F.max(F.struct(F.round("weight", 9).alias("weight"), "language")).alias("best"), F.sum("weight").alias("all"))
    return docs.select(key).join(best, key, "left").select(key, F.col("best.language").alias("label"), F.coalesce(F.round(F.col("best.weight") / F.col("all"), 6), F.lit(0.0)).alias("score"))
