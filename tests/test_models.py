"""The n-gram and language models against plain versions, and on rows that they have not seen."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioloom import queries
from folioloom.operators import filters
from folioloom.operators.filters import TextLimits
from folioloom.plans import languages, ngrams

DIR = "/root/testdata/sf0.001"
TEXTS = [
    "the cat sat on the mat", "the cat sat on the hat", "a dog sat", "the dog", "", "   ", None, "the the the the", "zebra", "a cat sat on a dog on the mat", "the cat sat on the mat",
]


def plain_model(texts):
    """Probability of w after (u, v), straight from the definition."""
    three = Counter()
    for t in texts:
        if t is not None:
            ws = [ngrams.BEGIN] * 2 + t.split() + [ngrams.END]
            three.update(zip(ws, ws[1:], ws[2:], strict=False))
    two, one = Counter((v, w) for _, v, w in three), Counter()
    one.update(w for _, w in two)

    def off(counts):
        n1, n2 = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
        return n1 / (n1 + 2 * n2) if n1 else 0.0

    d3, d2, d1 = off(three), off(two), off(one)
    following = defaultdict(Counter)
    for g, c in [*three.items(), *two.items()]:
        following[g[:-1]][g[-1]] = c
    total = sum(one.values())

    def p1(w):
        return max(one[w] - d1, 0) / total + d1 * len(one) / total / (len(one) + 1)

    def p2(v, w):
        f = following[(v,)]
        return max(f[w] - d2, 0) / f.total() + d2 * len(f) / f.total() * p1(w) if f else p1(w)

    def p3(u, v, w):
        f = following[(u, v)]
        return max(f[w] - d3, 0) / f.total() + d3 * len(f) / f.total() * p2(v, w) if f else p2(v, w)

    return p3, set(one)


def test_ngrams_like_a_plain_model(spark):
    seen, other = TEXTS, ["the cat sat on a zebra", "unknown words only", "mat the", "a cat", "", None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(seen + other)], "id long, text string")
    tokens = ngrams.tokens_of(F.col("text"))
    model = ngrams.train(docs.where(F.col("id") < len(seen)), tokens)
    p3, known = plain_model(seen)
    for k, t in enumerate(seen + other):
        got = ngrams.perplexity(docs.where(F.col("id") == k), "id", tokens, model).first().perplexity
        if t is None:
            assert got is None
            continue
        ws = [ngrams.BEGIN] * 2 + t.split() + [ngrams.END]
        logs = [math.log10(p3(*g)) for g in zip(ws, ws[1:], ws[2:], strict=False)]
        assert got == pytest.approx(10 ** (-sum(logs) / len(logs)), abs=0.051), t
    for context in [("the", "cat"), ("sat", "on"), ("nothing", "such"), (ngrams.BEGIN, ngrams.BEGIN)]:  # all that may follow, the unknown too, sum up to 1
        assert sum(p3(*context, w) for w in [*known, "never seen"]) == pytest.approx(1)


def test_ngrams_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, "a b"), (2, None)], "id long, text string")
    tokens = ngrams.tokens_of(F.col("text"))
    untrained = ngrams.train(docs.limit(0), tokens)
    assert ngrams.perplexity(docs.limit(0), "id", tokens, untrained).count() == 0
    got = {r.id: r.perplexity for r in ngrams.perplexity(docs, "id", tokens, untrained).collect()}
    assert got == {1: None, None: None, 2: None}
    assert spark.createDataFrame([(None,), (1500.0,), (1500.1,)], "p double").select(ngrams.perplexity_ok(F.col("p"))).collect() == [(False,), (True,), (False,)]


def test_ngrams_gather_nothing_and_split_contexts(spark):
    """Only one-row tables are broadcast by hint; contexts meet in equi-joins, which Spark splits where they are skewed."""
    docs = spark.range(10).select("id", F.lit("a b c").alias("text"))
    tokens = ngrams.tokens_of(F.col("text"))
    out = ngrams.perplexity(docs, "id", tokens, ngrams.train(docs, tokens))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = out._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" not in plan and "collect_" not in plan and "BroadcastHashJoin" not in plan
    assert plan.count("SortMergeJoin") >= 8 and "CartesianProduct" not in plan


def test_buckets_by_hand():
    points = [ord(c) for c in "ab"]
    want = [(points[0] * 31 + 7919) % 64, (points[1] * 31 + 7919) % 64, (points[0] * 31 + points[1] * 1009 + 2 * 7919) % 64]
    assert languages.buckets_of("ab", 64).tolist() == want and not len(languages.buckets_of("", 64))


def test_languages_on_unseen_rows(spark):
    """Every row is judged by a model without it: of at least 50 words, 97 in 100 are right at the limit of 0.8."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", F.size(F.split("text", " ")).alias("n"))
    got = queries.hashed_langid(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("n >= 50 and lang is not null")
    share = got.selectExpr("avg(cast(label = lang and score >= 0.8 as double)) s").first().s
    assert share > 0.97, share


def test_language_counts_like_plain_ones(spark):
    rows = [(1, "ab\nAB", "x"), (2, "ba", "y"), (3, None, "x"), (4, "zz", None), (5, "", "x"), (6, "ab", "x")]
    docs = spark.createDataFrame(rows, "id long, text string, lang string")
    counts = languages.bucket_counts(docs, "text", "lang", [], 32)
    want = Counter()
    for _, t, lang in rows:
        if t and lang:
            want.update((lang, b) for b in languages.buckets_of(t.lower().replace("\n", " "), 32).tolist())
    assert {(r.language, r.bucket): r.n for r in counts.collect()} == dict(want)
    model = languages.Languages(counts, 32)
    got = {r.id: tuple(r.prediction) for r in languages.predicted(docs, "text", {0: model}).collect()}
    assert got[3] == got[5] == (None, 0.0)
    logs = {}
    for lang in "xy":
        n = np.array([want[lang, b] for b in range(32)])
        logs[lang] = np.log((n + 1) / (n.sum() + 32))[languages.buckets_of("ba", 32)].mean()
    assert got[2] == (max(logs, key=logs.get), pytest.approx(1 / (1 + math.exp(-languages.SHARPNESS * abs(logs["x"] - logs["y"]))), abs=1e-6))
    nothing = languages.Languages(languages.bucket_counts(docs.limit(0), "text", "lang", [], 32), 32)
    assert nothing.score(["ab"]) == [(None, 0.0)]


def test_documents_go_by_language_and_perplexity(spark):
    """What the full filter keeps is what passes each check by itself."""
    kept = {r.doc_id for r in queries.doc_filter_full(spark, DIR).collect()}
    docs = spark.read.parquet(f"{DIR}/documents.parquet").join(queries.hashed_langid(spark, DIR), "doc_id").join(queries.ngram_perplexity(spark, DIR), "doc_id")
    limits = queries.MODEL_LIMITS
    others = TextLimits(**{**limits.__dict__, "language": None, "perplexity": None})
    rows = docs.where(filters.text_reason(F.col("text"), limits).isNull()).where(filters.scored_reason(F.col("text"), others).isNull())
    rows = rows.select("doc_id", "label", "score", "perplexity").collect()
    assert kept == {r.doc_id for r in rows if r.label == "en" and r.score >= 0.8 and r.perplexity <= 1500}
    assert 0 < len(kept) < len(rows)


def test_pieces(spark):
    """Pieces join to their text, as one perplexity over them is that of a plain model."""
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from folioloom.plans.models import pieces_of

    texts = ["The cat sat.", "the Cat, sat on cats", "", None, "Größe 😀 über", "x" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    cut = pieces_of(spark, str(public_tokenizers.path("piece_bpe_32k.model")))
    docs = docs.withColumn("pieces", cut(F.col("text")))
    got = {r.id: r.pieces for r in docs.collect()}
    assert got[3] is None and got[2] == []
    for k in (0, 1, 5):
        assert "".join(got[k]).replace("\u2581", " ").strip() == texts[k]
    p3, _ = plain_model([" ".join(p) for p in (got[0], got[1])])
    model = ngrams.train(docs.where("id < 2"), F.col("pieces"))
    for r in ngrams.perplexity(docs.where("id < 2"), "id", F.col("pieces"), model).collect():
        ws = [ngrams.BEGIN] * 2 + got[r.id] + [ngrams.END]
        logs = [math.log10(p3(*g)) for g in zip(ws, ws[1:], ws[2:], strict=False)]
        assert r.perplexity == pytest.approx(10 ** (-sum(logs) / len(logs)), abs=0.051)
