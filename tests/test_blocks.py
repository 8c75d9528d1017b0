"""Models over blocks of texts give what the models by rows give, and shuffle no row per occurrence."""

import pytest
from pyspark.sql import functions as F

from folioloom import queries
from folioloom.plans import models, ngram_blocks, ngrams, word_blocks

TEXTS = ["the cat sat on the mat", "The cat sat on the hat", "a dog sat", "the dog\n\x1fsat", "", "   ", None, "the the the the", "zebra", "ein Hund saß da", "the cat sat on the mat"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, [None, "en", "de"][k % 3]) for k, t in enumerate(TEXTS)] + [(None, "the cat", "en"), (1, "a second text", "en")]
    return spark.createDataFrame(rows, "id long, text string, lang string").repartition(3)


def rows_of(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("blocks", [1, 5])
def test_ngrams_in_blocks(docs, blocks):
    tokens = ngrams.tokens_of(F.col("text"))
    for trained in ("lang = 'en'", "true"):
        want = ngrams.perplexity(docs, "id", tokens, ngrams.train(docs.where(trained), tokens))
        assert rows_of(ngram_blocks.perplexity(docs, "id", tokens, F.expr(trained), blocks)) == rows_of(want)
    nothing = ngram_blocks.perplexity(docs, "id", tokens, F.lit(False), blocks)
    assert {r.perplexity for r in nothing.collect()} == {None} and nothing.count() == len(TEXTS) + 2
    assert ngram_blocks.perplexity(docs.limit(0), "id", tokens, F.lit(True), blocks).count() == 0


def test_many_words_in_a_block(spark):
    """Runs of words whose numbers don't fit into one number together."""
    docs = spark.range(3000).select("id", F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(800)), lambda k: F.conv(F.col("id") * 700 + k, 10, 36))).alias("text"))
    tokens = F.split("text", " ")
    out = ngram_blocks.perplexity(docs, "id", tokens, F.col("id") >= 0, 1).agg(F.count("perplexity"), F.countDistinct("perplexity")).first()
    assert out[0] == 3000 and out[1] > 1


@pytest.mark.parametrize("blocks", [1, 5])
def test_words_in_blocks(docs, blocks):
    assert rows_of(word_blocks.unigram_perplexity(docs, "id", "text", blocks)) == rows_of(models.unigram_perplexity(docs, "id", "text"))
    want = models.identify_languages(docs, "id", "text", models.word_profiles(docs, "text", "lang"))
    assert rows_of(word_blocks.identified_languages(docs, "id", "text", "lang", blocks)) == rows_of(want)
    none = docs.limit(0)
    assert word_blocks.unigram_perplexity(none, "id", "text", 2).count() == word_blocks.identified_languages(none, "id", "text", "lang", 2).count() == 0


@pytest.mark.parametrize("name", ["ngram_perplexity", "piece_perplexity", "doc_filter_full", "perplexity", "langid"])
def test_no_row_per_occurrence(spark, name):
    """Words and runs are neither exploded nor joined as rows."""
    plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert "Generate" not in plan and plan.count("Join") <= 8
