"""Golden cases of the text and address functions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioloom.functions import text as T
from folioloom.functions import urls as U
from folioloom.functions.constants import EOD
from folioloom.operators import clean, filters, stats
from folioloom.operators.filters import TextLimits
from folioloom.plans.models import tokenized


def value(spark, column, **inputs):
    row = spark.createDataFrame([tuple(inputs.values())], ", ".join(f"{k} string" for k in inputs))
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, expected", [("(hello!)", "hello"), ("!!!", ""), ("", ""), ("«naïve»", "naïve"), (None, None)]
)
def test_strip(spark, text, expected):
    assert value(spark, T.strip(F.col("t")), t=text) == expected


def test_words(spark):
    assert value(spark, T.words(F.col("t")), t="Hi  there,\tfriend\n42") == ["hi", "there", "friend"]


@pytest.mark.parametrize("text, expected", [("a" * 12, 1.0), ("abcdefghij", 0.0), ("abc", 0.0), ("ab" * 8, 4 / 7), ("", 0.0), (None, None)])
def test_char_repetition(spark, text, expected):
    got = value(spark, T.char_repetition_ratio(F.col("t")), t=text)
    assert got == (expected if expected is None else pytest.approx(expected))


def test_word_repetition(spark):
    assert value(spark, T.word_repetition_ratio(T.words(F.col("t"))), t="a b c d e a b c d e") == pytest.approx(2 / 6)


def test_special_ratio(spark):
    assert value(spark, T.special_ratio(F.col("t")), t="a b1") == 0.5
    assert value(spark, T.special_ratio(F.col("t")), t="") == 0.0


def test_punctuation_ratio(spark):
    assert value(spark, T.punctuation_ratio(F.col("t")), t="Hello, world.") == 0.5
    assert value(spark, T.punctuation_ratio(F.col("t"), least_tokens=12), t="Hello, world.") == 1.0


def test_normalize(spark):
    assert value(spark, T.normalize(F.col("t")), t="Größe 12") == "größe 00"


@pytest.mark.parametrize("size, expected", [("300px", "300"), ("50%", "50%"), ("12.7", "12"), ("auto", "100%"), ("abc", None), ('"40"', "40")])
def test_size_text(spark, size, expected):
    assert value(spark, U.size_text(F.col("t")), t=size) == expected


def test_addresses(spark):
    assert value(spark, U.netloc(F.col("t")), t="https://User:pw@Ex.com:8080/a") == "User:pw@Ex.com:8080"
    assert value(spark, U.readable_name(F.col("t")), t="https://e.com/a/Chocolate_Berry-104x403.jpg") == "Chocolate Berry"
    assert value(spark, U.absolute(F.lit("https://ex.com/p"), F.col("t")), t="../img/a.png") == "https://ex.com/img/a.png"
    assert value(spark, U.absolute(F.lit("https://ex.com/p"), F.col("t")), t="//cdn.x.com/a.png") == "http://cdn.x.com/a.png"
    assert value(spark, U.is_valid(F.col("t")), t="https://ex.com/a b") is False


def test_image_sizes(spark):
    rows = spark.createDataFrame([(150, 300), (150, 301), (149, 149)], "w int, h int")
    none = F.lit(None).cast("int")
    assert [r.ok for r in rows.select(filters.image_size_ok(F.col("w"), F.col("h"), none, none).alias("ok")).collect()] == [True, False, False]
    assert value(spark, filters.rendered(F.col("t"), F.lit(401)), t="50%") == 200


def test_sentinels(spark):
    assert value(spark, clean.collapse_sentinels(F.col("t")), t=f"x\n\n{EOD}\n\n{EOD} \n\ny") == f"x\n\n{EOD}\n\ny"
    assert value(spark, clean.strip_last_sentinel(F.col("t")), t=f"x\n\n{EOD}") == "x"
    assert value(spark, clean.without_spam_paragraphs(F.col("t")), t="click share now please\n\n\n\nplain words are fine") == "\n\nplain words are fine"
    arrays = spark.createDataFrame([([EOD],), ([],), (["a", EOD],)], "t array<string>")
    assert [r.k for r in arrays.select(filters.not_only_sentinels(F.col("t")).alias("k")).collect()] == [False, False, True]


def test_paragraph_filter_keeps_sentinels_and_nulls(spark):
    limits = filters.TextLimits(stopwords=None, common=None, flagged=None)
    rows = spark.createDataFrame([(1, f"one two three four five\n\nx\n\n{EOD}"), (2, "x"), (3, None), (4, "")], "id long, text string")
    got = {r.id: r.text for r in filters.filter_paragraphs(rows, limits).collect()}
    assert got == {1: f"one two three four five\n\n{EOD}", 2: None, 3: None, 4: None}


def test_words_keep_what_is_inside(spark):
    text = "  (It's)\u00a0x  --- «été»-fin, a1b 3d4 \U0001f600ok\U0001f600 A\x00 ÷ø Øre x\u3000y"
    plain = [w for w in (v.strip(T.SPECIAL_CHARACTERS) for v in text.lower().replace("\t", " ").replace("\n", " ").split(" ")) if w]
    assert value(spark, T.words(F.col("t")), t=text) == plain
    assert value(spark, T.words(F.col("t"), lower=False, strip_class="."), t="..A.b. . C") == ["A.b", "C"]


def test_runs_are_equal_where_their_items_are():
    rng = np.random.default_rng(3)
    for kinds, n in ((2, 10), (90, 10), (5000, 5), (70_000, 7), (3, 1)):
        ids = rng.integers(kinds, size=400)
        ids[200:300] = ids[50:150]
        runs = T.runs_of(ids, n)
        plain = [tuple(ids[k : k + n]) for k in range(len(ids) - n + 1)]
        assert len(runs) == len(plain)
        assert len(set(zip(runs.tolist(), plain, strict=True))) == len(set(plain)) == len(set(runs.tolist()))


@pytest.mark.parametrize(
    "url,name",
    [
        ("https://a.b/c/blue_car-640x480.jpg", "blue car"), ("https://a.b/12x34x5__red%20%202fox.png", "x red fox"), ("https://a.b/pic?id=3", ""),
        ("https://a.b/x.jpg", ""), ("https://a.b/a%Bb+c%.webp", "a b c"), ("https://a.b/cat5x5dog.tar.gz", "catdog"), ("https://a.b/", ""),
    ],
)
def test_readable_names(spark, url, name):
    assert value(spark, U.readable_name(F.col("t")), t=url) == name


def test_tokenized_statistics_and_samples(spark):
    rows = spark.createDataFrame([(1, "a b, a b"), (2, None), (3, ""), (4, "Hi...")], "id long, text string")
    pieces = tokenized(lambda texts: [[t[k : k + 2] for k in range(0, len(t), 2)] for t in texts])
    assert [r[0] for r in rows.orderBy("id").select(pieces(F.col("text"))).collect()] == ["a  b,  a  b", None, "", "Hi .. ."]
    found = {r.id: r for r in stats.text_statistics(rows, ["id"], "text", TextLimits(stopword_list=["a"])).collect()}
    assert (found[1].n_words, found[1].stopword_ratio, found[4].special_ratio, found[3].n_words) == (4, 0.5, 0.6, 0)
    assert found[2].n_words is found[2].special_ratio is found[2].char_repetition is None
    many = spark.range(4000)
    assert stats.sampled(many, "id", 0).count() == 0 and stats.sampled(many, "id", 1).count() == 4000
    part = {r.id for r in stats.sampled(many, "id", 0.25).collect()}
    assert 850 < len(part) < 1150 and part == {r.id for r in stats.sampled(many.repartition(7), "id", 0.25).collect()}
    assert part < {r.id for r in stats.sampled(many, "id", 0.5).collect()}
