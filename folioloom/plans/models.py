"""Models behind small interfaces: language, perplexity, image and opt-out services, with plain versions trained here."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.calls import Bucket, in_flight, tried


class LanguageModel(Protocol):
    def score(self, texts: list[str]) -> list[tuple[str, float]]: ...


def language_column(model: LanguageModel) -> Callable[[Column], Column]:
    """struct(label, score) of lower-cased one-line texts, in Arrow batches."""

    @F.pandas_udf("label string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model.score([(t or "").lower().replace("\n", " ") for t in texts]), columns=["label", "score"])

    return lambda t: run(t)


def language_ok(prediction: Column, target: str = "en", least: float = 0.8) -> Column:
    return (prediction["label"] == target) & (prediction["score"] >= least)


def tokenized(pieces: Callable[[list[str]], list[list[str]]]) -> Callable[[Column], Column]:
    """Texts as their subword pieces joined by spaces, by a tokenizer that takes a batch of texts; null for null texts."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        known = texts.notna()
        out = pd.Series([None] * len(texts), dtype=object)
        out[known.to_numpy()] = [" ".join(found) for found in pieces(list(texts[known]))]
        return out

    return lambda t: run(t)


def pieces_of(spark: SparkSession, vocabulary: str) -> Callable[[Column], Column]:
    """Texts as arrays of subword pieces of a vocabulary file; null for null texts.

    The file (at most some MB) is read once by the driver and handed to the tasks; a worker builds its segmenter once and
    remembers nothing of the texts.
    """
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    @F.arrow_udf("array<string>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import sentencepiece

        segmenter, kind = sentencepiece.SentencePieceProcessor(model_proto=shared.value), pa.list_(pa.string())
        for texts in batches:  # the pieces of a few texts at once are Python objects
            few = (texts.slice(lo, 32).to_pylist() for lo in range(0, len(texts), 32))
            yield pa.concat_arrays([pa.array([], kind), *(pa.array([None if t is None else segmenter.encode_as_pieces(t) for t in ts], kind) for ts in few)])

    return lambda t: run(t)


def word_profiles(docs: DataFrame, text: str, language: str, prior: float = 4.0) -> DataFrame:
    """(word, language, weight): the share of a word's occurrences in each language, less for rare words by ``prior`` more of no language."""
    rows = docs.select(F.col(language).alias("language"), F.explode(T.words(F.col(text))).alias("word"))
    counts = rows.groupBy("word", "language").agg(F.count("*").alias("n"))
    totals = counts.groupBy("word").agg(F.sum("n").alias("total"))
    return counts.join(totals, "word").select("word", "language", (F.col("n") / (F.col("total") + prior)).alias("weight"))


def identify_languages(docs: DataFrame, key: str, text: str, profiles: DataFrame) -> DataFrame:
    """(key, label, score): the language with the most weight over a text's words, and its share; null and 0 without words."""
    rows = docs.select(key, F.explode(T.words(F.col(text))).alias("word")).groupBy(key, "word").agg(F.count("*").alias("times"))
    sums = rows.join(profiles, "word").groupBy(key, "language").agg(F.sum(F.col("times") * F.col("weight")).alias("weight"))
    best = sums.groupBy(key).agg(F.max(F.struct(F.round("weight", 9).alias("weight"), "language")).alias("best"), F.sum("weight").alias("all"))
    return docs.select(key).join(best, key, "left").select(key, F.col("best.language").alias("label"), F.coalesce(F.round(F.col("best.weight") / F.col("all"), 6), F.lit(0.0)).alias("score"))


def unigram_perplexity(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, perplexity) under add-one unigram counts of the corpus: 10 ** -(mean log10 probability), one place; null without words."""
    rows = docs.select(key, F.explode(T.words(T.normalize(F.col(text)))).alias("word")).groupBy(key, "word").agg(F.count("*").alias("times"))
    counts = rows.groupBy("word").agg(F.sum("times").alias("n"))
    size = counts.agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    logs = counts.crossJoin(F.broadcast(size)).select("word", F.log10((F.col("n") + 1) / (F.col("total") + F.col("kinds"))).alias("lp"))  # one row
    sums = rows.join(logs, "word").groupBy(key).agg(F.sum(F.col("times") * F.col("lp")).alias("lp"), F.sum("times").alias("n"))
    scores = sums.select(key, F.round(F.pow(F.lit(10.0), -F.col("lp") / (F.col("n") + 1)), 1).alias("perplexity"))
    return docs.select(key).join(scores, key, "left")


class OptOutClient(Protocol):
    """Asks a service about addresses; used by several threads, one is made per partition."""

    def opted_out(self, urls: list[str]) -> list[bool]: ...


# Fixed value: seconds to wait after each failed call.
CALL_WAITS = [1] * 5 + [10] * 5 + [600] * 10 + [3600] * 10


def opted_out(
    urls: DataFrame, client: Callable[[], OptOutClient], per_call: int = 1000, calls_a_second: float = 20, at_once: int = 10, tasks: int = 4,
    waits: Sequence[float] = CALL_WAITS, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """The different urls that a service flags, asked in calls of ``per_call``; a last call of one url is padded.

    ``tasks`` tasks share the rate and the calls in flight evenly, so the service sees no more than given, however many
    executors there are. A call that fails is made again after each of ``waits``; its last failure fails the job.
    """
    tasks = max(1, min(tasks, at_once))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        service, bucket = client(), Bucket(calls_a_second / tasks, 1, clock, sleep)

        def ask(asked: list[str]) -> list[bool]:
            def once() -> list[bool]:
                bucket.take()
                flags = service.opted_out([*asked, ""] if len(asked) == 1 else asked)
                if len(flags) < len(asked):
                    raise ValueError(f"{len(flags)} answers to {len(asked)} addresses")
                return flags[: len(asked)]

            return tried(once, waits, sleep)

        def calls() -> Iterator[list[str]]:
            held: list[str] = []
            for batch in batches:
                held += batch.column(0).to_pylist()
                while len(held) >= per_call:
                    yield held[:per_call]
                    held = held[per_call:]
            if held:
                yield held

        for asked, flags in in_flight(ask, calls(), max(1, at_once // tasks)):
            yield pa.RecordBatch.from_pydict({"url": pa.array([u for u, f in zip(asked, flags, strict=True) if f], pa.string())})

    return urls.select("url").where("url is not null").distinct().repartition(tasks).mapInArrow(run, "url string")
