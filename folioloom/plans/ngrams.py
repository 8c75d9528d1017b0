"""An n-gram language model of order 3 as tables: interpolated Kneser-Ney, trained by grouped counts, applied by joins.

Counts of longer runs are partial sums, those of shorter ones the number of their different left neighbours. Probabilities
and what a context leaves for shorter ones are joined on contexts; a context with very many continuations is a skewed key
of an equi-join, which Spark splits. No table of the model is collected, broadcast by hint or held in a task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Before the first and after the last token; normalized texts have no control characters.
BEGIN, END = "\x02", "\x03"


def tokens_of(t: Column) -> Column:
    """A normalized text, its case kept, split at spaces."""
    return F.filter(F.split(T.normalize(t, lower=False), " "), lambda w: w != "")


def runs(docs: DataFrame, keys: list[str], tokens: Column) -> DataFrame:
    """(keys, u, v, w): every token and the end of a text with the two tokens before it; none for a null text."""
    padded = F.concat(F.array(F.lit(BEGIN), F.lit(BEGIN)), tokens, F.array(F.lit(END)))
    rows = docs.select(*keys, padded.alias("_padded")).where("_padded is not null")
    three = F.transform(F.sequence(F.lit(2), F.size("_padded") - 1), lambda k: F.struct(F.get("_padded", k - 2).alias("u"), F.get("_padded", k - 1).alias("v"), F.get("_padded", k).alias("w")))
    return rows.select(*keys, F.explode(three).alias("_r")).select(*keys, "_r.*")


@dataclass
class Model:
    """Probabilities by run, what contexts leave for shorter ones, and (one row) the probability of an unknown token."""

    triples: DataFrame  # u, v, w, p
    pairs: DataFrame  # v, w, p
    words: DataFrame  # w, p
    left_after_two: DataFrame  # u, v, left
    left_after_one: DataFrame  # v, left
    unknown: DataFrame  # p


def discount(counts: DataFrame, n: str) -> DataFrame:
    """One row: n1 / (n1 + 2 n2) of the runs that were counted once and twice; 0 if none was counted once."""
    once, twice = F.count_if(F.col(n) == 1), F.count_if(F.col(n) == 2)
    return counts.agg(F.when(once > 0, once / (once + 2 * twice)).otherwise(0.0).alias("d"))


def interpolated(counts: DataFrame, n: str, context: list[str], shorter: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Probabilities of the counted runs, and (context, left): discounted shares, and the rest dealt out by ``shorter`` (on, p)."""
    d = F.broadcast(discount(counts, n))  # one row
    sums = counts.groupBy(*context).agg(F.sum(n).alias("_total"), F.count("*").alias("_kinds")).crossJoin(d)
    sums = sums.select(*context, "_total", "d", (F.col("d") * F.col("_kinds") / F.col("_total")).alias("left"))
    share = F.greatest(F.col(n) - F.col("d"), F.lit(0.0)) / F.col("_total")
    rows = counts.join(sums, context).join(shorter.withColumnRenamed("p", "_shorter"), on)
    return rows.select(*counts.columns[:-1], (share + F.col("left") * F.col("_shorter")).alias("p")), sums.select(*context, "left")


def train(docs: DataFrame, tokens: Column) -> Model:
    """A model of all texts of ``docs``."""
    triples = runs(docs, [], tokens).groupBy("u", "v", "w").agg(F.count("*").alias("n"))
    pairs = triples.groupBy("v", "w").agg(F.count("*").alias("n"))
    words = pairs.groupBy("w").agg(F.count("*").alias("n"))
    whole = words.agg(F.sum("n").alias("total"), F.count("*").alias("kinds")).crossJoin(F.broadcast(discount(words, "n")))
    unknown = whole.select("total", "d", (F.col("d") * F.col("kinds") / F.col("total") / (F.col("kinds") + 1)).alias("unknown"))
    known = words.crossJoin(F.broadcast(unknown))  # one row
    word_p = known.select("w", (F.greatest(F.col("n") - F.col("d"), F.lit(0.0)) / F.col("total") + F.col("unknown")).alias("p"))
    pair_p, after_one = interpolated(pairs, "n", ["v"], word_p, ["w"])
    triple_p, after_two = interpolated(triples, "n", ["u", "v"], pair_p, ["v", "w"])
    return Model(triple_p, pair_p, word_p, after_two, after_one, unknown.select(F.col("unknown").alias("p")))


def log_probabilities(kinds: DataFrame, model: Model) -> DataFrame:
    """(u, v, w, lp) of different runs: log10 of the longest known run's probability, through what its contexts leave."""
    seen = kinds.join(model.triples, ["u", "v", "w"]).select("u", "v", "w", "p")
    new = kinds.join(model.triples, ["u", "v", "w"], "left_anti")
    name = lambda df, new_name: df.withColumnRenamed("p", new_name).withColumnRenamed("left", new_name)
    new = new.join(name(model.pairs, "p2"), ["v", "w"], "left").join(name(model.words, "p1"), "w", "left").join(name(model.left_after_two, "l2"), ["u", "v"], "left")
    new = new.join(name(model.left_after_one, "l1"), "v", "left").crossJoin(F.broadcast(name(model.unknown, "p0")))  # one row
    one = F.coalesce("p1", "p0")
    two = F.coalesce(F.col("p2"), F.coalesce("l1", F.lit(1.0)) * one)
    new = new.select("u", "v", "w", (F.coalesce("l2", F.lit(1.0)) * two).alias("p"))
    return seen.unionByName(new).select("u", "v", "w", F.log10("p").alias("lp"))


def perplexity(docs: DataFrame, key: str, tokens: Column, model: Model) -> DataFrame:
    """(key, perplexity): 10 ** -(mean log10 probability of the tokens and the end), one place; null for a null text or key.

    An unseen context leaves all to the shorter one. A text without tokens is its end alone.
    """
    rows = runs(docs.where(F.col(key).isNotNull()), [key], tokens).groupBy(key, "u", "v", "w").agg(F.count("*").alias("times"))
    logs = log_probabilities(rows.select("u", "v", "w").distinct(), model)
    sums = rows.join(logs, ["u", "v", "w"]).groupBy(key).agg(F.sum(F.col("times") * F.col("lp")).alias("_lp"), F.sum("times").alias("_n"))
    scores = sums.select(key, F.round(F.pow(F.lit(10.0), -F.col("_lp") / F.col("_n")), 1).alias("perplexity"))
    return docs.select(key).join(scores, key, "left")


def perplexity_ok(perplexity: Column, most: float = 1500) -> Column:
    """Not above the limit; a text without a perplexity is."""
    return F.coalesce(perplexity <= most, F.lit(False))
