"""Language identification by hashed character n-grams: a naive Bayes model of few numbers, trained by summed counts.

A text's runs of one to three code points fall into buckets by a plain sum of products, so any engine can count the same.
Training adds up counts of (language, bucket) over batches of texts; the model is what was counted, ``buckets`` numbers a
language at most, and no language's share of a batch leaves a task but as these sums. Texts are scored where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .models import language_ok

__all__ = ["Languages", "bucket_counts", "buckets_of", "cross_predicted", "language_ok", "predicted"]

BUCKETS = 1 << 14
MOST_LANGUAGES = 256
SHARPNESS = 40.0
# Multipliers of the first, second and third code point of a run, and of its length.
FACTORS, BY_LENGTH = (31, 1009, 100003), 7919


def plain_line(t: Column) -> Column:
    return F.replace(F.lower(t), F.lit("\n"), F.lit(" "))


def buckets_of(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each run of one to three code points of a text."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    out, sums = [], np.zeros(len(points), np.int64)
    for n, factor in enumerate(FACTORS, 1):
        if len(points) < n:
            break
        sums = sums[: len(points) - n + 1] + points[n - 1 :] * factor
        out.append((sums + n * BY_LENGTH) % buckets)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def bucket_counts(docs: DataFrame, text: str, language: str, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(keys, language, bucket, n) over all texts that have a language."""
    rows = docs.where(F.col(language).isNotNull() & F.col(text).isNotNull()).select(*keys, F.col(language).alias("language"), plain_line(F.col(text)).alias("_text"))
    names = [*keys, "language"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = pa.Table.from_batches([batch]).to_pandas()
            for of, group in frame.groupby(names, sort=False):
                n = np.zeros(buckets, np.int64)
                for t in group["_text"]:
                    n += np.bincount(buckets_of(t, buckets), minlength=buckets)
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_pandas(pd.DataFrame(dict(zip(names, of, strict=True)) | {"bucket": at, "n": n[at]}), preserve_index=False)

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    counted = rows.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", bucket long, n long")
    return counted.groupBy(*names, "bucket").agg(F.sum("n").alias("n"))


class Languages:
    """Mean log-likelihoods by language as dense arrays of bounded size; add-one smoothing over buckets."""

    def __init__(self, counts: DataFrame, buckets: int = BUCKETS, sharpness: float = SHARPNESS):
        named = sorted(r[0] for r in counts.select("language").distinct().limit(MOST_LANGUAGES + 1).collect())
        if len(named) > MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
        table = np.zeros((len(named), buckets))
        place = {x: i for i, x in enumerate(named)}
        for r in counts.select("language", "bucket", "n").toLocalIterator():  # at most languages * buckets
            table[place[r[0]], r[1]] = r[2]
        self.named, self.sharpness, self.buckets = named, sharpness, buckets
        self.logs = np.log((table + 1) / (table.sum(1, keepdims=True) + buckets))

    def score(self, texts: list[str]) -> list[tuple[str | None, float]]:
        """(label, score): the likeliest language of each text, and its share of the sharpened likelihoods; None and 0 for an empty one."""
        out = []
        for t in texts:
            found = buckets_of(t, self.buckets)
            if not len(found) or not self.named:
                out.append((None, 0.0))
                continue
            kinds, times = np.unique(found, return_counts=True)
            means = self.logs[:, kinds] @ times / len(found)
            best = int(np.lexsort([np.arange(len(means)), -np.round(means, 9)])[0])
            out.append((self.named[best], round(float(1 / np.exp(self.sharpness * (means - means[best])).sum()), 6)))
        return out


def predicted(docs: DataFrame, text: str, models: dict[int, Languages], fold: Column | None = None) -> DataFrame:
    """``docs`` with ``prediction`` (label, score), by the model of each row's fold."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("label string, score double")
    def run(texts: pd.Series, folds: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"label": pd.Series([None] * len(texts), dtype=object), "score": 0.0})
        for k in folds.unique():
            mine = (folds == k).to_numpy()
            out.loc[mine] = shared.value[int(k)].score([t or "" for t in texts[mine]])
        return out

    return docs.withColumn("prediction", run(plain_line(F.col(text)), F.lit(0) if fold is None else fold))


def cross_predicted(docs: DataFrame, text: str, language: str, fold: Column, folds: int = 2, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with ``prediction``; every row is judged by a model of the rows of all other folds (0, 1, ...) alone."""
    marked = docs.withColumn("_fold", fold)
    counts = bucket_counts(marked, text, language, ["_fold"], buckets).persist()
    others = lambda k: counts.where(F.col("_fold") != k).groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    models = {k: Languages(others(k), buckets) for k in range(folds)}
    counts.unpersist()
    return predicted(marked, text, models, F.col("_fold")).drop("_fold")
