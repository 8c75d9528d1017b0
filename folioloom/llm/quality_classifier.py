"""Quality classifier: random Fourier features, ridge regression from summed normal equations, isotonic calibration.

Statistics of every whole text are computed once. Cosine features of the standardised statistics approximate a
Gaussian kernel; each partition of the labelled rows adds up its own normal equations, their sums (a fixed number of
values, whatever the input) give the ridge weights, and pool-adjacent-violators over a fixed grid of raw scores, on a
fold of the labelled rows that the weights have not seen, turns them into probabilities.

All sums are of whole numbers (statistics and features are rounded to binary fractions), and a row's score is computed
from that row alone, so scores are the same bits whatever the partitions and the order of rows.

Labels are learned only from rows whose ``crc32(doc_id as text) mod 5`` is not 0: the weights from 1 to 3, the calibration
from 4 (from all of these where either is without rows). Defined results: a null text counts as an empty one; repeated rows
are scored each, and learned from each; a null doc_id is never held out nor learned from; ties in scores share a
probability; without usable labels every score is 1; an empty table gives an empty result; columns other than doc_id and
text, whatever their names, are ignored (``keep`` returns them).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, map_rows
from .docstats import NAMES, statistics

GRID = 1024
STEP, UNIT = 2.0**-20, 2.0**-18  # of statistics and of features, which are summed as whole numbers
ONE = 1 << 15  # the constant feature and a label of 1, in units


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    knots: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        """Cosine features and a constant, in whole units. No sum runs over rows, nor in an order that depends on their number."""
        at = np.tile(self.phases, (len(x), 1))
        for value, wave in zip(np.clip((x - self.mean) / self.scale, -8, 8).T, self.waves, strict=True):
            at += value[:, None] * wave
        z = np.rint(np.cos(at) * (np.sqrt(2 / len(self.phases)) / UNIT))
        return np.hstack([z, np.full((len(x), 1), float(ONE))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((self.features(x) * self.weights).sum(1), 0, 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.ones(len(x)) if self.knots is None else np.interp(self.raw(x), *self.knots)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 5


def document_features(docs: DataFrame) -> DataFrame:
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    return map_rows(docs, ["doc_id", "text"], lambda ids, texts: ((i, statistics(t)[1]) for i, t in zip(ids, texts, strict=True)), schema)


def isotonic(at: np.ndarray, total: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators; knots at the blocks' mean positions."""
    blocks: list[list[float]] = []
    for a, n, s in zip(at, total, hits, strict=True):
        blocks.append([a * n, n, s])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 1], (b[:, 2] + 0.0) / b[:, 1]


def fit(features: DataFrame, labels: DataFrame, waves: int = 192, width: float = 4.0, ridge: float = 1e-3, seed: int = 7) -> Model | None:
    """A model of ``labels.quality`` from the labelled rows of ``features`` (doc_id, x) that are not held out."""
    known = labels.where("doc_id is not null and quality is not null").select("doc_id", F.col("quality").cast("int").alias("y"))
    rows = features.where(~held_out()).join(known, "doc_id").select("x", "y", (fold() == 4).alias("later"))
    k = len(NAMES)
    whole = [F.round(F.col("x")[i] / STEP).cast("decimal(38,0)") for i in range(k)]
    sums = rows.groupBy("later").agg(F.count("y").alias("n"), *(F.sum(q) for q in whole), *(F.sum(q.cast("decimal(19,0)") * q.cast("decimal(19,0)")) for q in whole)).collect()
    sums = {r.later: r for r in sums}
    if not sums:
        return None
    first, last = (rows.where(~F.col("later")), rows.where("later")) if len(sums) == 2 else (rows, rows)
    row = sums[False] if len(sums) == 2 else next(iter(sums.values()))
    n = row.n
    mean = [int(v) / n for v in row[2 : k + 2]]
    spread = [max(0.0, (int(q) - int(v) * int(v) / n) / n) ** 0.5 for v, q in zip(row[2 : k + 2], row[k + 2 :], strict=True)]
    rng = np.random.default_rng(seed)
    model = Model(np.array(mean) * STEP, np.maximum(np.array(spread) * STEP, 1e-6), rng.normal(size=(k, waves)) / width, rng.uniform(0, 2 * np.pi, waves))
    upper = np.triu_indices(waves + 1, 0, waves + 2)

    def equations(frames):
        a = np.zeros((waves + 1, waves + 2), np.int64)
        for frame in frames:
            for lo in range(0, len(frame), 4096):  # sums of that many products below 2**31 are exact as doubles
                part = frame.iloc[lo : lo + 4096]
                z = model.features(np.stack(part["x"].to_numpy()))
                a += (z.T @ np.hstack([z, part["y"].to_numpy()[:, None] * float(ONE)])).astype(np.int64)
        yield pd.DataFrame({"i": upper[0], "j": upper[1], "v": a[upper]})

    made = first.select("x", "y").mapInPandas(equations, "i int, j int, v long").groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    a = np.zeros((waves + 1, waves + 2))
    for r in made:  # half of a symmetric matrix, and the right side
        a[r.i, r.j] = float(r.v)
        if r.j <= waves:
            a[r.j, r.i] = float(r.v)
    a *= UNIT * UNIT
    # Weights of features in units; the label's one is ONE units, too.
    model.weights = np.linalg.solve(a[:, :-1] + ridge * n / waves * np.eye(len(a)), a[:, -1]) / ONE

    def cells(frames):
        for frame in frames:
            if len(frame):
                cell = np.rint(model.raw(np.stack(frame["x"].to_numpy())) * GRID).astype(int)
                yield pd.DataFrame({"cell": cell, "y": frame["y"]})

    grid = last.select("x", "y").mapInPandas(cells, "cell int, y int").groupBy("cell").agg(F.count("y").alias("n"), F.sum("y").alias("hits")).orderBy("cell").collect()
    model.knots = isotonic(*(np.array([r[j] for r in grid], float) / (GRID if j == 0 else 1) for j in range(3)))
    return model


def score(features: DataFrame, model: Model | None, threshold: float = 0.3) -> DataFrame:
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])

    def run(ids, x):
        yield from zip(ids, (model.score(np.array(x)) if model else np.ones(len(ids))).tolist(), strict=True)

    out = map_rows(features, ["doc_id", "x"], run, schema)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    features = cut(document_features(docs))
    return score(features, fit(features, labels), threshold)


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, bound: int = 20_000) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``threshold``, with all their columns.

    Fitted on at most ``bound`` labelled documents, those whose ids hash lowest, so that the statistics of the others are
    computed once only.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out())
    sample = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id")), "doc_id")  # at most ``bound`` ids
    chosen = chosen.groupBy("doc_id").agg(F.min("text").alias("text"))
    model = fit(cut(document_features(chosen)), sample)
    if model is None:
        return docs

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        # In slices: the features of a whole batch, and its texts as Python objects, would take most of a worker's memory.
        slices = (texts.slice(lo, 512).to_pylist() for lo in range(0, len(texts), 512))
        return pa.array(np.concatenate([np.empty(0), *(model.score(np.array([statistics(t)[1] for t in part])) for part in slices)]))

    return docs.where(scores("text") >= threshold)
