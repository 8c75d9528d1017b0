"""Quality rules: gradient-boosted trees over document statistics.

The trees are fitted on a bounded sample of labelled documents (``bound`` rows, by default 10,000: those whose ids
hash lowest), kept as flat numpy node arrays and scored level by level for a whole batch at once. Chosen statistics
have a monotonic effect: more symbols, repeats, bangs, bars or duplicate lines never raise a document's score.

Defined results: a null text is scored as an empty one (no words, base_failed, not kept); repeated rows are scored
each; without labels (or with one class only) the base rules alone decide; an empty table gives an empty result;
columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_rows
from .docstats import NAMES, statistics

FALLING = {"symbol_share", "dup_line_share", "repeat_share", "bang_share", "bar_share"}
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()), T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("score", T.DoubleType()),
])


@dataclass
class Forest:
    """Complete binary trees of one depth: node k has children 2k+1 and 2k+2; leaves follow the inner nodes."""

    feature: np.ndarray  # (trees, inner)
    threshold: np.ndarray  # (trees, inner); a row goes right when its value is above
    value: np.ndarray  # (trees, leaves)
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(inner.bit_length()):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - inner]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def boost(x: np.ndarray, y: np.ndarray, falling: list[int], trees: int = 40, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> Forest:
    """Second-order boosting of logistic loss over quantile histograms."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="higher")) for c in x.T]
    codes = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)  # code > k means value > edge k
    inner = 2**depth - 1
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    forest = Forest(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), float(np.log(mean / (1 - mean))))
    margin = np.full(len(x), forest.start)
    sign = np.zeros(x.shape[1])
    sign[falling] = -1
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(x), np.int64)
        limits = {0: (-np.inf, np.inf)}
        for k in range(inner):
            low, high = limits[k]
            at = np.flatnonzero(node == k)
            best, split = 1e-6, None
            weight = lambda a, b: np.clip(a / (b + ridge), low, high)  # noqa: B023, E731
            gain = lambda a, b, w: 2 * a * w - (b + ridge) * w * w
            for f in range(x.shape[1]) if len(at) > 1 else ():
                m = len(edges[f])
                gl = np.cumsum(np.bincount(codes[at, f], g[at], m + 1))
                hl = np.cumsum(np.bincount(codes[at, f], h[at], m + 1))
                gr, hr = gl[-1] - gl[:-1], hl[-1] - hl[:-1]
                gt, ht, gl, hl = gl[-1], hl[-1], gl[:-1], hl[:-1]
                if not m:
                    continue
                wl, wr = weight(gl, hl), weight(gr, hr)
                value = gain(gl, hl, wl) + gain(gr, hr, wr) - gain(gt, ht, weight(gt, ht))
                value[(sign[f] * (wr - wl) < 0) | (hl < 0.1) | (hr < 0.1)] = -1
                if value.max() > best:
                    best, c = value.max(), int(value.argmax())
                    split = f, c, (wl[c] + wr[c]) / 2
            left = right = (low, high)
            if split:
                f, c, middle = split
                forest.feature[t, k], forest.threshold[t, k] = f, edges[f][c]
                if sign[f] < 0:
                    left, right = (middle, high), (low, middle)
            limits[2 * k + 1], limits[2 * k + 2] = left, right
            node[at] = 2 * k + 1 + (x[at, forest.feature[t, k]] > forest.threshold[t, k])
        for leaf in range(inner + 1):
            at = node == inner + leaf
            low, high = limits[inner + leaf]
            forest.value[t, leaf] = rate * np.clip(g[at].sum() / (h[at].sum() + ridge), low, high)
        margin += forest.value[t, node - inner]
    return forest


def fit(docs: DataFrame, labels: DataFrame, bound: int = 10_000, falling: set[str] = FALLING, **how) -> Forest | None:
    """Trees for ``labels.quality``, from at most ``bound`` labelled documents."""
    key = F.xxhash64("doc_id")
    sample = (
        labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(key, "doc_id").limit(bound)
    )
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most ``bound`` ids
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("quality").alias("quality"))
    schema = T.StructType([T.StructField("quality", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    rows = map_rows(texts, ["quality", "text"], lambda q, t: ((a, statistics(b)[1]) for a, b in zip(q, t, strict=True)), schema).collect()
    y = np.array([r.quality for r in rows], float)
    if len(rows) < 2 or y.min() == y.max():
        return None
    x = np.array([r.x for r in rows])
    order = np.lexsort([*x.T, y])  # the same trees in whatever order the rows arrive
    return boost(x[order], y[order], [NAMES.index(n) for n in sorted(falling)], **how)


def apply(docs: DataFrame, forest: Forest | None, threshold: float = 0.5, least_words: int = 20, most_repeated: int = 30) -> DataFrame:
    """One row per row of ``docs``: the base counts, base_failed, the trees' score and kept."""

    def score(ids, texts):
        found = [statistics(t) for t in texts]
        p = forest.probability(np.array([x for _, x in found])) if forest else np.ones(len(found))
        for i, (base, _), s in zip(ids, found, p.tolist(), strict=True):
            failed = base[0] < least_words or 100 * base[4] > most_repeated * base[0]
            yield i, *base, failed, not failed and s >= threshold, s

    return map_rows(docs, ["doc_id", "text"], score, SCHEMA)
