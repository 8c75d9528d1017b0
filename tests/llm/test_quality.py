"""Quality rules and the quality classifier."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from folioloom.llm import docstats, quality_classifier, quality_rules

from .helpers import ROWS, as_set, clashing, documents, labels

DIR = "/root/testdata/sf0.01"


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(k, k + 8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


@pytest.mark.parametrize("row", ROWS, ids=str)
def test_base_counts(row):
    text = row[1] if row[1] is None else row[1][:30000]
    assert docstats.statistics(text)[0] == base(text)


def test_base_counts_of_random_repeats():
    rng = np.random.default_rng(1)
    for _ in range(200):
        text = " ".join(rng.choice(list("ab"), rng.integers(0, 60)))
        assert docstats.statistics(text)[0] == base(text)


def test_rules_on_awkward_rows(spark):
    docs = documents(spark)
    forest = quality_rules.fit(docs, labels(spark))
    got = quality_rules.apply(docs, forest)
    assert got.count() == len(ROWS)
    by = {r.doc_id: r for r in got.collect()}
    assert by[5].base_failed and not by[5].kept and by[5].n_words == 0
    assert as_set(quality_rules.apply(clashing(docs), forest)) == as_set(got)
    assert quality_rules.apply(docs.limit(0), forest).count() == 0
    without = {r.doc_id: r for r in quality_rules.apply(docs, None).collect()}
    assert without[1].base_failed is False and without[1].kept is True
    assert quality_rules.fit(docs, labels(spark).limit(0)) is None


def test_trees_are_monotonic():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 3))
    y = (x[:, 0] + np.sin(3 * x[:, 1]) + rng.normal(size=2000) < 0).astype(float)
    forest = quality_rules.boost(x, y, falling=[0], trees=30)
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.75
    for row in x[:50]:
        line = np.repeat(row[None], 60, 0)
        line[:, 0] = np.linspace(-4, 4, 60)
        assert (np.diff(forest.margin(line)) <= 1e-9).all()


def test_rules_on_whole_table(spark):
    docs, known = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.apply(docs, quality_rules.fit(docs, known)).join(known, "doc_id").toPandas()
    rest = got[~got.base_failed]
    assert (rest.kept == (rest.quality == 1)).mean() > 0.97


def test_classifier_on_whole_table(spark):
    docs, known = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.classify(docs, known).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    test = got.merge(known.toPandas(), on="doc_id")
    test = test[test.held_out]
    assert (test.predicted == test.quality).mean() > 0.95


def test_classifier_against_dense_fit(spark):
    """The same scores from whole matrices: features, ridge solution, isotonic steps."""
    docs, known = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_classifier.fit(quality_classifier.document_features(docs), known)
    got = {r.doc_id: r.score for r in quality_classifier.classify(docs, known).collect()}
    quality = {r.doc_id: r.quality for r in known.collect()}
    rows = [(r.doc_id, docstats.statistics(r.text)[1]) for r in docs.collect()]
    fold = np.array([zlib.crc32(str(i).encode()) % 5 for i, _ in rows])
    x, y = np.array([f for _, f in rows]), np.array([quality.get(i, -1) for i, _ in rows])
    first, last = (y >= 0) & (fold > 0) & (fold < 4), (y >= 0) & (fold == 4)
    rng = np.random.default_rng(7)
    waves, phases = rng.normal(size=(x.shape[1], 192)) / 4, rng.uniform(0, 2 * np.pi, 192)
    z = np.clip((x - x[first].mean(0)) / np.maximum(x[first].std(0), 1e-6), -8, 8)
    z = np.hstack([np.cos(z @ waves + phases) * np.sqrt(2 / 192), np.full((len(x), 1), 0.125)])
    w = np.linalg.solve(z[first].T @ z[first] + 1e-3 * first.sum() / 192 * np.eye(193), z[first].T @ y[first])
    raw = model.raw(x)
    assert np.abs(raw - np.clip(z @ w, 0, 1)).max() < 2e-3
    cell = np.rint(raw * quality_classifier.GRID)
    blocks = [[c / quality_classifier.GRID, (cell[last] == c).sum(), y[last][cell[last] == c].mean()] for c in np.unique(cell[last])]
    while any(a[2] >= b[2] for a, b in zip(blocks, blocks[1:])):  # noqa: B905
        k = next(k for k in range(len(blocks) - 1) if blocks[k][2] >= blocks[k + 1][2])
        a, b = blocks[k], blocks[k + 1]
        blocks[k : k + 2] = [[(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], (a[2] * a[1] + b[2] * b[1]) / (a[1] + b[1])]]
    wanted = np.interp(raw, [b[0] for b in blocks], [b[2] for b in blocks])
    assert [got[i] for i, _ in rows] == pytest.approx(wanted.tolist(), abs=1e-9)


def test_classifier_is_reproducible(spark):
    docs, known = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("documents", "labels"))
    scores = [as_set(quality_classifier.classify(d, known.repartition(n))) for d, n in ((docs, 1), (docs.repartition(7), 3), (docs.orderBy("text").repartition(2), 5))]
    assert scores[0] == scores[1] == scores[2]


def test_classifier_on_awkward_rows(spark):
    docs = documents(spark)
    got = quality_classifier.classify(docs, labels(spark))
    assert got.count() == len(ROWS)
    assert as_set(quality_classifier.classify(clashing(docs), labels(spark))) == as_set(got)
    assert quality_classifier.classify(docs.limit(0), labels(spark)).count() == 0
    assert {r.score for r in quality_classifier.classify(docs, labels(spark).limit(0)).collect()} == {1.0}
    kept = quality_classifier.keep(clashing(docs), labels(spark))
    assert kept.columns == clashing(docs).columns


def test_isotonic():
    at, p = quality_classifier.isotonic(np.array([0.1, 0.2, 0.3, 0.4]), np.array([1, 1, 1, 1.0]), np.array([0, 1, 0, 1.0]))
    assert p.tolist() == [0, 0.5, 1] and at == pytest.approx([0.1, 0.25, 0.4])
