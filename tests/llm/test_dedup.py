"""Substring dedup, the Jaccard join, components."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from folioloom.llm import components, ngram_jaccard, substring_dedup

from .helpers import CLASHING, PROSE, ROWS, as_set, clashing, documents


def test_sentences_lose_nothing():
    for _, text, *_ in ROWS:
        units, sizes = substring_dedup.sentences(text or "")
        assert "".join(units) == (text or "")
        assert sizes == [len(u.split()) for u in units] and max(sizes, default=0) <= substring_dedup.MOST


def brute_substrings(rows):
    cut = {k: substring_dedup.sentences(t or "") for k, (_, t) in enumerate(rows)}
    occurrences = defaultdict(list)
    order = sorted(cut, key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    for k in order:
        units, sizes = cut[k]
        spans = set()
        for a in range(len(units)):
            spans |= {next(((a, b) for b in range(a + 1, len(units)) if sum(sizes[a : b + 1]) >= substring_dedup.LEAST), None)}
        for b in range(len(units)):
            spans |= {next(((a, b) for a in range(b - 1, -1, -1) if sum(sizes[a : b + 1]) >= substring_dedup.LEAST), None)}
        for a, b in sorted(spans - {None}):
            occurrences[tuple(u.strip() for u in units[a : b + 1])].append((k, a, b))
    gone = defaultdict(set)
    for found in occurrences.values():
        for k, a, b in found:
            if (rows[k], a, b) != (rows[found[0][0]], found[0][1], found[0][2]):
                gone[k] |= set(range(a, b + 1))
    out = []
    for k, (i, t) in enumerate(rows):
        left = "".join(u for j, u in enumerate(cut[k][0]) if j not in gone[k])
        out.append((i, t if t is None or not gone[k] else left if left.strip() else ""))
    return out


def key(x):
    return repr(x)


def test_substrings_against_brute_force(spark):
    rng = np.random.default_rng(4)
    words = ["alpha", "beta", "gamma", "delta", "eta"]
    pool = [" ".join(rng.choice(words, rng.integers(1, 14))) + "." for _ in range(40)]
    rows = [(int(k), " ".join(rng.choice(pool, rng.integers(1, 30)))) for k in range(60)] + [(r[0], r[1]) for r in ROWS if r[0] is not None and r[0] != 10]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    got = substring_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=key) == sorted(brute_substrings(rows), key=key)


def test_substring_passages_and_awkward_rows(spark):
    passage = " ".join(PROSE[:3])
    rows = [(k, f"Own start number {k} here. {passage} Own end {k}.") for k in range(5)] + [(9, None), (10, ""), (4, f"Own start number 4 here. {passage} Own end 4."), (None, "Short one.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text, r.removed_sentences) for r in substring_dedup.dedup(docs).collect()), key=key)
    texts = [t for i, t, _ in got if i in range(5)]
    assert sum(PROSE[0] in t for t in texts) == 1 and all(f"Own end {i}." in t for i, t, _ in got if i in range(5))
    assert len([1 for i, t, _ in got if i == 4]) == 2 and (None, "Short one.", 0) in got and (9, None, 0) in got and (10, "", 0) in got
    wide = clashing(docs)
    out = substring_dedup.dedup(wide)
    assert out.columns == [*wide.columns, "removed_sentences", "removed_chars"]
    assert sorted(((r.doc_id, r.text, r.removed_sentences) for r in out.collect()), key=key) == got
    assert out.select("key").distinct().first()[0] == "own key"
    assert substring_dedup.dedup(docs.limit(0)).count() == 0


def test_long_sentence_passage(spark):
    passage = ", ".join(f"part {k} of a very long sentence" for k in range(10))
    docs = spark.createDataFrame([(k, f"Start {k}. {passage}. End {k}.") for k in range(3)], "doc_id long, text string")
    assert sum("part 5 of" in r.text for r in substring_dedup.dedup(docs).collect()) == 1


def word_windows(text, size):
    words = text.split()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def test_passage_at_any_offset(spark):
    """A shared passage without punctuation is found wherever it starts, in long sentences and short ones."""
    rng = np.random.default_rng(7)
    passage = " ".join(f"p{x}" for x in rng.integers(0, 10**6, 60))
    rows = [(k, " ".join([*(f"a{k}x{j}" for j in range(k)), passage, *(f"z{k}x{j}" for j in range(k % 7))])) for k in range(50)]
    rows += [(50, f"Short. {passage}. End."), (51, f"One, two {passage}, three.\nfour"), (52, f"x\n{passage}\ny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(word_windows(rows[0][1], 51) & word_windows(t, 51) for _, t in rows)
    got = {r.doc_id: r.text for r in substring_dedup.dedup(docs).collect()}
    whole = {i: set(t.split()) - set(passage.split()) for i, t in rows}
    assert got[0] == rows[0][1]
    for a in got:
        assert not any(word_windows(got[a], 51) & word_windows(got[b], 51) for b in got if b < a)
        assert a >= 50 or whole[a] <= set(got[a].split())  # no own word goes, and none run together


def brute_components(rows, words, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
                old = group[a]
                group = [group[b] if g == old else g for g in group]
    low = {g: min(rows[k][0] for k in range(len(rows)) if group[k] == g) for g in group}
    return sorted((rows[k][0], len(sets[k]), low[group[k]] if sets[k] else rows[k][0]) for k in range(len(rows)))


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
def test_join_against_brute_force(spark, words, percent):
    rng = np.random.default_rng(words)
    rows = []
    for base in range(12):
        text = [f"w{x}" for x in rng.integers(0, 400, rng.integers(1, 120))]
        for _ in range(rng.integers(1, 12)):
            copy = list(text)
            for _ in range(rng.integers(0, 5)):
                copy[rng.integers(len(copy))] = f"n{rng.integers(1000)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + k, t) for k, t in enumerate(["", None, "A b", "a  B", "one", "ONE", "a b c d", "é É", "é é", PROSE[0], PROSE[0].upper()])]
    got = ngram_jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), words, percent)
    assert sorted(tuple(r) for r in got.collect()) == brute_components(rows, words, percent)


def test_groups_lose_no_pair():
    """Linked sets of any sizes share a signature, also where groups are empty."""
    rng = np.random.default_rng(9)
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        s = rng.integers(0, 2**63, n, dtype=np.uint64)
        out = int(rng.integers(0, max(1, n // 5) + 1))
        more = int(rng.integers(0, max(1, n // 5) + 1))
        a, b = np.unique(s), np.unique(np.concatenate([s[out:], rng.integers(0, 2**63, more, dtype=np.uint64)]))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        for percent in (80, 85):
            if 100 * both >= percent * (len(a) + len(b) - both):
                assert set(ngram_jaccard.signatures(a, percent)) & set(ngram_jaccard.signatures(b, percent))


def test_join_on_awkward_rows(spark):
    docs = documents(spark)
    got = ngram_jaccard.join(docs)
    assert got.count() == len(ROWS)
    by = defaultdict(set)
    for r in got.collect():
        by[r.doc_id].add((r.n_shingles > 0, r.component_id))
    assert by[8] == {(True, 0)} and by[5] == {(False, 5)} and by[6] == {(False, 6)} and by[1] == {(True, 1)} and by[None] == {(True, None)}
    assert as_set(ngram_jaccard.join(clashing(docs))) == as_set(got)
    assert ngram_jaccard.join(docs.limit(0)).count() == 0
    kept = ngram_jaccard.keep_one(clashing(docs))
    assert kept.columns == clashing(docs).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 8 not in ids and {5, 6, 7, 0, 3, 4, 10} <= set(ids) and ngram_jaccard.keep_one(docs.limit(0)).count() == 0
    assert set(CLASHING) <= set(kept.columns)


@pytest.mark.parametrize("edges_each", [500_000, 5])
def test_components(spark, monkeypatch, edges_each):
    monkeypatch.setattr(components, "EDGES", edges_each)
    edges = [(k, k + 1) for k in range(50)] + [(100, 200), (300, 200), (7, 7), (None, 3), (1000, 1001), (1001, 1000)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {**{k: 0 for k in range(51)}, 100: 100, 200: 100, 300: 100, 1000: 1000, 1001: 1000}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("least", [1, 25, 127, 128])
def test_runs_of_many_short_sentences(spark, least):
    """Of two equal texts of one-word sentences the copy keeps at most what is shorter than a run."""
    text = " ".join(f"w{k}." for k in range(400))
    out = substring_dedup.dedup(documents(spark, [(1, text, "en", "a", 1), (2, text, "en", "a", 1)]), least).orderBy("doc_id").collect()
    assert out[0].text == text and out[1].text == ""


def test_runs_beyond_their_field_raise(spark):
    for least in (0, 129, 200, 1000):
        with pytest.raises(ValueError):
            substring_dedup.dedup(documents(spark), least)


def cut_plainly(text):
    """Pieces by the rule of the docstring, from the definition: at sentence ends, line ends, and before least hashes of seven words."""
    words = [m for m in re.finditer(r"\s*\S+", text)]
    starts = {0}
    for k in range(1, len(words)):
        if words[k - 1][0][-1] in ".!?" or "\n" in words[k][0]:
            starts.add(k)
    bounds = sorted(starts) + [len(words)]
    hashes = [xxhash.xxh3_64_intdigest(w[0].strip()) for w in words]
    for lo, hi in zip(bounds, bounds[1:], strict=False):
        for k in range(lo, hi - 6):
            seven = hashes[k : k + 7]
            starts.add(k + max(j for j in range(7) if seven[j] == min(seven)))
    bounds = sorted(starts) + [len(words)]
    pieces = ["".join(w[0] for w in words[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    pieces[-1] += text[words[-1].end() :] if words else text
    return pieces


def test_cuts_like_the_rule():
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice(["a", "b", "cc", "Dd.", "e!", "ff", "gg", "h"]) + rng.choice([" ", " ", " ", "  ", "\n"]) for _ in range(rng.randrange(1, 60)))
        assert substring_dedup.sentences(text)[0] == cut_plainly(text), text
