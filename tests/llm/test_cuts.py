"""Fill-in-the-middle, benchmark decontamination and the filter audit against plain versions."""

import hashlib
import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from folioloom.llm import decontaminate, fill_in_middle, filter_audit
from tests.llm.helpers import CLASHING, ROWS, SCHEMA, as_set, clashing, documents, labels

UNITS = {"characters": r"(?s).", "words": r"[ \t\n\v\f\r]*[^ \t\n\v\f\r]+|[ \t\n\v\f\r]+", "lines": r"[^\n]*\n|[^\n]+"}


def cut_plainly(doc_id, text, units, percent=90, spm=20):
    text = text or ""
    parts = re.findall(UNITS[units], text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= percent:
        return len(parts), "plain", None, None, text
    a, b = sorted(x % (len(parts) + 1) for x in (h1, h2))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    return (len(parts), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < spm else (len(parts), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    sizes = [0, 1, 2, 63, 64, 65, 255, 256, 257, 700, 3000]
    rows = [(100 + k, "".join(rng.choice("ab<PS>é😀 \n\tx.") for _ in range(rng.choice(sizes))), "en", "r", 1) for k in range(n)]
    rows += [(300 + k, "y" * k + "<M>" + "z" * 90, "en", "r", 1) for k in range(60, 68)]  # a sentinel over the end of a piece
    return rows + [(400, "word" * 400 + " " + "é" * 300, "en", "r", 1), (401, " " * 500, "en", "r", 1), (402, "\n" * 300, "en", "r", 1)]


@pytest.mark.parametrize("units", UNITS)
@pytest.mark.parametrize("piece", [64, 1 << 16])
def test_cuts_like_plain_ones(spark, units, piece):
    rows = [*ROWS, *odd_texts(60)]
    out = fill_in_middle.transform(documents(spark, rows), units, piece=piece)
    got = out.select("doc_id", "n_units", "form", "prefix_units", "middle_units", "text", fill_in_middle.restored(F.col("text"), F.col("form")).alias("back"))
    want = [(i, *cut_plainly(i, t, units), t or "") for i, t, *_ in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_cut_bytes_and_copies(spark):
    """Copies of one long text with different ids are cut at their own places."""
    text = "Größe 😀 " * 200
    rows = [(k, text, "en", "a", 1) for k in range(40)] * 2
    out = fill_in_middle.transform(documents(spark, rows), piece=128).where("form <> 'plain'").collect()
    assert len({(r.first_byte, r.second_byte) for r in out}) > 10
    for r in out:
        assert len(text.encode()[: r.first_byte].decode()) == r.prefix_units
        assert len(text.encode()[r.first_byte : r.second_byte].decode()) == r.middle_units


def test_cuts_of_nothing_and_of_clashing_names(spark):
    assert fill_in_middle.transform(documents(spark, [])).count() == 0
    out = fill_in_middle.transform(clashing(documents(spark).withColumns({c: F.lit("mine") for c in ("form", "t", "h", "cut", "piece")})), piece=64)
    plain = fill_in_middle.transform(documents(spark), piece=64)
    assert as_set(out.select(plain.columns)) == as_set(plain)
    assert out.where("t <> 'mine' or key <> 'own key'").count() == 0


def test_sentinels_that_may_overlap_raise():
    for bad in (("<P>", "<P>", "<M>"), ("<P>", "<P>x", "<M>"), ("ab", "bc", "<M>"), ("", "a", "b"), ("aba", "x", "y")):
        with pytest.raises(ValueError):
            fill_in_middle.check_sentinels(bad)
    fill_in_middle.check_sentinels(("<|fim_prefix|>", "<|fim_suffix|>", "<|fim_middle|>"))
    with pytest.raises(ValueError):
        fill_in_middle.automaton("tokens")


def test_other_sentinels(spark):
    marks = ("<|fim_prefix|>", "<|fim_suffix|>", "<|fim_middle|>")
    rows = [(k, t.replace("<", "<|").replace("P", "fim_"), "en", "a", 1) for k, t, *_ in odd_texts(40)] + [(1, "a <|fim_middle|> b", "en", "a", 1)]
    out = fill_in_middle.transform(documents(spark, rows), sentinels=marks, percent=100, piece=64)
    back = out.select("doc_id", fill_in_middle.restored(F.col("text"), F.col("form"), marks).alias("t")).collect()
    assert sorted(map(tuple, back)) == sorted((r[0], r[1]) for r in rows)
    assert out.where("doc_id = 1").first().form == "plain" and out.where("form = 'psm'").count() > 10


# --- Decontamination -----------------------------------------------------------------------------------------------


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def search_plainly(docs, items, window=10):
    wanted = {}
    for item, text in items:
        ws = words(text)
        n = min(window, len(ws))
        for k in range(len(ws) - n + 1) if n else ():
            wanted.setdefault(tuple(ws[k : k + n]), set()).add(item)
    out = []
    for doc_id, text, *_ in docs:
        ws, hit, found = words(text), set(), set()
        for n in {len(w) for w in wanted}:
            for k in range(len(ws) - n + 1):
                if tuple(ws[k : k + n]) in wanted:
                    hit |= set(range(k, k + n))
                    found |= wanted[tuple(ws[k : k + n])]
        out.append((doc_id, len(ws), len(hit), tuple(sorted(str(i) for i in found if i is not None)), bool(hit)))
    return sorted(map(repr, out))


def searched(docs, items, **kw):
    rows = decontaminate.scan(docs, items, **kw).select("doc_id", "n_words", "n_hit", "items", "contaminated").collect()
    return sorted(repr((r[0], r[1], r[2], tuple(r[3]), r[4])) for r in rows)


def test_windows_like_a_plain_search(spark):
    rng = random.Random(5)
    vocabulary = ["Aa", "bé", "CC", "d1", "e", "日本"]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "\n", "--", "'"]) for _ in range(n))
    items = [(k, text(n)) for k, n in enumerate([0, 1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 12, 15, 20, 40, 40])]
    items += [(50, items[13][1]), (51, items[13][1].upper()), (51, items[9][1]), (52, None), (None, items[12][1]), (53, "?!")]
    docs = [(k, text(rng.choice([0, 1, 3, 9, 10, 11, 60])), "en", "a", 1) for k in range(60)]
    for k in range(60, 120):  # passages that many documents share, whole and cut short
        _, t = items[rng.randrange(8, 16)]
        ws = re.findall(r"\w+", t)
        docs.append((k, text(4) + " ".join(ws[rng.randrange(3) : len(ws) - rng.randrange(4)]) + "." + text(3), "en", "a", 1))
    docs += docs[60:70] + [(None, docs[80][1], "en", "a", 1), (500, None, "en", "a", 1), (501, "aa", "en", "a", 1), (502, "x" * 5000 + " aa", "en", "a", 1)]
    table = spark.createDataFrame(items, "item_id long, text string")
    assert searched(documents(spark, docs), table) == search_plainly(docs, items)
    few = [x for x in items if x[0] in (8, 9, 13, 50)]
    assert searched(documents(spark, docs), spark.createDataFrame(few, "item_id long, text string"), shingle=3) == search_plainly(docs, few)


def test_equal_hashes_are_not_equal_words(spark):
    """Letters that trade places a hash's width apart leave it as it is; the words are compared all the same."""
    a, b = "p" + "m" * 63 + "q", "q" + "m" * 63 + "p"
    found = decontaminate.Words(*decontaminate.bytes_of(__import__("pyarrow").array([f"{a} {b}"]))).hashes
    assert found[0] == found[1]
    docs, items = [(1, f"one two {a} four", "en", "a", 1), (2, f"one two {b} four", "en", "a", 1)], [(7, f"two {a}")]
    assert searched(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")) == search_plainly(docs, items)


def test_spans_and_awkward_tables(spark):
    items = spark.createDataFrame([(1, "the miller had a boat"), (2, "")], "item_id long, text string")
    out = decontaminate.scan(documents(spark, [(1, "Well: THE MILLER had a boat; the miller had a boat", "en", "a", 1)]), items).first()
    assert [tuple(s) for s in out.spans] == [(1, 5), (6, 5)] and out["items"] == ["1"] and out.n_hit == 10
    assert decontaminate.scan(documents(spark, []), items).count() == 0
    none = decontaminate.scan(documents(spark), items.limit(0))
    assert none.where("contaminated or n_hit > 0 or size(items) > 0").count() == 0 and none.count() == len(ROWS)
    mine = clashing(documents(spark).withColumns({c: F.lit("mine") for c in ("spans", "items", "h", "at", "n_words", "words")}))
    plain = decontaminate.scan(documents(spark), items)
    both = decontaminate.scan(mine, items.withColumns({c: F.lit("x") for c in CLASHING}))
    assert as_set(both.select(plain.columns)) == as_set(plain)


# --- Filter audit --------------------------------------------------------------------------------------------------


def audited_plainly(rows, marks):
    low = {}
    for i, t, *_ in rows:
        if i is not None:
            low[t or ""] = min(low.get(t or "", i), i)
    said = {}
    for i, quality, toxic in marks:
        q, x = said.get(i, (False, False))
        said[i] = (q or quality == 1, x or toxic == 1)
    docs = []
    for i, t, lang, *_ in rows:
        t = t or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "".join(c for c, bad in zip("ABCDE", (len(ws) < 200, 100 * len(set(ws)) < 50 * len(ws), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), bool(re.search(r"[#$%&*|]", t)), i is not None and i > low[t]), strict=True) if bad)
        docs.append((lang or "", fails, *(said.get(i, (False, False)) if i is not None else (False, False))))
    out = []
    for part in {d[0] for d in docs}:
        mine, runs, shapley = [d for d in docs if d[0] == part], [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                new = [d for d in mine if f in d[1] and not set(order[:k]) & set(d[1])]
                shapley[f] += len(new)
                kept = sum(not set(order[: k + 1]) & set(d[1]) for d in mine)
                runs.append((f, (part, "".join(order), k + 1, kept, len(new), sum(f in d[1] for d in mine) - len(new), sum(d[1] == f for d in mine), sum(d[2] for d in new), sum(d[3] for d in new))))
        out += [(*r, shapley[f]) for f, r in runs]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 1 << 16])
def test_audit_like_plain_counts(spark, block):
    rng = random.Random(8)
    kinds = ["few words", "w{} " * 3, "Loud WORDS {} " * 90, "same same " * 150, "a # {} " * 120, "fine word{} and more{} " * 110]
    rows = [*ROWS]
    for k in range(150):
        t = rng.choice(kinds)
        rows.append((100 + k, re.sub(r"\{\}", lambda m: str(rng.randrange(400)), t), rng.choice(["en", "de", None, ""]), "a", 1))
    rows += [(300 + k, rows[rng.randrange(len(ROWS), len(rows))][1], "en", "a", 1) for k in range(40)]
    marks = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for r in rows if rng.random() < 0.6] + [(None, 1, 1)]
    judged = filter_audit.judged(documents(spark, rows), labels(spark, marks))
    got = filter_audit.audit(filter_audit.index(judged, block)).collect()
    assert sorted(map(tuple, got)) == audited_plainly(rows, marks)


def test_audit_of_nothing_and_of_clashing_names(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert filter_audit.audit(filter_audit.index(filter_audit.judged(nothing, labels(spark)))).count() == 0
    of = lambda docs: as_set(filter_audit.audit(filter_audit.index(filter_audit.judged(docs, labels(spark)))))
    assert of(clashing(documents(spark).withColumns({c: F.lit("mine") for c in ("part", "bits", "low", "good")}))) == of(documents(spark))


def test_index_answers_other_questions(spark):
    """Blocks hold one bit a document, whatever part it is of."""
    rows = filter_audit.judged(documents(spark), labels(spark)).coalesce(1)
    blocks = filter_audit.index(rows, 4).collect()
    assert sum(b.n for b in blocks) == len(ROWS) and all(b.n <= 4 and len(b.good) == 1 for b in blocks)
    failing = sum(filter_audit.popcount(__import__("numpy").frombuffer(b.fails[0], "u1")) for b in blocks)
    assert failing == rows.where("bits & 1 = 1").count()
