"""Substring dedup over sliding spans of sentences.

A text is cut, without loss, at sentence ends (``.``, ``!`` or ``?`` before white space, and line ends) and within every
sentence before the word whose hash is the least of some ``WINDOW`` words in a row (the last of equal ones). Such a cut
depends on fewer than ``WINDOW`` words to either side, neither on where the sentence starts nor on its length, and no piece
has more than ``WINDOW`` words. From each piece the shortest run of at least two pieces and ``least`` words (a parameter;
with 1 that is every pair of neighbours, which any longer run is made of) is hashed, forwards and backwards, so that every
piece of a repeated passage lies in a run that is inside it. Runs are joined globally by 89 bits of two hashes: the first
(lowest doc_id, then place) stays, and a piece that any later occurrence covers is removed.
Cuts at least ``WINDOW`` words inside a repeated passage are equal in all its copies, so any passage of
``least + 4 * WINDOW - 3`` words (50), with the same white space between them, has an equal run in all of them, wherever it
starts; repeats of whole sentences are found from ``least`` words on. Every piece but the first starts with its white space,
so that what is left of a text never runs together.

Skew: a task flags all but its own first occurrence of a run at once and sends on only that one, so a run that is in a
third of all documents reaches the join as one row per task.

Defined results: null texts stay null and empty ones empty; rows equal in doc_id and text are one document and are
treated alike; rows that share a doc_id but not the text are separate documents, as are rows without a doc_id that
differ in text; a document all of whose sentences are repeats keeps an empty text; a text of one sentence has no run. An empty table gives
an empty result. All other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Scratch, packed, parts, passing, unpacked

LEAST, MOST = 25, 24  # words of a run by default, and the most that a piece may have
LONGEST = 128  # words that a run may be asked to have: a span has seven bits for the sentences after its first
WINDOW = 7  # words of which one is cut before; no piece is longer
FLUSH = 300_000  # runs that a task holds at once
_WORDS = re.compile(r"\s*\S+")
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.full(1 << 12, _BASE, np.uint64))
_INVERSES = np.cumprod(np.full(1 << 12, pow(_BASE, -1, 1 << 64), np.uint64))
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def sentences(text: str) -> tuple[list[str], list[int]]:
    """Pieces that join to ``text``, and how many words each has (none has zero, but for a text without words)."""
    words = _WORDS.findall(text)
    n = len(words)
    if not n:
        return [text], [0]
    starts = np.fromiter((k == 0 or words[k - 1][-1] in ".!?" or "\n" in words[k] for k in range(n)), bool, n)
    if n >= WINDOW:
        sentence = np.cumsum(starts)
        whole = np.flatnonzero(sentence[: n - WINDOW + 1] == sentence[WINDOW - 1 :])  # windows inside one sentence
        ranks = np.fromiter(map(xxhash.xxh3_64_intdigest, text.split()), np.uint64, n)
        windows = np.lib.stride_tricks.sliding_window_view(ranks, WINDOW)[whole, ::-1]
        starts[whole + WINDOW - 1 - windows.argmin(1)] = True
    at = [*np.flatnonzero(starts).tolist(), n]
    out = ["".join(words[a:b]) for a, b in zip(at, at[1:])]  # noqa: B905
    out[-1] += text[sum(map(len, words)) :]
    return out, np.diff(at).tolist()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= len(_POWERS):
        return _POWERS[:n], _INVERSES[:n]
    return np.cumprod(np.full(n, _BASE, np.uint64)), np.cumprod(np.full(n, pow(_BASE, -1, 1 << 64), np.uint64))


def runs(text: str, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run, and its span: 25 bits of a second hash, 30 of its first sentence, 7 of how many follow, and one free."""
    units, sizes = sentences(text)
    n = len(units)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    words = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(n)
    ends = np.maximum(np.searchsorted(words, words[:-1] + least, side="left") - 1, at + 1)  # last sentence of the forward run
    starts = np.minimum(np.searchsorted(words, words[1:] - least, side="right") - 1, at - 1)  # first of the backward run
    first = np.concatenate([at[ends < n], starts[starts >= 0]])
    last = np.concatenate([ends[ends < n], at[starts >= 0]])
    enough = words[last + 1] - words[first] >= least
    place = np.unique(first[enough] * (n + 1) + last[enough])
    first, last = place // (n + 1), place % (n + 1)
    h = np.fromiter((xxhash.xxh3_64_intdigest(u.strip()) for u in units), np.uint64, n)
    up, down = powers(n)
    made = []
    for x in (h, (h ^ (h >> np.uint64(32))) * _SECOND):  # the sum of hashes times powers, moved to the same power
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up)])
        key = (total[last + 1] - total[first]) * down[first]
        key ^= key >> np.uint64(32)
        key *= _SECOND
        made.append(key ^ (key >> np.uint64(29)))
    key, second = made
    return key.view(np.int64), (second >> np.uint64(39)).view(np.int64) << 38 | first << 8 | last - first << 1


# The lowest bit of a span says that the run is not the first of its hash. A row that holds less takes less disk.
ROWS = pa.schema([("h", pa.int64()), ("key", pa.int64()), ("doc_id", pa.int64()), ("span", pa.int64())])
ROWS_DDL = "h long, key long, doc_id long, span long"


def mark_late(rows: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The rows (h, doc_id, key, span) in order, and which are not the first of their hashes; equal rows once."""
    second = rows[3] >> 38
    order = np.lexsort([*rows[:0:-1], second, rows[0]])
    rows, second = [c[order] for c in rows], second[order]
    if not len(order):
        return rows, np.empty(0, bool)
    same = (rows[0][1:] == rows[0][:-1]) & (second[1:] == second[:-1])
    again = same & np.all([c[1:] == c[:-1] for c in rows[1:]], axis=0)
    fresh = np.concatenate([[True], ~again])
    late = np.concatenate([[False], same])[fresh]
    return [c[fresh] for c in rows], late


def find_runs(batches: Iterator[pa.RecordBatch], least: int = LEAST) -> Iterator[pa.RecordBatch]:
    held: list[list[np.ndarray]] = []
    count = 0

    def flush():
        nonlocal count
        rows, late = mark_late([np.concatenate(c) for c in zip(*held, strict=True)])
        held.clear()
        count = 0
        # Later occurrences within this task need no comparing; they are dealt by their place, so that no hash draws them together.
        place = (rows[2].view(np.uint64) + rows[3].view(np.uint64)) * np.uint64(_BASE)
        cols = [np.where(late, place.view(np.int64), rows[0]), rows[2], rows[1], rows[3] | late]
        for lo in range(0, len(late), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + 50_000]) for c in cols], schema=ROWS)

    for batch in batches:
        for doc_id, key, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            h, span = runs(text, least) if text else (np.empty(0),) * 2
            if len(h):
                held.append([h, np.full(len(h), -(2**63) if doc_id is None else doc_id), np.full(len(h), key), span])
                count += len(h)
            if count >= FLUSH:
                yield from flush()
    if held:
        yield from flush()


def find_late(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of all rows with a hash, those that are not its first."""
    parts_, out = [], pa.schema([ROWS.field(c) for c in ("key", "span")])
    for b in frames:
        if b.num_rows:
            parts_.append([b.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
    if not parts_:
        return
    h, key, doc_id, span = (np.concatenate(c) for c in zip(*parts_, strict=True))
    sent = span & 1 > 0
    rows, late = mark_late([c[~sent] for c in (h, doc_id, key, span)])
    for c in ([key[sent], span[sent]], [x[late] for x in rows[2:]]):
        for lo in range(0, len(c[0]), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + 50_000]) for x in c], schema=out)


CLEANED = T.StructType([T.StructField("text", T.StringType()), T.StructField("removed", T.IntegerType()), T.StructField("removed_chars", T.IntegerType())])


# Not deterministic as far as the optimizer goes: it would copy a deterministic one into filters on its result, and each
# copy has a Python worker of its own in every task.
@F.arrow_udf(CLEANED)
def without(texts: pa.Array, covered: pa.Array) -> pa.Array:
    schema, done = to_arrow_schema(CLEANED), [[], [], []]
    for lo in range(0, len(texts), 256):  # the rows of a batch are never Python objects all at once
        rows = [cleaned(t, c) for t, c in zip(texts.slice(lo, 256).to_pylist(), covered.slice(lo, 256).to_pylist(), strict=True)]
        for column, values, field in zip(done, zip(*rows, strict=True), schema, strict=True):
            column.append(pa.array(values, field.type))
    return pa.StructArray.from_arrays([pa.concat_arrays(c) if c else pa.array([], f.type) for c, f in zip(done, schema, strict=True)], fields=list(schema))


without = without.asNondeterministic()


def cleaned(text: str | None, ranges: list[int] | None) -> tuple[str | None, int, int]:
    """What the spans leave of a text, how many of its sentences are gone, and how many characters."""
    if ranges is None or text is None:
        return text, 0, 0
    units, _ = sentences(text)
    gone = np.zeros(len(units) + 1, np.int64)
    for span in ranges:
        first = span >> 8 & (1 << 30) - 1
        gone[first] += 1
        gone[first + (span >> 1 & 127) + 1] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    left = "".join(u for u, g in zip(units, gone, strict=True) if not g)
    return left if left.strip() else "", int(gone.sum()), len(text) - len(left)


def dedup(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with repeated sentences removed from ``text``; adds ``removed_sentences`` and ``removed_chars``.

    ``least`` is from 1 to 128 words; others raise.
    A run has at least ``least`` words. The spans to remove are written to the shared folder, which frees the shuffle of the
    runs; only texts that may have some are then shuffled to meet theirs.
    """
    if not 1 <= least <= LONGEST:
        raise ValueError(f"a run has from 1 to {LONGEST} words at least, not {least}")
    spark = docs.sparkSession
    key = F.xxhash64("doc_id", "text")
    found = docs.select("doc_id", key.alias("key"), "text").mapInArrow(partial(find_runs, least=least), ROWS_DDL)
    buckets = parts(docs.count(), 2000, int(spark.conf.get("spark.sql.shuffle.partitions")))
    late = found.repartition(buckets, "h").mapInArrow(find_late, "key long, span long")
    covered = Scratch(spark).keep(late.groupBy("key").agg(F.collect_set("span").alias("covered")), "covered")

    doc_key = F.xxhash64("doc.doc_id", "doc.text")
    among = passing(covered.select("key"))

    @F.pandas_udf("boolean")
    def maybe(keys: pd.Series) -> pd.Series:
        return pd.Series(among(keys.to_numpy()))

    keyed = packed(docs).withColumn("key", doc_key)
    # Merged, not broadcast, when there are few: a shuffle then lies between the two functions, and a task has one worker at once.
    both = keyed.where(maybe("key")).join(covered.hint("merge"), "key", "left").withColumn("clean", without("doc.text", "covered"))
    clean = F.col("clean")
    changed = both.select(*unpacked(docs.columns, text=clean["text"], removed_sentences=clean["removed"], removed_chars=clean["removed_chars"]))
    none = F.lit(0).cast("int")
    same = keyed.where(~maybe("key")).select(*unpacked(docs.columns, removed_sentences=none, removed_chars=none))
    return changed.union(same)
