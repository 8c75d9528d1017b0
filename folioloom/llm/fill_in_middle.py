"""Fill-in-the-middle: texts cut at two drawn units and put in another order, by a parallel automaton scan.

One automaton over UTF-8 bytes tells where units (characters, words or lines) begin and where a sentinel is spelled.
A chunk of bytes may start anywhere, inside a character or a sentinel, so its scan gives for every state that it may
start in the state it ends in, the units that begin in it and whether a sentinel ends in it. These functions compose
associatively; composing those of the chunks before a chunk resolves its entry state and the units before it, and the
chunk that holds a drawn unit is scanned again, from its entry state, for that unit's byte.

Texts of at most ``piece`` bytes are composed where they are. Longer ones are cut into pieces that are dealt to all
tasks; only a piece's function (a few numbers for each state) is gathered by text, at most 2 GB / ``piece`` of them, since
no text is longer than 2 GB; then a text's drawn pieces alone are scanned again.

Defined results: a null text is an empty one; an empty text, one in which a sentinel is spelled, and the share of texts
that is drawn for it stay as they are (form "plain"); repeated rows are treated alike, as all draws depend on the
document's id (a null id counts as an empty string); texts of any length are kept whole; an empty table gives an empty
result; an input column named like an added one is replaced, all others are passed on.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, packed, unpacked

SENTINELS = ("<P>", "<S>", "<M>")
CHUNK = 256  # bytes that are scanned in step with those of all other chunks
BATCH = 1 << 23  # bytes of texts that are scanned together
CUTS = "n long, marked boolean, first long, second long, first_byte long, second_byte long"


def unit_steps(units: str) -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a unit begins, for [state, byte], from state 0.

    A word unit is a word with the white space before it; white space at the end of a text is a unit too.
    """
    byte = np.arange(256)
    if units == "characters":
        return np.zeros((1, 256), int), ((byte & 0xC0) != 0x80)[None]
    if units == "lines":
        return np.where(byte == 10, 0, 1)[None].repeat(2, 0), np.array([[True], [False]]).repeat(256, 1)
    if units == "words":
        space = np.isin(byte, list(SPACES.encode()))
        return np.where(space, 1, 2)[None].repeat(3, 0), np.stack([byte >= 0, byte < 0, space])
    raise ValueError(f"units are characters, words or lines, not {units}")


def spelling_steps(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether one of ``words`` ends, for [state, byte], from state 0: the automaton of all their prefixes."""
    prefixes = sorted({w[:k] for w in words for k in range(len(w) + 1)}, key=lambda p: (len(p), p))
    number = {p: i for i, p in enumerate(prefixes)}

    def longest(seen: bytes) -> int:
        return next(number[seen[k:]] for k in range(len(seen) + 1) if seen[k:] in number)

    step = np.array([[longest(p + bytes([b])) for b in range(256)] for p in prefixes])
    ends = np.array([any(p.endswith(w) for w in words) for p in prefixes])
    return step, ends[step]


@dataclass(frozen=True)
class Automaton:
    """States are numbered from 0, the start; tables are flat, by 256 * state + byte."""

    step: np.ndarray
    begins: np.ndarray
    marks: np.ndarray

    @property
    def size(self) -> int:
        return len(self.step) // 256


def automaton(units: str = "characters", sentinels: Sequence[str] = SENTINELS) -> Automaton:
    """The least automaton that knows both where units begin and where sentinels end."""
    a_step, a_out = unit_steps(units)
    b_step, b_out = spelling_steps([s.encode() for s in sentinels])
    number, queue, step, begins, marks = {(0, 0): 0}, deque([(0, 0)]), [], [], []
    while queue:
        a, b = queue.popleft()
        for pair in zip(a_step[a].tolist(), b_step[b].tolist(), strict=True):
            if pair not in number:
                number[pair] = len(number)
                queue.append(pair)
        step.append([number[p] for p in zip(a_step[a].tolist(), b_step[b].tolist(), strict=True)])
        begins.append(a_out[a])
        marks.append(b_out[b])
    step, begins, marks = np.array(step), np.array(begins), np.array(marks)
    kind = np.zeros(len(step), int)
    while True:  # states are told apart by what they give and by where they lead, until no more are
        rows = np.hstack([begins, marks, kind[step], kind[:, None]])
        _, first, now = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        now = now.reshape(-1)
        if len(first) == kind.max() + 1:
            break
        kind = now
    order = np.unique(kind, return_index=True)[1]
    order = np.concatenate([[0], order[order != 0]])  # the start stays state 0
    place = np.empty(len(order), int)
    place[kind[order]] = np.arange(len(order))
    return Automaton(place[kind[step[order]]].astype(np.int32).ravel(), begins[order].ravel(), marks[order].ravel())


@dataclass
class Functions:
    """What stretches of bytes do, by [state, stretch]: the end state, the units begun, whether a sentinel ended."""

    ends: np.ndarray
    counts: np.ndarray
    found: np.ndarray

    def after(self, before: Functions, here: np.ndarray) -> Functions:
        """The functions of ``before`` followed by these at ``here``."""
        at = (before.ends, here[None])
        return Functions(self.ends[at], before.counts + self.counts[at], before.found | self.found[at])

    def take(self, here: np.ndarray) -> Functions:
        return Functions(self.ends[:, here], self.counts[:, here], self.found[:, here])


def scanned(a: Automaton, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Functions:
    """The function of each stretch of ``data``, all scanned in step, from every state at once."""
    order = np.argsort(-lengths, kind="stable")
    at, left = starts[order], lengths[order]
    ends = np.arange(a.size, dtype=np.int32)[:, None].repeat(len(at), 1)
    counts, found = np.zeros(ends.shape, np.int64), np.zeros(ends.shape, bool)
    for k in range(int(left[0]) if len(left) else 0):
        m = int(np.searchsorted(-left, -k, side="left"))  # stretches that have a byte here
        here = (ends[:, :m] << 8) + data[at[:m] + k]
        ends[:, :m] = a.step.take(here)
        counts[:, :m] += a.begins.take(here)
        found[:, :m] |= a.marks.take(here)
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return Functions(ends, counts, found).take(back)


def prefixes(f: Functions, place: np.ndarray) -> Functions:
    """For each stretch, the function of its text up to its end: doubling over ``place``, a stretch's number in its text."""
    reach = 1
    while len(place) and reach <= place.max():
        here = np.flatnonzero(place >= reach)
        joined = f.take(here).after(f.take(here - reach), np.arange(len(here)))
        f.ends[:, here], f.counts[:, here], f.found[:, here] = joined.ends, joined.counts, joined.found
        reach *= 2
    return f


class Resolved:
    """Texts data[offsets[i]:offsets[i + 1]], each entered in a known state, with what stands before each of their chunks."""

    def __init__(self, a: Automaton, data: np.ndarray, offsets: np.ndarray, entered: np.ndarray | None = None):
        self.a, self.data, self.offsets = a, data, offsets
        sizes = np.diff(offsets)
        entered = np.zeros(len(sizes), np.int64) if entered is None else entered
        chunks = -(-sizes // CHUNK)
        self.last = np.cumsum(chunks) - 1
        text = np.repeat(np.arange(len(sizes)), chunks)
        place = np.arange(len(text)) - (self.last - chunks + 1)[text]
        self.starts = offsets[:-1][text] + place * CHUNK
        self.lengths = np.minimum(CHUNK, offsets[1:][text] - self.starts)
        self.whole = prefixes(scanned(a, data, self.starts, self.lengths), place)
        before = np.maximum(np.arange(len(text)) - 1, 0)
        first, state = place == 0, entered[text]
        self.entry = np.where(first, state, self.whole.ends[state, before])
        self.before = np.where(first, 0, self.whole.counts[state, before])
        some = chunks > 0
        self.totals, self.marked = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), bool)
        self.totals[some] = self.whole.counts[entered[some], self.last[some]]
        self.marked[some] = self.whole.found[entered[some], self.last[some]]
        self.base = np.cumsum(self.totals) - self.totals
        self.reached = self.base[text] + self.before  # ascends over all chunks

    def functions(self) -> Functions:
        """Of whole texts, which must not be empty."""
        return self.whole.take(self.last)

    def byte_of(self, text: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """The byte, from its text's begin, at which each text's unit begins; a text's end for a unit past its last."""
        out = np.diff(self.offsets)[text]
        inside = np.flatnonzero(unit < self.totals[text])
        chunk = np.searchsorted(self.reached, self.base[text[inside]] + unit[inside], side="right") - 1
        rank, state = unit[inside] - self.before[chunk], self.entry[chunk].astype(np.int64)
        seen, spot = np.zeros(len(chunk), np.int64), np.full(len(chunk), -1, np.int64)
        for k in range(int(self.lengths[chunk].max(initial=0))):
            at = np.minimum(self.starts[chunk] + k, len(self.data) - 1)
            here = (state << 8) + self.data[at]
            begins = self.a.begins.take(here) & (k < self.lengths[chunk])
            spot[begins & (seen == rank)] = k
            seen += begins
            state = self.a.step.take(here).astype(np.int64)
        out[inside] = self.starts[chunk] + spot - self.offsets[text[inside]]
        return out


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins; null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, most: int = BATCH) -> list[tuple[int, int]]:
    """Consecutive ranges of texts of about ``most`` bytes."""
    out, at = [], 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        out.append((at, to))
        at = to
    return out


def drawn(n: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = h1 % (n + 1), h2 % (n + 1)
    return np.minimum(a, b), np.maximum(a, b)


def struct_of(**columns) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(v) for v in columns.values()], list(columns))


def cuts_within(a: Automaton):
    """Struct of cuts of texts that are composed in one task."""

    @F.arrow_udf(CUTS)
    def run(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
        data, offsets = bytes_of(texts)
        x, y = h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False)
        out = [struct_of(n=[], marked=[], first=[], second=[], first_byte=[], second_byte=[])][:0]
        for lo, hi in slices(offsets):
            r = Resolved(a, data, offsets[lo : hi + 1])
            first, second = drawn(r.totals, x[lo:hi], y[lo:hi])
            each = np.arange(hi - lo)
            out.append(struct_of(n=r.totals, marked=r.marked, first=first, second=second, first_byte=r.byte_of(each, first), second_byte=r.byte_of(each, second)))
        return pa.concat_arrays(out)

    return run


def piece_functions(a: Automaton):
    """Struct of the function of each piece of bytes, none of which is empty."""

    @F.arrow_udf("ends array<int>, counts array<long>, found array<boolean>")
    def run(pieces: pa.Array) -> pa.Array:
        data, offsets = bytes_of(pieces)
        out = []
        for lo, hi in slices(offsets):
            f = Resolved(a, data, offsets[lo : hi + 1]).functions()
            at = pa.array(np.arange(hi - lo + 1, dtype=np.int32) * a.size)
            lists = [pa.ListArray.from_arrays(at, pa.array(x.T.ravel())) for x in (f.ends.astype(np.int32), f.counts, f.found)]
            out.append(pa.StructArray.from_arrays(lists, ["ends", "counts", "found"]))
        return pa.concat_arrays(out)

    return run


def compose_pieces(frame: pd.DataFrame) -> pd.DataFrame:
    """One text's pieces, in one row: entry states, units before each, all units, whether marked."""
    frame = frame.sort_values("piece")
    f = Functions(*(np.stack(frame[c].to_list(), 1) for c in ("ends", "counts", "found")))
    f = prefixes(f, np.arange(len(frame)))
    entry, before = np.concatenate([[0], f.ends[0, :-1]]), np.concatenate([[0], f.counts[0, :-1]])
    return pd.DataFrame({"key": [frame["key"].iloc[0]], "entry": [entry.tolist()], "before": [before.tolist()], "n": [int(f.counts[0, -1])], "marked": [bool(f.found[0, -1])]})


def cuts_of_pieces(a: Automaton, piece: int):
    """Struct of cuts of texts of which the pieces are composed: only the pieces that hold a cut are scanned."""

    @F.arrow_udf(CUTS)
    def run(texts: pa.Array, h1: pa.Array, h2: pa.Array, n: pa.Array, marked: pa.Array, entry: pa.Array, before: pa.Array) -> pa.Array:
        data, offsets = bytes_of(texts)
        units = n.to_numpy(zero_copy_only=False)
        pair = drawn(units, h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False))
        at = np.stack([np.diff(offsets)] * 2)
        for k, cut in enumerate(pair):
            for i in np.flatnonzero(cut < units):
                passed = before[i].values.to_numpy()
                p = int(np.searchsorted(passed, cut[i], side="right")) - 1
                lo = offsets[i] + p * piece
                r = Resolved(a, data, np.array([lo, min(lo + piece, offsets[i + 1])]), np.array([entry[i].values[p].as_py()]))
                at[k, i] = p * piece + r.byte_of(np.array([0]), np.array([cut[i] - passed[p]]))[0]
        return struct_of(n=units, marked=marked.to_numpy(zero_copy_only=False), first=pair[0], second=pair[1], first_byte=at[0], second_byte=at[1])

    return run


def check_sentinels(sentinels: Sequence[str]) -> None:
    """Raise unless an output can be taken apart at its sentinels whatever its parts are."""
    if len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    for a in sentinels:
        for b in sentinels:
            if a != b and a in b or any(b.startswith(a[k:]) for k in range(1, len(a))):
                raise ValueError(f"{a} and {b} may overlap")


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four numbers of 32 bits from the document's id."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(
    docs: DataFrame, units: str = "characters", sentinels: Sequence[str] = SENTINELS, percent: int = 90, spm_percent: int = 20, seed: int = 1, piece: int = 1 << 16
) -> DataFrame:
    """``docs`` with ``text`` in its new form; adds form, n_units, prefix_units, middle_units, first_byte and second_byte.

    ``percent`` of the texts are cut, ``spm_percent`` of these put the suffix first. The units and bytes of plain texts
    are null, but for n_units.
    """
    check_sentinels(sentinels)
    a = automaton(units, sentinels)
    rows = packed(docs).select("doc", F.coalesce("doc.text", F.lit("")).alias("t"), F.array(*draws(F.col("doc.doc_id"), seed)).alias("h"))
    h = [F.col("h")[k] for k in range(4)]
    large = rows.where(F.octet_length("t") > piece).withColumn("key", F.sha2("t", 256))

    places = F.sequence(F.lit(0), F.expr(f"cast((octet_length(t) - 1) div {piece} as int)"))
    parts = F.transform(places, lambda k: F.struct(k.alias("piece"), F.substring(F.col("t").cast("binary"), k * piece + 1, F.lit(piece)).alias("bytes")))
    dealt = large.select("key", F.col("doc.doc_id").alias("id"), F.explode(parts).alias("p")).select("key", "id", "p.*").repartition("key", "piece", "id")
    functions = dealt.select("key", "piece", piece_functions(a)("bytes").alias("f")).groupBy("key", "piece").agg(F.any_value("f").alias("f"))
    composed = functions.select("key", "piece", "f.*").groupBy("key").applyInPandas(compose_pieces, "key string, entry array<int>, before array<long>, n long, marked boolean")

    within = rows.where(F.octet_length("t") <= piece).select("doc", "t", "h", cuts_within(a)("t", h[0], h[1]).alias("cut"))
    across = large.join(composed, "key").select("doc", "t", "h", cuts_of_pieces(a, piece)("t", h[0], h[1], "n", "marked", "entry", "before").alias("cut"))
    cut = within.unionByName(across)

    plain = (F.octet_length("t") == 0) | F.col("cut.marked") | (h[2] % 100 >= percent)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    raw, one, two = F.col("t").cast("binary"), F.col("cut.first_byte").cast("int"), F.col("cut.second_byte").cast("int")
    prefix, middle, suffix = (F.substring(raw, x + 1, y - x).cast("string") for x, y in ((F.lit(0), one), (one, two), (two, F.octet_length("t"))))
    p, s, m = map(F.lit, sentinels)
    text = F.when(F.col("form") == "plain", F.col("t")).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.concat(p, prefix, s, suffix, m, middle))
    shown = lambda c: F.when(F.col("form") != "plain", c)
    return cut.withColumn("form", form).select(*unpacked(
        docs.columns, text=text, form=F.col("form"), n_units=F.col("cut.n"), prefix_units=shown(F.col("cut.first")),
        middle_units=shown(F.col("cut.second") - F.col("cut.first")), first_byte=shown(F.col("cut.first_byte")), second_byte=shown(F.col("cut.second_byte")),
    ))


def restored(text: Column, form: Column, sentinels: Sequence[str] = SENTINELS) -> Column:
    """The text that ``transform`` was given."""
    p, s, m = sentinels

    def taken_apart(first: str, second: str, third: str) -> tuple[Column, Column, Column]:
        rest = F.substring(text, F.lit(len(first) + 1), F.length(text))
        one = F.substring_index(rest, second, 1)
        rest = F.substring(rest, F.length(one) + len(second) + 1, F.length(rest))
        two = F.substring_index(rest, third, 1)
        return one, two, F.substring(rest, F.length(two) + len(third) + 1, F.length(rest))

    prefix, suffix, middle = taken_apart(p, s, m)
    suffix_, prefix_, middle_ = taken_apart(s, p, m)
    return F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix_, middle_, suffix_)).otherwise(text)
