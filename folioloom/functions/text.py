"""Text measures as columns. A null text gives null; ratios of an empty text are 0."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import EMOJI_RANGES, EOD, PUNCTUATION_FROM, PUNCTUATION_LONGER, PUNCTUATION_TO, SPAM_WORDS, WHITESPACE, special_characters, special_class

SPECIAL = special_class()
SPECIAL_CHARACTERS = special_characters() + "".join(chr(p) for a, b in EMOJI_RANGES for p in range(a, b + 1))
# What is not special. Letters and ASCII come first, so that the long class is tested for other characters only.
NOT_SPECIAL = rf"[A-Za-zÀ-ÖÙ-öù-ÿ\x00-\x08\x0e-\x1f\x7f[\x{{80}}-\x{{10ffff}}&&[^{SPECIAL}]]]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, as the variable of a one-element array's lambda."""
    return F.transform(F.array(value), body)[0]


def remove_non_printing(t: Column) -> Column:
    return F.regexp_replace(t, r"[\x00-\x1f\x7f-\x9f]", "")


def standardize_whitespace(t: Column) -> Column:
    return F.translate(t, WHITESPACE, " " * len(WHITESPACE))


def split_on_whitespace(t: Column, new_line: bool = True, tab: bool = True) -> Column:
    chars = " " + "\\n" * new_line + "\\t" * tab
    return F.filter(F.split(t, f"[{chars}]"), lambda w: w != "")


def strip(t: Column, char_class: str = SPECIAL) -> Column:
    return F.regexp_replace(t, f"^[{char_class}]+|[{char_class}]+$", "")


def words(t: Column, lower: bool = True, strip_class: str | None = SPECIAL) -> Column:
    """White-space separated words, lower-cased and stripped of special characters at both ends; empty ones dropped.

    One expression finds a word from its first to its last character that is not special.
    """
    t = F.lower(t) if lower else t
    if strip_class is None:
        return split_on_whitespace(t)
    inner = NOT_SPECIAL if strip_class == SPECIAL else rf"[^ \n\t{strip_class}]"
    return F.regexp_extract_all(t, F.lit(rf"{inner}(?:[^ \n\t]*{inner})?"), F.lit(0))


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).when(whole.isNotNull(), 0.0)


def special_ratio(t: Column, characters: str = SPECIAL_CHARACTERS) -> Column:
    return ratio(F.length(t) - F.length(F.translate(t, characters, "")), F.length(t))


def lexicon_ratio(found_words: Column, lexicon: Iterable[str]) -> Column:
    """Share of words that are in a word list; serves stop, flagged, common and spam words."""
    listed = list(lexicon)
    return let(found_words, lambda ws: ratio(F.size(F.filter(ws, lambda w: w.isin(listed))), F.size(ws)))


def spam_ratio(t: Column) -> Column:
    return lexicon_ratio(words(t), SPAM_WORDS)


def punctuation_ratio(t: Column, marks: str = ",;:?!.", least_tokens: int = -1) -> Column:
    """Share of punctuation among tokens; 1 for texts of fewer than ``least_tokens`` tokens, if that is positive."""

    def of(tokens: Column) -> Column:
        n = F.size(tokens)
        share = ratio(F.size(F.filter(tokens, lambda x: x.isin(list(marks)))), n)
        return share if least_tokens <= 0 else F.when((n > 0) & (n < least_tokens), 1.0).otherwise(share)

    return let(F.regexp_extract_all(t, F.lit(rf"[\p{{L}}\p{{N}}_']+|[{marks}]"), F.lit(0)), of)


def replace_digits(t: Column) -> Column:
    return F.regexp_replace(t, r"\p{Nd}", "0")


def replace_punctuation(t: Column) -> Column:
    t = F.translate(t, PUNCTUATION_FROM, PUNCTUATION_TO)
    for a, b in PUNCTUATION_LONGER.items():
        t = F.replace(t, F.lit(a), F.lit(b))
    return t


def normalize(t: Column, non_printing=True, trim=True, lower=True, whitespace=True, digits=True, punctuation=True) -> Column:
    for wanted, step in ((non_printing, remove_non_printing), (trim, F.trim), (lower, F.lower), (whitespace, standardize_whitespace), (digits, replace_digits), (punctuation, replace_punctuation)):
        t = step(t) if wanted else t
    return t


def repetition_of_counts(counts: np.ndarray, whole: int) -> float:
    """Share of the most frequent n-grams: as many as the root of their number, but none that occurs once."""
    counts = np.sort(counts)[::-1]
    k = min(int(np.sqrt(len(counts))), int((counts > 1).sum()))
    return float(counts[:k].sum() / whole) if whole else 0.0


def runs_of(ids: np.ndarray, n: int) -> np.ndarray:
    """A number for each run of ``n`` of ``ids``, equal for equal runs: shorter runs are paired, and numbered anew when they grow large."""
    width, kinds = 1, int(ids.max(initial=0)) + 1
    while width < n:
        step = min(width, n - width)
        if kinds >= 2**31:
            found, ids = np.unique(ids, return_inverse=True)
            kinds = len(found)
        ids = ids[:-step] * kinds + ids[step:]
        width, kinds = width + step, kinds * kinds
    return ids


SHORT = 2000  # code points of a text for which a set of its runs costs less than arrays


def ranks(points: np.ndarray) -> np.ndarray:
    """The place of each code point among the different ones, without sorting."""
    kinds = np.zeros(int(points.max()) + 1, np.int64)
    kinds[points] = 1
    return (np.cumsum(kinds) - 1)[points]


def _char_repetition(t: str, n: int) -> float:
    whole = len(t) - n + 1
    if whole < 1 or len(t) <= SHORT and len({t[k : k + n] for k in range(whole)}) == whole:
        return 0.0
    points = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
    runs = runs_of(np.unique(points, return_inverse=True)[1] if len(t) <= SHORT else ranks(points), n)
    return repetition_of_counts(np.unique(runs, return_counts=True)[1], len(runs))


def char_repetition_ratio(t: Column, n: int = 10) -> Column:
    """Share of the most repeated runs of n code points (whole texts, Arrow batches)."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else _char_repetition(x, n) for x in texts], dtype="float64")

    return run(t)


def _word_repetition(ws, n: int) -> float:
    if len(ws) < n or len(ws) <= SHORT and len(set(zip(*(ws[k:] for k in range(n))))) == len(ws) - n + 1:  # noqa: B905
        return 0.0
    runs = runs_of(pd.factorize(np.asarray(ws, dtype=object))[0].astype(np.int64), n)
    counts = np.unique(runs, return_counts=True)[1]
    return float(counts[counts > 1].sum() / len(runs))


def word_repetition_ratio(found_words: Column, n: int = 5) -> Column:
    """Share of word n-grams that occur more than once."""

    @F.pandas_udf("double")
    def run(lists: pd.Series) -> pd.Series:
        return pd.Series([None if ws is None else _word_repetition(ws, n) for ws in lists], dtype="float64")

    return run(found_words)


def repetitive(texts: Column, found_words: Column, most_char: float | None, char_n: int, most_word: float | None, word_n: int) -> Column:
    """For each of an array of texts, whether either repetition ratio is above its limit; null for null texts."""

    @F.pandas_udf("array<boolean>")
    def run(arrays: pd.Series, words: pd.Series) -> pd.Series:
        def one(t, ws):
            return most_char is not None and _char_repetition(t, char_n) > most_char or most_word is not None and _word_repetition(ws, word_n) > most_word

        return pd.Series([None if ts is None else [None if t is None else one(t, ws) for t, ws in zip(ts, wss, strict=True)] for ts, wss in zip(arrays, words, strict=True)], dtype=object)

    return run.asNondeterministic()(texts, found_words)  # so that Spark doesn't move it into a lambda, where it can't run


def paragraphs(t: Column, separator: str = "\n\n") -> Column:
    return F.split(t, separator)


def is_sentinel(p: Column) -> Column:
    return F.trim(p) == EOD


def decode_json(t: Column, schema: str) -> Column:
    return F.from_json(t, schema)
