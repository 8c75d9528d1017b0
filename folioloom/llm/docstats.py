"""Whole-text document statistics that the quality operators learn from."""

from __future__ import annotations

from collections import Counter

import numpy as np

from .common import SPACES

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = b"0123456789"
_SYMBOL = b"#*$%&|<>"
_PUNCT = b".,;:?!"

WINDOW = 8

#: name of each statistic, in the order of ``features``
NAMES = [
    "log_words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share",
    "punct_share", "bang_share", "bar_share", "distinct_share", "words_per_line", "top_word_share", "stopped_share",
    "longest_word", "short_word_share", "byte_entropy", "capital_word_share", "log_lines", "non_ascii_share",
]


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words covered by windows of ``window`` (a power of two) ids that occur at least twice.

    Windows are ranked by doubling: equal pairs, pairs of pairs, and so on, so equality is exact. A window repeats
    only if its halves do, so each level keeps just the starts whose two halves were both seen twice.
    """
    n = len(ids)
    if n <= window:
        return 0
    starts, rank, width = np.arange(n), ids.astype(np.int64), 1
    full = np.full(n, -1, np.int64)
    while width < window:
        full[:] = -1
        full[starts] = rank
        starts = starts[starts + width < n]
        starts = starts[full[starts + width] >= 0]
        left, right = full[starts], full[starts + width]
        width *= 2
        _, rank, times = np.unique(left * (n + 1) + right, return_inverse=True, return_counts=True)
        again = times[rank] > 1
        starts, rank = starts[again], rank[again]
        if not len(starts):
            return 0
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def statistics(text: str | None) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), features; a null text counts as an empty one."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), len(raw)
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = size - len(raw.translate(None, _SYMBOL))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n_dup = len(lines) - len(set(lines))
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    n_repeat = repeated_words(ids)
    base = (n, word_chars, n_symbols, n_dup, n_repeat)
    if not n:
        return base, [0.0] * len(NAMES)

    def share(chars: bytes) -> float:
        return (size - len(raw.translate(None, chars))) / size

    letters = share(_UPPER) + share(_LOWER)
    lengths = np.fromiter(map(len, words), np.int64, n)
    top = int(np.bincount(ids).max())
    p = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / size
    p = p[p > 0]
    ends = Counter(w[-1] for w in words)
    firsts = Counter(w[0] for w in words)
    return base, [
        float(np.log1p(n)), word_chars / n, n_symbols / size, n_dup / max(1, len(lines)), n_repeat / n,
        share(_UPPER) / max(letters, 1e-9), share(_DIGIT), share(_PUNCT), raw.count(b"!") / n, raw.count(b"|") / n,
        len(seen) / n, float(np.log1p(n / max(1, len(lines)))), top / n, sum(ends[c] for c in _PUNCT) / n,
        float(np.log1p(lengths.max())), float((lengths <= 2).mean()), float(-(p * np.log2(p)).sum()),
        sum(firsts[c] for c in _UPPER) / n, float(np.log1p(len(lines))), float((np.frombuffer(raw, np.uint8) > 127).mean()),
    ]
