"""Repetition of short texts costs no array as long as the largest code point."""

import tracemalloc

from folioloom.functions import text as T


def test_short_texts_with_large_code_points():
    texts = ["an \U0001f600 smiles at another", "\U0001f600 again, and again, " * 4]
    tracemalloc.start()
    once, again = (T._char_repetition(t, 10) for t in texts)
    assert tracemalloc.get_traced_memory()[1] < 200_000
    tracemalloc.stop()
    assert once == 0.0 < again
    assert T._word_repetition("a b c d e f".split(), 5) == 0.0 and T._word_repetition("a b c d e a b c d e".split(), 5) == 2 / 6
