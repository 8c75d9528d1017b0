"""The charset of bytes that declare none, from what they decode to: no table of languages, only what letters do in words."""

from __future__ import annotations

import codecs
import unicodedata
from functools import lru_cache

MARKS = [(codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF32_LE, "utf-32"), (codecs.BOM_UTF32_BE, "utf-32"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")]
SEVERAL_BYTES = ["shift_jis", "euc_jp", "euc_kr", "gb18030", "big5"]
ONE_BYTE = ["windows-1252", "iso-8859-2", "windows-1250", "windows-1251", "koi8-r", "windows-1253", "windows-1254"]
LEAST = 0.25  # a charset whose characters seem less likely than this is not taken
HEAD = 1 << 16  # characters that are judged, of those beyond ASCII

# How likely a character beyond ASCII is in plain text, by its block: (first, last, weight).
BLOCKS = [
    (0x3040, 0x30FF, 1.6), (0xAC00, 0xD7A3, 1.2), (0x3000, 0x303F, 0.6), (0x4E00, 0x9FA5, 0.7), (0xFF01, 0xFF5E, 0.4), (0xFF61, 0xFF9F, -0.6),
    (0x0400, 0x045F, 1.0), (0x0370, 0x03FF, 1.0), (0x00DF, 0x00FF, 0.8), (0x00C0, 0x00DE, 0.5), (0x0100, 0x017F, 0.8), (0x2010, 0x2026, 0.6), (0x20AC, 0x20AC, 0.5),
    (0x0080, 0x009F, -3.0), (0xE000, 0xF8FF, -3.0), (0x2500, 0x25FF, -1.5),
]
# Letters and marks that are more or less likely than their block.
SINGLE = dict.fromkeys("ìòøùïûî", 0.6) | dict.fromkeys("ŕĺŔĹ", 0.3) | dict.fromkeys("¿¡«»§°·", 0.3) | {"\u00a0": 0.0}
# First characters of the first level of the Chinese national set: those in daily use come before the rare ones.
DAILY = (0xB0, 0xD7)


@lru_cache(1 << 16)
def weight(c: str) -> float:
    p = ord(c)
    if c in SINGLE:
        return SINGLE[c]
    for first, last, w in BLOCKS:
        if first <= p <= last:
            return w if c.isalnum() or w < 0 or p > 0x2000 else -0.6
    return 0.2 if c.isalpha() else -0.6 if p < 0x2000 else -0.2


@lru_cache(1 << 16)
def script(c: str) -> str:
    return unicodedata.name(c, "?").split(" ", 1)[0] if c.isalpha() else ""


def likeness(text: str) -> float:
    """Mean weight of the characters beyond ASCII, less where a word changes its script or has a capital after a small letter."""
    total, n, before = 0.0, 0, " "
    for c in text:
        if c > "\x7f":
            n += 1
            total += weight(c)
            if before.isalpha():
                if c.isupper() and before.islower():
                    total -= 1.2
                elif script(c) != script(before) and {script(c), script(before)} & {"CYRILLIC", "GREEK", "LATIN"}:
                    total -= 1.2
        elif c.isupper() and before.islower() and before > "\x7f":
            total -= 1.2
        before = c
        if n >= HEAD:
            break
    return total / n if n else 0.0


def common_share(data: bytes) -> float:
    """Share of two-byte characters in the rows of daily use of the Chinese national set."""
    lead, daily, k = 0, 0, 0
    while k < len(data):
        two = data[k] >= 0x81
        lead, daily, k = lead + two, daily + (two and DAILY[0] <= data[k] <= DAILY[1]), k + 1 + two
    return daily / lead if lead else 0.0


def detect(data: bytes) -> str:
    """The likeliest charset; windows-1252 where no other seems likely enough, ASCII is UTF-8.

    UTF-16 without a mark is told by the zeros of ASCII characters, so only in pages that have some.
    """
    for mark, name in MARKS:
        if data.startswith(mark):
            return name
    sample = data[: 4 * HEAD]
    zeros = [sample[k::2].count(0) for k in (0, 1)]
    if sum(zeros) > len(sample) // 8 or max(zeros) > 4 * (min(zeros) + 1) and max(zeros) > len(sample) // 20:
        return "utf-16-be" if zeros[0] > zeros[1] else "utf-16-le"
    try:
        data.decode("utf-8")
        return "utf-8"
    except UnicodeDecodeError:
        pass
    best, found = LEAST, "windows-1252"
    for name in [*ONE_BYTE, *SEVERAL_BYTES]:
        decoder = codecs.getincrementaldecoder(name)("strict")
        try:
            text = decoder.decode(sample, final=len(sample) == len(data))
        except UnicodeDecodeError:
            continue
        score = likeness(text)
        if name == "gb18030":  # takes almost any bytes
            score *= 0.6 + 0.5 * common_share(sample)
        if score > best:
            best, found = score, name
    return found
