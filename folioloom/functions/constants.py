"""Fixed values that the text and page operators depend on."""

import string

# Characters that count as special besides ASCII punctuation, digits and white space.
OTHER_SPECIAL = (
    "    　    ￼’“”–ー一▬…✦�­£​•€«»°·═"
    "×士＾˘⇓↓↑←→（）§″′´¿−±∈﻿¢ø‚„½¼¾¹²³―⁃，ˌ¸‹›ʺˈʻ¦‐⠀‰‑≤≥‖"
    "◆●■►▼▲▴∆▻¡★☆✱ːº。¯˜¥ɪ≈†上ン：∼⁄・♡✓⊕․．⋅÷１‟；،、¨ाাी्े◦˚"
    "゜ʼ≖ʼ¤ッツシ℃√！【】‿∞➤～πه۩☛₨➩☻๑٪♥ıॽ《‘©﴿٬？▷Г♫∟™ª₪®「—❖"
    "」﴾》"
)

# Emoji as ranges of code points: an approximation of our own, not a list of single characters.
EMOJI_RANGES = [(0x203C, 0x203C), (0x2049, 0x2049), (0x2139, 0x2139), (0x2194, 0x2199), (0x21A9, 0x21AA), (0x231A, 0x231B), (0x23E9, 0x23F3), (0x25AA, 0x25AB), (0x2600, 0x27BF), (0x2B05, 0x2B55), (0x1F004, 0x1F004), (0x1F170, 0x1F251), (0x1F300, 0x1FAFF)]

# Characters that count as white space when it is standardised.
WHITESPACE = " \u2009\u200a\u202f\u2005\u3000\u2002\u2008\u2003\ufffc\u0084\u00a0"

# Unicode punctuation and its ASCII form.
PUNCTUATION_FROM = "，。、„”“«»１」「《》´∶：？！（）；–～’━〈〉【】％►"
PUNCTUATION_TO = ",.,\"\"\"\"\"\"\"\"\"\"'::?!();-~'-<>[]%-"
PUNCTUATION_LONGER = {"—": " - ", "．": ". ", "…": "..."}

# Words that hint at spam, and the share of them from which a paragraph goes.
SPAM_WORDS = (
    "facebook twitter instagram reddit youtube pinterest flickr share tweet post comment subscribe newletter blogger bloggers interested "
    "might like sign-up sign log logged access contact content privacy policy website cookies cookie licensed password account follow terms "
    "mailing list download loading click"
).split()
SPAM_SHARE = 0.12

# Image addresses with one of these are not wanted.
URL_BAN_WORDS = ["logo", "button", "icon", "plugin", "widget", "porn", "xxx", "sex"]

# Fixed value: the paragraph that stands where a "more" link was.
EOD = "END_OF_DOCUMENT_TOKEN_TO_BE_REPLACED"

# Tags that only style text, and tags that stay, with the separator that a text tag implies.
UNWRAP_TAGS = set("a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd mark q s samp shadow small span strike strong sub sup time tt u var wbr".split())
MEDIA_TAGS = set("audio embed figure iframe img object picture video".split())
SEPARATORS = {
    **dict.fromkeys("blink body caption h html title br".split(), ""),
    **dict.fromkeys("address article aside center dd dt div figcaption hgroup legend main marquee section summary".split(), "\n"),
    **dict.fromkeys("blockquote dl h1 h2 h3 h4 h5 h6 ol p ul".split(), "\n\n"),
}
KEPT_TAGS = set(SEPARATORS) | MEDIA_TAGS | {"source"}
IMAGE_SOURCES = "src data-src data-src-fg data-scroll-image srcset data-lateloadsrc data-img-src data-original data-gt-lazy-src data-lazy data-lazy-src src2".split()
NAVIGATION = {"footer", "header", "navigation", "nav", "navbar", "menu"}


def special_characters() -> str:
    """The special characters without emoji, in order."""
    return "".join(sorted({*string.punctuation, *string.digits, *string.whitespace, *OTHER_SPECIAL}))


def special_class() -> str:
    """All special characters as the inside of a regular expression's class, written as ranges of code points."""
    points = sorted({ord(c) for c in special_characters()} | {p for a, b in EMOJI_RANGES for p in range(a, b + 1)})
    out, first = "", points[0]
    for p, after in zip(points, [*points[1:], -1], strict=True):
        if after != p + 1:
            out += f"\\x{{{first:x}}}" + (f"-\\x{{{p:x}}}" if p > first else "")
            first = after
    return out
