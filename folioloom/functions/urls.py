"""Address helpers as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import URL_BAN_WORDS

# Fixed value: what counts as a valid address.
VALID = r"(?i)^(?:http|ftp)s?://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+(?:[A-Z]{2,6}\.?|[A-Z0-9-]{2,}\.?))(?:/?|[/?]\S+)$"


def netloc(url: Column) -> Column:
    """Authority with port and user, case kept; empty when there is none. Never raises."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def is_valid(url: Column) -> Column:
    return url.rlike(VALID)


def is_banned(url: Column) -> Column:
    return url.rlike("|".join(URL_BAN_WORDS))


# Fixed value: steps to this or the folder above, which go from a relative address.
STEPS = r"\.+/"


def absolute(page_url: Column, path: Column) -> Column:
    bare = F.regexp_replace(path, STEPS, "")
    rooted = F.when(bare.startswith("/"), bare).otherwise(F.concat(F.lit("/"), bare))
    return F.when(path.startswith("//"), F.concat(F.lit("http:"), path)).otherwise(F.concat(F.lit("https://"), netloc(page_url), rooted))


# What stands between the words of a file name, sizes that leave nothing, and leftover marks.
GAP = "(?:[0-9]+x[0-9]+|[0-9]+|[ _-]|%20*)+"
SIZE = "[0-9]+x[0-9]+"
MARK = r"%B|[%+\n]"
NAME_TOKEN = rf"{GAP}|{MARK}|[^0-9 _%+\n-]+"
BLANK = r"[0-9 _%+\n-]"


def readable_name(url: Column) -> Column:
    """Words of an image address's file name; empty if it is a query or has at most one character.

    A name is read as words, gaps and marks: a gap becomes one space (none if it is but a size), a mark one space.
    """
    name = F.regexp_extract(url, r"([^/.]*)(?:\.[^/]*)?$", 1)
    shown = F.transform(
        F.regexp_extract_all(name, F.lit(NAME_TOKEN), F.lit(0)),
        lambda token: F.when(token.rlike(f"^{SIZE}$"), "").when(token.rlike(f"^{BLANK}"), " ").otherwise(token),
    )
    text = F.trim(F.array_join(shown, ""))
    return F.when((F.length(text) > 1) & ~name.rlike(r"\?[A-Za-z0-9]+="), text).otherwise("")


# Names that stand for the full width, and forms of a rendered size.
FULL_WIDTH = ["full-width", "auto"]
WHOLE, DECIMAL = r"^\s*([+-]?\d+)\s*$", r"^\s*[+-]?\d*\.\d*\s*$"


def size_text(size: Column) -> Column:
    """A rendered size as digits or "NN%"; null when it is neither."""
    bare = F.translate(size, '”"<>', "")
    pixels, share = bare.contains("px"), bare.contains("%")
    plain = ~pixels & ~share
    readings = (
        F.when(pixels, F.nullif(F.regexp_extract(F.translate(bare, "px;", ""), WHOLE, 1), F.lit(""))),
        F.when(~pixels & share, F.trim(bare)),
        F.when(plain & (bare.rlike(WHOLE) | bare.rlike(DECIMAL)), F.trim(bare).try_cast("double").cast("long").cast("string")),
        F.when(bare.isin(FULL_WIDTH), "100%"),
    )
    return F.coalesce(*readings)
