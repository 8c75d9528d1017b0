"""Node and document filters with one reason per rejection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.constants import EOD
from .documents import is_media


@dataclass
class TextLimits:
    """Limits of the text checks; None turns a check off. The defaults are those of nodes."""

    least_words: int | None = 4
    most_words: int | None = 1000
    char_repetition: float | None = 0.1
    char_repetition_n: int = 10
    word_repetition: float | None = 0.1
    word_repetition_n: int = 5
    special: float | None = 0.3
    stopwords: float | None = 0.3
    flagged: float | None = 0.01
    punctuation: float | None = 0.001
    punctuation_tokens: int = 12
    common: float | None = 0.8
    language: float | None = None
    perplexity: float | None = None
    stopword_list: Sequence[str] = field(default_factory=list)
    flagged_list: Sequence[str] = field(default_factory=list)
    common_list: Sequence[str] = field(default_factory=list)

    @classmethod
    def of_documents(cls, **changes) -> TextLimits:
        whole = {"least_words": 10, "most_words": 2000, "word_repetition": 0.2, "special": 0.275, "stopwords": 0.35, "punctuation": 0.03, "punctuation_tokens": -1, "common": 0.9, "language": 0.8, "perplexity": 1500}
        return cls(**whole | changes)

    @classmethod
    def from_yaml(cls, path: str, level: str = "node", **lists) -> TextLimits:
        """Limits from a file with this class's names, or with one switch and cutoffs per check and level ("node" or "doc").

        A check that is switched off has no limit. A file with neither kind of names raises.
        """
        import yaml

        with open(path) as f:
            given = yaml.safe_load(f) or {}
        plain = {x.name: given[x.name] for x in fields(cls) if x.name in given}
        found = {}
        for switch, keys in CUTOFFS.items():
            for name, pattern in keys.items():
                key = pattern.format(level=f"{level}_level")
                if key in given:
                    found[name] = given[key] if given.get(f"cond_check_{switch}_{level}_level", True) or name.endswith(("_n", "_tokens")) else None
        if not plain and not found:
            raise ValueError(f"{path} has no limits for {level}s")
        start = cls.of_documents() if level == "doc" else cls()
        return replace(start, **found, **plain, **lists)


# The checks' switches in filter configurations, and the keys of their limits.
CUTOFFS = {
    "number_words": {"least_words": "number_words_{level}_min_cutoff", "most_words": "number_words_{level}_max_cutoff"},
    "character_repetition_ratio": {"char_repetition": "character_repetition_{level}_max_cutoff", "char_repetition_n": "character_repetition_length_{level}"},
    "word_repetition_ratio": {"word_repetition": "word_repetition_{level}_max_cutoff", "word_repetition_n": "word_repetition_length_{level}"},
    "special_character_ratio": {"special": "special_character_ratio_{level}_max_cutoff"},
    "stopword_ratio": {"stopwords": "stopword_ratio_{level}_min_cutoff"},
    "flagged_word_ratio": {"flagged": "flagged_word_ratio_{level}_max_cutoff"},
    "punctuation_ratio": {"punctuation": "punctuation_ratio_{level}_min_cutoff", "punctuation_tokens": "min_number_words_to_check_punctuation_ratio_{level}"},
    "common_word_ratio": {"common": "common_word_ratio_{level}_min_cutoff"},
    "lang_id": {"language": "lang_id_{level}_min_cutoff"},
    "perplexity_score": {"perplexity": "perplexity_score_{level}_max_cutoff"},
}


def text_reason(t: Column, limits: TextLimits, words: Column | None = None) -> Column:
    """The first check that a text fails (cheap checks first), or null. Only DataFrame functions: the two repetition checks,
    language and perplexity are separate columns (see ``scored_reason``)."""
    if words is None:
        return T.let(T.words(t), lambda ws: text_reason(t, limits, ws))
    n = F.size(words)
    checks: list[tuple[str, Column]] = []
    if limits.least_words is not None:
        checks.append(("words", ~n.between(limits.least_words, limits.most_words)))
    if limits.special is not None:
        checks.append(("special", T.special_ratio(t) > limits.special))
    if limits.stopwords is not None:
        checks.append(("stopwords", T.lexicon_ratio(words, limits.stopword_list) < limits.stopwords))
    if limits.flagged is not None:
        checks.append(("flagged", T.lexicon_ratio(words, limits.flagged_list) > limits.flagged))
    if limits.punctuation is not None:
        checks.append(("punctuation", T.punctuation_ratio(t, least_tokens=limits.punctuation_tokens) < limits.punctuation))
    if limits.common is not None:
        checks.append(("common", T.lexicon_ratio(words, limits.common_list) < limits.common))
    return first_failing(checks)


def first_failing(checks: list[tuple[str, Column]]) -> Column:
    out = F.lit(None).cast("string")
    for name, fails in reversed(checks):
        out = F.when(fails, name).otherwise(out)
    return out


def scored_reason(t: Column, limits: TextLimits, language: Callable[[Column], Column] | None = None, perplexity: Callable[[Column], Column] | None = None) -> Column:
    """The checks that need Python workers; apply them after ``text_reason`` has thinned the rows. A limit without its model raises."""
    for name, model in (("language", language), ("perplexity", perplexity)):
        if getattr(limits, name) is not None and model is None:
            raise ValueError(f"the limit of {name} is set, but no model for it is given")
    checks = []
    if limits.char_repetition is not None:
        checks.append(("char_repetition", T.char_repetition_ratio(t, limits.char_repetition_n) > limits.char_repetition))
    if limits.word_repetition is not None:
        checks.append(("word_repetition", T.word_repetition_ratio(T.words(t), limits.word_repetition_n) > limits.word_repetition))
    if limits.language is not None:
        checks.append(("language", ~F.coalesce(language(t), F.lit(False))))
    if limits.perplexity is not None:
        checks.append(("perplexity", perplexity(t) > limits.perplexity))
    return first_failing(checks)


def paragraph_rows(docs: DataFrame, keys: list[str], text: str = "text", separator: str = "\n\n") -> DataFrame:
    return docs.select(*keys, F.posexplode(T.paragraphs(F.col(text), separator)).alias("pos", "paragraph"))


def filter_paragraphs(docs: DataFrame, limits: TextLimits, text: str = "text", separator: str = "\n\n") -> DataFrame:
    """``docs`` with the rejected paragraphs taken out of ``text`` (null if none is left); sentinels always stay.

    Stays within the row: no shuffle, whatever the text's length.
    """
    kept = F.filter(T.paragraphs(F.col(text), separator), lambda p: (F.trim(p) == EOD) | text_reason(p, limits).isNull())
    return docs.withColumn(text, F.when(F.size(kept) > 0, F.array_join(kept, separator)))


def filter_nodes(docs: DataFrame, limits: TextLimits, image_ok: Callable[[Column], Column], separator: str = "\n\n") -> DataFrame:
    """Node filter: images by ``image_ok(meta)``, texts by paragraphs; nodes without either go, video and audio stay."""

    if limits.language is not None or limits.perplexity is not None:
        raise ValueError("language and perplexity of single paragraphs are not built; set their limits for whole documents")
    kept = lambda n: F.filter(F.split(n["text"], separator), lambda p: (F.trim(p) == EOD) | text_reason(p, limits).isNull())
    docs = docs.withColumn("_kept", F.transform("nodes", kept))
    if limits.char_repetition is not None or limits.word_repetition is not None:
        each = F.flatten(F.transform("_kept", lambda ps: F.coalesce(ps, F.array().cast("array<string>"))))
        again = T.repetitive(each, F.transform(each, lambda p: T.words(p)), limits.char_repetition, limits.char_repetition_n, limits.word_repetition, limits.word_repetition_n)
        bad = F.array_distinct(F.transform(F.filter(F.arrays_zip(each.alias("p"), again.alias("again")), lambda x: x["again"] & (F.trim(x["p"]) != EOD)), lambda x: x["p"]))
        docs = docs.withColumn("_bad", bad)
        docs = docs.withColumn("_kept", F.transform("_kept", lambda ps: F.filter(ps, lambda p: ~F.array_contains("_bad", p)))).drop("_bad")

    def cleaned(n: Column, k: Column) -> Column:
        words = F.get("_kept", k)
        return F.struct(F.when(F.size(words) > 0, F.array_join(words, separator)).alias("text"), F.when(is_media(n["meta"]) | image_ok(n["meta"]), n["meta"]).alias("meta"))

    nodes = F.filter(F.transform("nodes", cleaned), lambda n: n["text"].isNotNull() | n["meta"].isNotNull())
    return docs.withColumn("nodes", nodes).drop("_kept")


def image_format_ok(meta: Column, formats: Sequence[str] = ("jpg", "jpeg", "png", "webp")) -> Column:
    return meta["format"].isNull() | meta["format"].isin(list(formats))


def rendered(size: Column, original: Column) -> Column:
    """A rendered size in pixels: percentages of the original, half to even; null when it can't be read."""
    percent = F.regexp_extract(size, r"^\s*(\d+(?:\.\d+)?)\s*%$", 1)
    return F.when(percent != "", F.bround(original * percent.cast("double") / 100).cast("int")).otherwise(size.try_cast("int"))


def image_size_ok(width: Column, height: Column, shown_width: Column, shown_height: Column, least: int = 150, most: int = 20000, least_ratio: float = 0.5, most_ratio: float = 2.0) -> Column:
    shown = lambda s: s.isNull() | s.between(least, most)
    return width.between(least, most) & height.between(least, most) & shown(shown_width) & shown(shown_height) & (width / height).between(least_ratio, most_ratio)


def image_ok(meta: Column) -> Column:
    w, h = meta["original_width"], meta["original_height"]
    sized = F.coalesce(image_size_ok(w, h, rendered(meta["rendered_width"], w), rendered(meta["rendered_height"], h)), F.lit(False))
    return meta.isNotNull() & image_format_ok(meta) & sized


def image_count_ok(n: Column, least: int = 1, most: int = 30) -> Column:
    return n.between(least, most)


def has_text_and_image(texts: Column) -> Column:
    """At least one text, and at least one empty slot, which stands for an image."""
    full = lambda t: t.isNotNull() & (t != "")
    return F.exists(texts, full) & F.exists(texts, lambda t: ~full(t))


def not_only_sentinels(texts: Column) -> Column:
    return F.exists(F.filter(texts, lambda t: t.isNotNull() & (t != "")), lambda t: F.trim(t) != EOD)


def split_retained(docs: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Retained and discarded rows; together they are ``docs``."""
    marked = docs.withColumn("reason", reason)
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")
