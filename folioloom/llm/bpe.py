"""Byte-level BPE: exact encoding by dynamic programming over prefixes, and decoding.

An Aho-Corasick automaton over the vocabulary reports, at each position of a pre-token, every token that ends there.
The last token of a prefix's encoding is unique: it is the one that is compatible with the last token of the prefix
before it. So one pass stores a token for each prefix and back-pointers give the ids.

Two tokens are compatible when BPE would not merge across their border: undo their merges from the latest to the
earliest and look, at each step, for a merge across the border that would have come first.

Defined results: an empty table gives an empty result; a null text is encoded as an empty one (no tokens); the added tokens' strings in a text become
their own ids; whole texts of any length are encoded; repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from functools import cache

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_rows

# Fixed value: the pattern of byte-level pre-tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT = 400_000  # pre-tokens and pairs that a worker remembers


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one above 255."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    extra = iter(range(256, 512))
    return [chr(b if b in plain else next(extra)) for b in range(256)]


class Remembered(dict):
    """Results of a function of short strings; emptied when it holds ``KEPT``."""

    def __init__(self, fn):
        self.fn = fn

    def __missing__(self, key: str) -> bytes:
        out = self.fn(key)
        if len(key) < 64:
            if len(self) >= KEPT:
                self.clear()
            self[key] = out
        return out


def check(spec: dict) -> None:
    """Raise for what this encoder doesn't do, instead of giving other ids."""
    plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    wrong = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    wrong += ["model.type"] if model.get("type", "BPE") != "BPE" else []
    wrong += ["normalizer"] if spec.get("normalizer") else []
    wrong += ["pre_tokenizer"] if {k: before.get(k, True) for k in plain} != plain else []
    wrong += ["decoder"] if (spec.get("decoder") or {}).get("type") != "ByteLevel" else []
    wrong += [f"added token {t['content']!r}" for t in spec.get("added_tokens", []) if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized")]
    if wrong:
        raise ValueError(f"not a plain byte-level BPE: {', '.join(wrong)}")


class Bpe:
    """A byte-level BPE vocabulary in the JSON format of the tokenizers library."""

    def __init__(self, source: str):
        spec = json.loads(source)
        check(spec)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.letters = byte_letters()
        to_byte = {c: bytes([b]) for b, c in enumerate(self.letters)}
        self.text = {i: b"".join(to_byte[c] for c in t) for t, i in vocab.items()}
        # Ranks order the tokens: a byte's is its letter's order, a merged token's is that of its merge.
        rank = {c: r for r, c in enumerate(self.letters)}
        self.halves: list[tuple[int, int]] = [(r, r) for r in range(256)]
        self.merged: dict[int, int] = {}
        for m in merges:
            a, b = m if isinstance(m, list) else m.split(" ")
            if a + b not in rank:
                rank[a + b] = len(self.halves)
                self.halves.append((rank[a], rank[b]))
            self.merged.setdefault(rank[a] << 20 | rank[b], rank[a + b])
        self.ids = [vocab.get(t, -1) for t in rank]
        self.code = [(i & 0xFFFFFFFF).to_bytes(4, "little") for i in self.ids]
        self.size = [len(t) for t in rank]
        self.automaton = ahocorasick.Automaton()
        for t, r in rank.items():  # over bytes, written as the letters U+0000 to U+00FF
            self.automaton.add_word(b"".join(to_byte[c] for c in t).decode("latin-1"), (r, len(t)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.cache = Remembered(self.encode_word)
        self.chunks = Remembered(self.encode_chunk)
        self.whole: dict[int, bool] = {}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.split_added = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.words = regex.compile(PATTERN).findall
        self.run_of_space = regex.compile(r"\s (?!\S)").search
        self.text |= {i: t.encode() for t, i in self.added.items()}

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves a border between tokens ``a`` and ``b``."""
        latest = len(self.halves)
        while True:
            m = self.merged.get(a << 20 | b)
            if m is not None and m < latest:
                return False
            undo_left = a > b  # of two equal ranks BPE merges the left one first, so the right one is undone first
            for _ in range(2):
                if undo_left and a >= 256:
                    latest, a = a, self.halves[a][1]
                    break
                if not undo_left and b >= 256:
                    latest, b = b + 1, self.halves[b][0]
                    break
                undo_left = not undo_left
            else:
                return True

    def alone(self, token: int) -> bool:
        """Whether BPE makes this token of its own text."""
        known = self.whole.get(token)
        if known is None:
            a, b = self.halves[token]
            known = self.whole[token] = token < 256 or self.alone(a) and self.alone(b) and self.merged.get(a << 20 | b) == token and self._joins(a, b, token)
        return known

    def _joins(self, a: int, b: int, token: int) -> bool:
        """Nothing merges across the border of ``a`` and ``b`` before they are complete."""
        while True:
            latest = max(a, b)
            if latest < 256:
                return True
            a, b = (self.halves[a][1], b) if a > b else (a, self.halves[b][0])
            m = self.merged.get(a << 20 | b)
            if m is not None and m < latest:
                return False

    def encode_word(self, word: str) -> bytes:
        """The ids of a pre-token as little-endian unsigned 32-bit integers."""
        s = word if word.isascii() else word.encode("utf-8").decode("latin-1")
        last: list[int] = [-1] * (len(s) + 1)
        pairs = self.pairs
        for end, (token, size) in self.automaton.iter(s):
            if last[end + 1] < 0:
                before = end + 1 - size
                if before:
                    left = last[before]
                    if left < 0:
                        continue
                    key = left << 20 | token
                    fits = pairs.get(key)
                    if fits is None:
                        if len(pairs) > KEPT:
                            pairs.clear()
                        fits = pairs[key] = self.compatible(left, token)
                else:
                    fits = self.alone(token)
                if fits:
                    last[end + 1] = token
        out, at = [], len(s)
        while at:
            token = last[at]
            out.append(self.code[token])
            at -= self.size[token]
        return b"".join(out[::-1])

    def encode(self, text: str) -> bytes:
        if self.split_added and any(t in text for t in self.added):
            pieces = self.split_added.split(text)
            return b"".join(self.added[p].to_bytes(4, "little") if p in self.added else self.encode_plain(p) for p in pieces)
        return self.encode_plain(text)

    def encode_plain(self, text: str) -> bytes:
        if self.run_of_space(text) or "\0" in text:
            return self.encode_chunk(text)
        # A space between other characters always starts a pre-token, so what lies between spaces is encoded alone.
        return b"".join(map(self.chunks.__getitem__, text.replace(" ", "\0 ").split("\0")))

    def encode_chunk(self, text: str) -> bytes:
        body = text[1:]
        if body.isalpha() and text[0] == " ":  # a single pre-token
            return self.cache[text]
        return b"".join(map(self.cache.__getitem__, self.words(text)))

    def decode(self, ids: memoryview) -> str:
        return b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")


@cache
def load(source: str) -> Bpe:
    return Bpe(source)


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType()),
])
DIGESTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
])


def encode(docs: DataFrame, vocabulary: str, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit) and the text decoded from them, or digests of the two.

    ``vocabulary`` is the path of the tokenizer's JSON file; the driver reads it and broadcasts it (a few MB).
    """
    with open(vocabulary, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(doc_ids, texts):
        bpe = load(source.value)
        for i, t in zip(doc_ids, texts, strict=True):
            ids = bpe.encode(t or "")
            decoded = bpe.decode(memoryview(ids).cast("I"))
            if digests:
                yield i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
            else:
                yield i, len(ids) // 4, ids, decoded

    return map_rows(docs, ["doc_id", "text"], run, DIGESTS if digests else SCHEMA)
