"""Packing: first-fit decreasing into sequences of a fixed length, with a tournament tree of bin capacities.

Each document's ids (and an end id) are cut into full pieces and one rest. Documents are dealt at random into groups
of about ``group_rows``; each group packs its rests by itself: longest first, each into the first bin with room, which
a tournament tree over the bins' free capacities finds in a logarithm of steps. Groups are small whatever the input
holds, because the deal goes by row and not by any value.

Defined results: a null text is an empty one (one piece, the end id alone); repeated rows are packed each; whole texts
of any length are kept; an empty table gives an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import re
import zlib
from functools import cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import PATTERN, byte_letters, check, load
from .common import map_rows, parts

ENDLESS = re.compile(r"(?<!\s)\s{50000}").search  # from the first of a run only, so a text is read once
PIECES = T.StructType([
    T.StructField("grp", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
])
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@cache
def encoder(source: str):
    """Text to ids, equal to those of the tokenizers library for a byte-level BPE in its JSON format.

    The faster library's pattern matcher overflows on about a million white-space characters in a row; texts with such
    runs go to the encoder of ``bpe``.
    """
    import json

    spec = json.loads(source)
    check(spec)
    to_byte = {c: b for b, c in enumerate(byte_letters())}
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(to_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
    made = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)

    def encode(text: str) -> list[int]:
        if ENDLESS(text):
            return np.frombuffer(load(source).encode(text), "<u4").tolist()
        if any(t in text for t in added):
            return made.encode(text, allowed_special="all")
        return made.encode_ordinary(text)

    return encode


def pieces(docs: DataFrame, vocabulary: str, size: int, end_id: int, groups: int) -> DataFrame:
    """A row per piece of at most ``size`` ids; all pieces of a document are in its randomly drawn group."""
    with open(vocabulary, encoding="utf-8") as f:
        source = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(doc_ids, texts):
        encode = encoder(source.value)
        # Drawn anew for each batch from its place and contents: the same when a task is repeated.
        draw = np.random.default_rng([TaskContext.get().partitionId(), zlib.crc32(repr(doc_ids).encode())])
        for i, t, g in zip(doc_ids, texts, draw.integers(groups, size=len(doc_ids)).tolist(), strict=True):
            ids = np.array([*encode(t or ""), end_id], "<u4")
            for at in range(0, len(ids), size):
                piece = ids[at : at + size]
                yield g, i, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)

    return map_rows(docs, ["doc_id", "text"], run, PIECES)


def first_fit(lengths: list[int], size: int) -> list[int]:
    """The bin of each length, taken in order; a bin holds ``size``."""
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    room = [size] * (2 * leaves)  # the winner of a match is the larger room
    out = []
    for n in lengths:
        k = 1
        while k < leaves:
            k *= 2
            if room[k] < n:
                k += 1
        out.append(k - leaves)
        room[k] -= n
        while k > 1:
            k //= 2
            room[k] = max(room[2 * k], room[2 * k + 1])
    return out


def pack(docs: DataFrame, vocabulary: str, size: int = 1024, end_id: int = 0, group_rows: int = 8192) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    groups = parts(docs.count(), group_rows)

    def run(key, frame):
        frame = frame.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        bins = np.array(first_fit(frame["length"].tolist(), size), np.int64)
        before = frame["length"].groupby(bins).cumsum() - frame["length"]
        return pd.DataFrame({c: frame[c] for c in frame.columns if c != "grp"} | {"sequence_id": (int(key[0]) << 32) + bins, "offset": before})

    cut = pieces(docs, vocabulary, size, end_id, groups)
    return cut.groupBy("grp").applyInPandas(run, PACKED)
