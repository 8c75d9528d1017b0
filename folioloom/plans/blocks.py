"""Texts in blocks of bounded size, and what blocks ask of buckets: the shuffles of models whose tables are as large as the corpus.

A row per occurrence of a word or a run, shuffled to its count and back, is many times the corpus. So texts are dealt to blocks;
a block sends each different key of its texts once, as one row of arrays per bucket of keys, and a bucket answers each such row with
an array in the same order. Blocks and buckets are groups of a Spark shuffle, more of them for a larger corpus, and each is worked on
by array functions. A bucket's order never depends on that of its rows, so that a block can be worked on again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "\n"  # between the tokens of a text
CHARACTERS = 10_000_000  # of a block
_MIX = np.uint64(0x9E3779B97F4A7C15)


def number_of_blocks(docs: DataFrame, text: str, characters: int = CHARACTERS) -> int:
    return max(1, -(-(docs.agg(F.sum(F.length(text))).first()[0] or 0) // characters))


def in_blocks(docs: DataFrame, tokens: Column, blocks: int, **columns: Column) -> DataFrame:
    """(to, columns, text): the block, what is kept, and the tokens as one string; not for null tokens. No token may hold ``SEPARATOR``."""
    rows = docs.select(*(c.alias(name) for name, c in columns.items()), F.array_join(tokens, SEPARATOR).alias("text")).where("text is not null")
    return dealt(rows.select(F.pmod(F.xxhash64(*rows.columns), F.lit(blocks)).cast("int").alias("to"), *rows.columns), blocks)


def dealt(rows: DataFrame, blocks: int) -> DataFrame:
    return rows.repartition(blocks, "to")


def each(rows: DataFrame, run: Callable[[int, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``run(number, rows)`` of each block or bucket."""
    return rows.groupBy("to").applyInArrow(lambda key, t: run(key[0].as_py(), t), schema)


def both(rows: DataFrame, answers: DataFrame, run: Callable[[int, pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``run(number, rows, answers)`` of each block or bucket."""
    return rows.groupBy("to").cogroup(answers.groupBy("to")).applyInArrow(lambda key, t, a: run(key[0].as_py(), t, a), schema)


def mixed(ids: np.ndarray) -> np.ndarray:
    return ((ids.astype(np.uint64) * _MIX) >> np.uint64(33)).astype(np.int64)


def flat(column: pa.ChunkedArray) -> pa.Array:
    """The elements of all lists of a column."""
    whole = column.combine_chunks()
    whole = pa.concat_arrays(whole.chunks) if isinstance(whole, pa.ChunkedArray) else whole
    return whole.flatten()


def flat_numbers(table: pa.Table, name: str) -> np.ndarray:
    return flat(table.column(name)).to_numpy(zero_copy_only=False) if table.num_rows else np.zeros(0, np.int64)


def offsets_of(column: pa.ChunkedArray) -> np.ndarray:
    n = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(n)]).astype(np.int32)


def lists(offsets: np.ndarray, values: np.ndarray | pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values if isinstance(values, pa.Array) else pa.array(values))


def table_of(columns: dict[str, pa.Array | np.ndarray], rows_each: int = 64) -> pa.Table:
    """A table in small batches, as a row may hold long arrays."""
    return pa.Table.from_batches(pa.table(columns).to_batches(max_chunksize=rows_each), pa.table(columns).schema)


def asked(me: int, buckets: np.ndarray, columns: dict[str, np.ndarray | pa.Array], **once: int) -> pa.Table:
    """A row (to, asker, columns as lists, once) per bucket that any element goes to; ``once`` numbers stand in the first row alone."""
    order = np.argsort(buckets, kind="stable")
    to, starts = np.unique(buckets[order], return_index=True)
    ends = np.concatenate([starts, [len(order)]])
    rows = {"to": to.astype(np.int32), "asker": np.full(len(to), me, np.int32)}
    for name, c in columns.items():
        rows[name] = lists(ends, c.take(pa.array(order)) if isinstance(c, pa.Array) else c[order])
    for name, n in once.items():
        rows[name] = np.where(np.arange(len(to)) == 0, n, 0).astype(np.int64)
    return table_of(rows)


def answered(me: int, table: pa.Table, like: str, name: str, values: np.ndarray) -> dict[str, pa.Array | np.ndarray]:
    """The rows of ``asked`` with an answer to each element of ``like``, addressed to the askers."""
    asker = table.column("asker").to_numpy()
    return {"to": asker.astype(np.int32), "asker": np.full(len(asker), me, np.int32), name: lists(offsets_of(table.column(like)), values)}


def told(answers: pa.Table, buckets: np.ndarray, name: str) -> np.ndarray:
    """The answers in the order of the elements that were asked about."""
    rows = answers.filter(pc.is_valid(answers.column(name)))
    rows = rows.take(pc.sort_indices(rows.column("asker"))) if rows.num_rows else rows
    values = flat_numbers(rows, name)
    out = np.empty_like(values)
    out[np.argsort(buckets, kind="stable")] = values
    return out


def words_of(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different tokens of a block in order, the number of each occurrence, and the tokens of each text."""
    if not table.num_rows:
        return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    split = pc.split_pattern(table.column("text"), SEPARATOR)
    n = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    words, ids = numbered(flat(split))
    return words, ids, n


def numbered(strings: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The different strings in order, and the place of each among them."""
    found = strings.dictionary_encode()
    order = pc.sort_indices(found.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return found.dictionary.take(pa.array(order)), rank[found.indices.to_numpy()]


def buckets_of_words(words: pa.Array, blocks: int) -> np.ndarray:
    values = words.to_numpy(zero_copy_only=False)
    return (pd.util.hash_array(values, categorize=False) % np.uint64(blocks)).astype(np.int64) if len(values) else np.zeros(0, np.int64)
