"""Reports: success rates, totals, trimmed histograms, shards."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from .filters import TextLimits


def success_rate(rows: DataFrame, error: str) -> DataFrame:
    return rows.agg(F.count("*").alias("n"), F.count_if(F.col(error) == "").alias("n_ok"), F.round(F.count_if(F.col(error) == "") / F.count("*"), 6).alias("rate"))


FEW = 10_000  # values that may be told apart in the driver


def values_at(values: DataFrame, column: str, rank: int, n: int) -> tuple:
    """The values of rank ``rank`` and the next (from 0) among ``n`` that are not null, exactly, with bounded state.

    A mergeable sketch names a cell that should hold both; counts below and inside it are exact, and the next sketch looks
    inside the cell alone, until few rows or few values are left there. A sketch that misses only costs another pass.
    """
    x, after, before, below, inside, wide = F.col(column), None, None, 0, n, 1e-3
    wanted = [rank, min(rank + 1, n - 1)]
    values = values.select(column).where(x.isNotNull())
    while True:
        cell = values if after is None else values.where(x > after)  # both ends of a cell are outside it
        cell = cell if before is None else cell.where(x < before)
        kinds = inside if inside <= FEW else cell.agg(F.approx_count_distinct(x)).first()[0]
        if kinds <= FEW:
            counts = cell.groupBy(column).agg(F.count("*").alias("n")).orderBy(column).collect()
            ends = list(accumulate((r.n for r in counts), initial=below))[1:]
            return tuple(counts[bisect_right(ends, k)][0] for k in wanted)
        shares = [min(1.0, max(0.0, (k - below) / inside + d)) for k, d in zip(wanted, (-wide, wide), strict=True)]
        a, b = cell.agg(F.percentile_approx(x, shares, 10_000)).first()[0]
        to_a, in_a, to_b, in_b = cell.agg(F.count_if(x < a), F.count_if(x == a), F.count_if(x < b), F.count_if(x == b)).first()
        spots = [k - below for k in wanted]
        exact = [a if to_a <= s < to_a + in_a else b if to_b <= s < to_b + in_b else None for s in spots]
        if None not in exact:
            return tuple(exact)
        if to_a + in_a <= spots[0] and spots[1] < to_b:
            after, before, below, inside = a, b, below + to_a + in_a, to_b - to_a - in_a
        elif exact[0] is not None and spots[1] < to_b:  # the first is the cell's end, the second the least value inside
            return exact[0], cell.where(x > exact[0]).agg(F.min(x)).first()[0]
        elif exact[1] is not None and spots[0] >= to_a + in_a:
            return cell.where(x < exact[1]).agg(F.max(x)).first()[0], exact[1]
        else:
            wide *= 8


def quantile(values: DataFrame, column: str, share: float, n: int) -> float:
    """The exact, interpolated quantile of ``n`` values that are not null."""
    place = (n - 1) * share
    low, high = values_at(values, column, int(place), n)
    part = place - int(place)
    return float(low) if not part or low == high else (1 - part) * low + part * high


def histogram(values: DataFrame, column: str, bins: int = 20, tail: float = 0.05) -> DataFrame:
    """(bin, n) over the values between the two tails' exact percentiles; empty without values."""
    x, n = F.col(column), values.agg(F.count(column)).first()[0]
    low, high = (quantile(values, column, share, n) for share in (tail, 1 - tail)) if n else (0.0, 0.0)
    rows = values.select(column).where(x.between(low, high))
    place = F.floor((x - low) / (high - low) * bins) if high > low else F.lit(0)
    return rows.groupBy(F.least(place, F.lit(bins - 1)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def shard_of(index: Column, rows: Column, shard_size: int) -> Column:
    """Contiguous shards, as many as needed for at most ``shard_size`` rows; the leading ones take the remainder."""
    shards = F.ceil(rows / shard_size)
    each, more = F.floor(rows / shards), rows % shards
    lead = more * (each + 1)
    return F.when(index < lead, F.floor(index / (each + 1))).otherwise(more + F.floor((index - lead) / each)).cast("long")


PER_RANGE = 64  # sampled rows for each range of the numbering


def range_of(rows: DataFrame, order: list[str], ranges: int) -> Column:
    """The number of each row's range: contiguous in ``order``, of about equal sizes, and the same whenever it is computed.

    The bounds come from the rows whose hashes are smallest, ``PER_RANGE`` for each range, and are literals of the plan.
    """
    keys = [F.col(f"`{c}`") for c in order]
    sample = rows.select(*keys).orderBy(F.xxhash64(*keys), *keys).limit(ranges * PER_RANGE).orderBy(*keys).collect()
    kinds = [rows.schema[c].dataType for c in order]
    at = sorted({len(sample) * k // ranges for k in range(1, ranges)} - {0})
    bounds = [F.struct(*(F.lit(v).cast(t).alias(c) for v, t, c in zip(sample[k], kinds, order, strict=True))) for k in at]
    key = F.struct(*(k.alias(c) for k, c in zip(keys, order, strict=True)))

    def place(lo: int, hi: int) -> Column:
        """Number of bounds[lo:hi] up to the key, and lo more: by halves."""
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < bounds[mid], place(lo, mid)).otherwise(place(mid + 1, hi))

    return place(0, len(bounds))


def numbered(rows: DataFrame, order: list[str], ranges: int | None = None) -> tuple[DataFrame, int]:
    """``rows`` with ``index`` (0, 1, ...) in a total order, and their number: counts per range, then places within each.

    Two passes, and a small one for the ranges' bounds; no task holds more than it sorts. Rows that are equal in ``order``
    share a range, so the order should tell rows apart.
    """
    ranges = ranges or 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = rows.withColumn("_range", range_of(rows, order, ranges))
    counts = dict(marked.groupBy("_range").agg(F.count("*")).collect())  # one row for each range
    starts = list(accumulate((counts.get(k, 0) for k in range(ranges)), initial=0))
    here = Window.partitionBy("_range").orderBy(*order)
    first = F.element_at(F.array(*map(F.lit, starts)), F.col("_range") + 1).cast("long")
    return marked.withColumn("index", first + F.row_number().over(here) - 1).drop("_range"), starts[-1]


def with_shards(rows: DataFrame, order: list[str], shard_size: int = 20_000, valid_shards: int = 2) -> DataFrame:
    """Adds index, split ("valid" for the first shards) and shard."""
    out, n = numbered(rows, order)
    out = out.withColumn("shard", shard_of(F.col("index"), F.lit(n), shard_size))
    return out.withColumn("split", F.when(F.col("shard") < valid_shards, "valid").otherwise("train"))


def text_statistics(rows: DataFrame, keys: list[str], text: str, limits: TextLimits, places: int = 2) -> DataFrame:
    """keys and what the text checks measure, for choosing their limits: one row per text, words split once; null for a null text.

    Rounded half to even to ``places``. The two repetition ratios run in Arrow batches, the rest in the JVM.
    """
    t, words = F.col(text), F.col("_words")
    measures = {
        "n_words": F.size(words).cast("long"),
        "special_ratio": T.special_ratio(t),
        "stopword_ratio": T.lexicon_ratio(words, limits.stopword_list),
        "flagged_ratio": T.lexicon_ratio(words, limits.flagged_list),
        "common_ratio": T.lexicon_ratio(words, limits.common_list),
        "punctuation_ratio": T.punctuation_ratio(t, least_tokens=limits.punctuation_tokens),
        "char_repetition": T.char_repetition_ratio(t, limits.char_repetition_n),
        "word_repetition": T.word_repetition_ratio(words, limits.word_repetition_n),
    }
    split = rows.select(*keys, text, T.words(t).alias("_words"))
    return split.select(*keys, *(F.when(t.isNotNull(), m if n == "n_words" else F.bround(m, places)).alias(n) for n, m in measures.items()))


def sampled(rows: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """The rows whose key's hash with ``seed`` is below ``share``: the same ones on every run and cluster, without a shuffle."""
    if share >= 1:
        return rows
    return rows.where(F.substring(F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 8) < f"{int(max(share, 0) * 16**8):08x}")
