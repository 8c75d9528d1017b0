"""N-gram Jaccard join with a count-vector R-tree.

A document is the set of its distinct word shingles. Shingles are hashed into groups and the number in each group is a
coordinate of the document's point: two sets share at most the sum of the coordinates' minima. No pair reaches the
verification on the sets themselves but by this bound.

One tree over the whole corpus would visit nearly every page for every query (README has figures), as unrelated texts of a
size have much the same counts. So the tree's partitions are made, without loss, from the same grouping: sets that link
differ in at most r shingles (r follows from their sizes), so with more than r groups at least one has the very same
shingles in both. Documents meet where the hash of a group's content is equal (a "run"), and a run is a partition of the
tree. Sizes are banded; a document meets its own band and, as the larger one, the band below if that may link. Two kinds
of groups are spared: empty ones (spare groups make up for them; only documents with still more meet on those) and those of
frequent passages: s groups beyond the needed ones mean that linked sets meet in more than s runs, so every class leaves
its s largest ones, and one that is in no more than s meets nobody.

Sets that are equal count once ("class", a 64-bit hash; documents whose sets share it but differ in a second hash stay
apart). First every class is bounded against, and then tested on, the class that it shares most runs with; what links forms
components. Only runs that still hold several components are searched: a packed R-tree of the points of those outside the
run's largest component (pages with the maxima of their coordinates), asked by all members. So a large group of near
copies costs about one test for each member and not one for each pair, and no link between different components is lost.
Large runs are searched in cells of at most ``SLICE`` queries and about as many points.

Skew: a task sends one class of each run and settles its others by itself; a class that many are tested on is dealt to
tasks of ``HUB`` tests.

Defined results: null texts and texts without words have an empty set, link with nothing and are their own component;
a row without doc_id gets no component, though its text may connect others; rows that share a doc_id are told apart by
their texts. Equal texts link. An empty table gives an empty result. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Scratch, packed, parts, passing, unpacked
from .components import components

LEAST_DIMENSIONS, MOST_DIMENSIONS, COARSE = 64, 4096, 64  # of a stored point, of a point in a cell, of a page
SLICE = 1000  # queries of a cell, and about its points
HUB = 500  # tests on one class that a task does in a row
PAGE = 16
SPARE = 6  # of so many differences that linked sets may have, one more group must be equal
FLUSH = 500_000  # signatures that a task holds at once
ROUNDS, NEAR = 3, 4  # searches, all but the last for nearest neighbours in that many runs of each class
C1, C2, C3, C4 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * C2
    x = (x ^ (x >> np.uint64(27))) * C3
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of the whole sequence if it is shorter."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # ASCII letters and ASCII white space only
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    size = min(words, n)
    out = np.full(n - size + 1, size, np.uint64) * C4
    for k in range(size):
        out = mix(out + h[k : n - size + 1 + k] + C1)
    return np.unique(out)


class Bands:
    """Size bands for a threshold of ``percent``: sizes, differences allowed, groups. A linked pair is in one band or in two neighbours."""

    def __init__(self, percent: int):
        self.percent, self.starts = percent, [1]

    def start(self, k: int) -> int:
        while len(self.starts) <= k:
            self.starts.append(self.starts[-1] * 10_000 // self.percent**2 + 1)
        return self.starts[k]

    def of(self, n: int) -> int:
        while self.starts[-1] <= n:
            self.start(len(self.starts))
        return int(np.searchsorted(self.starts, n, side="right")) - 1

    @lru_cache(4096)  # noqa: B019
    def plan(self, k: int) -> tuple[int, int, int, int]:
        """(largest size that joins this band, groups, spare groups for empty ones, the number of runs that a class leaves)."""
        low, high = self.start(k), self.start(k + 1) - 1
        most = high * 100 // self.percent
        differ = (100 - self.percent) * (high + most) // (100 + self.percent)
        frequent, empties = differ // SPARE, 0
        for _ in range(6):
            m = differ + 1 + frequent + empties
            empty = m * np.exp(-low / m) if m > 1 else 0.0
            empties = int(np.ceil(empty + np.sqrt(empty))) if empty > 0.002 else 0
        return most, differ + 1 + frequent + empties, empties, frequent


@lru_cache(8)
def bands(percent: int) -> Bands:
    return Bands(percent)


def signatures(s: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the groups' contents; the lowest six bits are the band (sizes beyond 64 bands don't occur)."""
    b, n = bands(percent), len(s)
    own = b.of(n)
    out = []
    for k in (own, own - 1):
        if k < 0:
            continue
        most, m, empties, _ = b.plan(k)
        if n > most:
            continue
        group = (s >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)  # ranges of hashes, so in order
        first = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])
        base = np.full(1, k, np.uint64) * C1
        found = [mix(mix(np.add.reduceat(s, first) * C4) + mix(group[first] + base))]
        if m - len(first) > empties:
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), group[first])
            found.append(mix(mix(empty + base) ^ C2))
        out += [x & ~np.uint64(63) | np.uint64(k) for x in found]
    return np.concatenate(out).view(np.int64)


def dimensions(n: int) -> int:
    """Coordinates of the point of a set of n, over n of them: the bound is then close to the overlap, so few pairs pass that don't link."""
    return max(LEAST_DIMENSIONS, 1 << n.bit_length())


def point(s: np.ndarray) -> bytes:
    d = dimensions(len(s))
    counts = np.bincount((s & np.uint64(d - 1)).astype(np.int64), minlength=d)
    return counts.astype(np.uint8 if counts.max() < 1 << 8 else np.uint16 if counts.max() < 1 << 16 else np.uint32).tobytes()


def read_point(vec: bytes, n: int, most: int = MOST_DIMENSIONS) -> np.ndarray:
    """The point of a set of n, folded to at most ``most`` coordinates."""
    d = dimensions(n)
    counts = np.frombuffer(vec, {1: np.uint8, 2: np.uint16, 4: np.uint32}[len(vec) // d])
    return fold(counts, most)


def fold(points: np.ndarray, most: int) -> np.ndarray:
    exact = points.dtype != np.float64 and points.dtype != np.uint32  # whole numbers below 2**24 stay so in 32 bits
    d = points.shape[-1]
    return points.reshape(*points.shape[:-1], -1, min(d, most)).sum(-2, dtype=np.float32 if exact else np.float64)


def set_hash(s: np.ndarray, seed: int = 0) -> int | None:
    return xxhash.xxh3_64_intdigest(s.tobytes(), seed) - (1 << 63) if len(s) else None


def needed(n: np.ndarray | int, m: int, percent: int) -> np.ndarray | int:
    """Least overlap of sets of n and m shingles that link."""
    return -(-percent * (n + m) // (100 + percent))


_ROW = [T.StructField(c, T.LongType()) for c in ("doc_id", "key", "n", "cls", "twin")] + [T.StructField("point", T.BinaryType())]
FOUND = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("sigs", T.BinaryType()), T.StructField("settled", T.BinaryType()), *_ROW])
MET = T.StructType([*_ROW, T.StructField("run", T.LongType()), T.StructField("pivot", T.LongType())])


def batch_of(schema: T.StructType, size: int, **columns) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in arrow], schema=arrow)


def distinct_runs(run: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (run, cls) in order, the least class of each one's run, and whether it is that class."""
    order = np.lexsort((cls, run))
    run, cls = run[order], cls[order]
    new = np.concatenate([[True], run[1:] != run[:-1]])
    fresh = new | np.concatenate([[True], cls[1:] != cls[:-1]])
    run, cls, new = run[fresh], cls[fresh], new[fresh]
    return run, cls, cls[np.flatnonzero(new)][np.cumsum(new) - 1], new


def sets_found(words: int, percent: int, buckets: int):
    """For each row its class, and once in a while the task's signatures, dealt to buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # classes whose signatures this task has given
        sigs: list[np.ndarray] = []
        of: list[int] = []

        def flush() -> Iterator[pa.RecordBatch]:
            sig, cls = np.concatenate(sigs).view(np.uint64), np.repeat(np.array(of, np.int64), [len(s) for s in sigs])
            sigs.clear()
            of.clear()
            bucket = ((sig >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            ids, cls, pivot, least = distinct_runs(bucket << 40 | (sig & np.uint64((1 << 40) - 1)).astype(np.int64), cls)
            other = np.flatnonzero(~least)
            for lo in range(0, len(other), 20_000):  # these need no meeting: any task may take them
                at = other[lo : lo + 20_000]
                yield batch_of(FOUND, 1, bucket=[int(cls[at[0]]) % buckets], settled=[np.stack([ids[at], cls[at], pivot[at]]).tobytes()])
            ids, cls = ids[least], cls[least]
            low = np.ascontiguousarray((ids & (1 << 40) - 1).view(np.uint8).reshape(-1, 8)[:, :5])
            edges = np.flatnonzero(np.diff(ids >> 40, prepend=-1))
            for a, b in zip(edges, [*edges[1:], len(ids)], strict=True):
                yield batch_of(FOUND, 1, bucket=[int(ids[a] >> 40)], sigs=[cls[a:b].tobytes() + low[a:b].tobytes()])

        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                rows = []
                for i, key, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                    s = shingles(text, words)
                    cls, vec = set_hash(s), None
                    if cls is not None and cls not in sent:
                        if len(sent) > 200_000:
                            sent.clear()
                        sent.add(cls)
                        vec = point(s)
                        sigs.append(signatures(s, percent))
                        of.append(cls)
                    rows.append((key % buckets, i, key, len(s), cls, set_hash(s, 1), vec))
                yield batch_of(FOUND, len(rows), **dict(zip(("bucket", "doc_id", "key", "n", "cls", "twin", "point"), zip(*rows, strict=True), strict=True)))
                if sum(map(len, sigs)) > FLUSH:
                    yield from flush()
        if sigs:
            yield from flush()

    return run


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of documents as they are, and (run, cls, pivot) for every class that is not the least of its run."""

    def rows(run, cls, pivot):
        for lo in range(0, len(run), 50_000):
            at = slice(lo, lo + 50_000)
            yield batch_of(MET, len(run[at]), run=run[at], cls=cls[at], pivot=pivot[at])

    runs, classes = [], []
    for batch in batches:
        here = batch.filter(pa.compute.is_valid(batch["key"]))
        if here.num_rows:
            yield batch_of(MET, here.num_rows, **{c: here[c] for c in ("doc_id", "key", "n", "cls", "twin", "point")})
        for bucket, sigs, settled, key in zip(*(batch[c].to_pylist() for c in ("bucket", "sigs", "settled", "key")), strict=True):
            if settled is not None:
                yield from rows(*np.frombuffer(settled, np.int64).reshape(3, -1))
            elif sigs is not None:
                n = len(sigs) // 13
                low = np.zeros((n, 8), np.uint8)
                low[:, :5] = np.frombuffer(sigs, np.uint8, offset=8 * n).reshape(n, 5)
                runs.append(low.view(np.int64).ravel() | bucket << 40)
                classes.append(np.frombuffer(sigs, np.int64, n))
    if runs:
        run, cls, pivot, least = distinct_runs(np.concatenate(runs), np.concatenate(classes))
        yield from rows(run[~least], cls[~least], pivot[~least])


def search(cell: dict[str, np.ndarray], percent: int, nearest: bool = False) -> list[tuple[int, int, int]]:
    """(a, b, bound beyond need) of classes in different components whose points allow a link; ``a`` are the rows with ``asks``.

    With ``nearest`` only the one with the highest bound for each ``a``, otherwise every pair once.

    The tree holds the rows with ``held`` by size, in pages with the maxima of their coarse coordinates. A query visits
    the pages of sizes that can link, then their coarse points, then the full points of what is left; a tree of one page
    begins with the points.
    """
    tree, asks = np.flatnonzero(cell["held"]), np.flatnonzero(cell["asks"])
    if not len(tree) or not len(asks):
        return []
    tree = tree[np.argsort(cell["n"][tree], kind="stable")]
    n, cls, label, tested = (cell[c][tree] for c in ("n", "cls", "label", "tested"))
    d = min(MOST_DIMENSIONS, dimensions(int(cell["n"].min())))
    fine = np.stack([read_point(v, k, d) for v, k in zip(cell["vec"][tree], n.tolist(), strict=True)])
    paged = len(tree) > PAGE
    if paged:
        rough = fold(fine, COARSE)
        pages = np.arange(0, len(tree), PAGE)
        top, least = np.maximum.reduceat(rough, pages), n[pages]
        last = n[np.minimum(pages + PAGE, len(tree)) - 1]
    out = []
    columns = (cell[c][asks].tolist() for c in ("cls", "label", "minor", "n", "tested", "vec"))
    for q, q_label, minor, size, q_tested, vec in zip(*columns, strict=True):
        v = None
        if paged:
            v = read_point(vec, size, d)
            r = fold(v, COARSE)
            lo, hi = np.searchsorted(last, -(-size * percent // 100)), np.searchsorted(least, size * 100 // percent, side="right")
            hit = lo + np.flatnonzero(within_reach(top[lo:hi], r, least[lo:hi], size, percent))
            if not len(hit):
                continue
            rows = (pages[hit][:, None] + np.arange(PAGE)).ravel()
            rows = rows[rows < len(tree)]
        else:
            rows = np.arange(len(tree))
        fits = (label[rows] != q_label) & (cls[rows] != q_tested) & (tested[rows] != q)
        if minor and not nearest:  # the other one asks too
            fits &= cls[rows] > q
        rows = rows[fits]
        if paged:
            rows = rows[within_reach(rough[rows], r, n[rows], size, percent)]
        if not len(rows):
            continue
        v = read_point(vec, size, d) if v is None else v
        beyond = overlap(fine[rows], v) - needed(n[rows], size, percent)
        if nearest:
            best = int(beyond.argmax())
            if beyond[best] >= 0:
                out.append((q, int(cls[rows[best]]), int(beyond[best])))
        else:
            out += [(min(q, c), max(q, c), 0) for c in cls[rows[beyond >= 0]].tolist()]
    return out


def overlap(points: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The sum of the coordinates' minima; the most that the sets share."""
    return np.minimum(points, v) @ np.ones(v.shape[-1], v.dtype)


def within_reach(points: np.ndarray, v: np.ndarray, n: np.ndarray | int, m: int, percent: int) -> np.ndarray:
    """Whether the sum of the coordinates' minima allows a link of sets of n and m shingles."""
    return overlap(points, v) >= needed(n, m, percent)


def bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and points allow a link."""

    @F.pandas_udf("boolean")
    def reach(na: pd.Series, va: pd.Series, nb: pd.Series, vb: pd.Series) -> pd.Series:
        out = []
        for n, v, m, w in zip(na, va, nb, vb, strict=True):
            d = min(dimensions(n), dimensions(m))
            out.append(bool(within_reach(read_point(v, n, d), read_point(w, m, d), n, m, percent)))
        return pd.Series(out, dtype=bool)

    for side in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("cls").alias(side), F.col("n").alias(f"n{side}"), F.col("vec").alias(f"v{side}")), side)
    pairs = pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return pairs.where(reach("na", "va", "nb", "vb")).select("a", "b")


def verified(pairs: DataFrame, classes: DataFrame, keyed: DataFrame, words: int, percent: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) whose sets link, written as the table ``name``.

    Texts, not sets, are shuffled: those of all ``a`` go where the text of their ``b`` goes, at most about ``HUB`` to a
    place, and each task makes the sets again and compares in passing.
    """
    spark = keyed.sparkSession
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / HUB).cast("int").alias("slices"))
    dealt = pairs.join(sizes, "b").withColumn("part", F.pmod(F.xxhash64("a"), "slices").cast("int"))
    wanted = dealt.select(F.col("a").alias("cls"), F.col("b").alias("hub"), "part", F.lit(1).alias("place")).union(
        dealt.select(F.col("b").alias("cls"), F.col("b").alias("hub"), "part", F.lit(0).alias("place")).distinct()
    )
    wanted = scratch.keep(wanted.join(classes.select("cls", "key"), "cls"), f"{name}-wanted")
    tests = wanted.count()

    maybe = passing(wanted.select("key"))

    def asked_for(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # copies that a task has are sent once
        for batch in batches:
            keys, take = batch["key"].to_numpy(), []
            for at in np.flatnonzero(maybe(keys)).tolist():
                if keys[at] not in sent:
                    if len(sent) > 200_000:
                        sent.clear()
                    sent.add(keys[at])
                    take.append(at)
            if take:
                yield batch.take(pa.array(take))

    texts = keyed.select("key", "text").mapInArrow(asked_for, "key long, text string").dropDuplicates(["key"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, base = None, None
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                found = []
                for h, place, cls, text in zip(*(c.to_pylist() for c in whole.slice(lo, 512).columns), strict=True):
                    if h != hub:
                        hub, base = h, None
                    s = shingles(text, words)
                    if place == 0:
                        base = s
                    elif base is not None and len(np.intersect1d(base, s, assume_unique=True)) >= needed(len(base), len(s), percent):
                        found.append((cls, hub))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b"])

    rows = texts.join(wanted, "key").select("hub", "part", "place", "cls", "text")
    rows = rows.repartition(parts(tests, 2500, int(spark.conf.get("spark.sql.shuffle.partitions"))), "hub", "part").sortWithinPartitions("hub", "part", "place")
    links = scratch.keep(rows.select("hub", "place", "cls", "text").mapInArrow(compare, "a long, b long"), name)
    scratch.drop(f"{name}-wanted")
    return links


def mixed_runs(stars: DataFrame, runs: DataFrame, found: DataFrame) -> DataFrame:
    """(run, cls, label) of the members of runs that hold several components."""
    pairs = stars.select("cls", "pivot")
    for c in ("cls", "pivot"):
        pairs = pairs.join(found.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")), c, "left")
    pairs = pairs.where(F.coalesce("of_cls", "cls") != F.coalesce("of_pivot", "pivot")).select("cls", "pivot")
    mixed = runs.join(pairs, ["cls", "pivot"], "left_semi").select("run").distinct()
    rows = runs.join(mixed, "run", "left_semi")
    rows = rows.select("run", "cls").union(rows.select("run", F.col("pivot").alias("cls"))).distinct()
    rows = rows.join(found.select(F.col("node").alias("cls"), "component"), "cls", "left").select("run", "cls", F.coalesce("component", "cls").alias("label"))
    return rows


def without_largest(rows: DataFrame, percent: int) -> DataFrame:
    """Without each class's largest runs of a band, as many as groups were added for these: linked sets meet in one run more, so in another as well.

    Runs are ordered alike for all classes, by size, and what two of them share at the end of the order, both leave.
    """
    band = F.col("run").bitwiseAND(63).cast("int")
    left = F.element_at(F.array(*(F.lit(bands(percent).plan(k)[3]) for k in range(64))), band + 1)
    of_class = Window.partitionBy("cls", "band")
    rows = rows.withColumns({"band": band, "left": left}).withColumn("meets", F.count("*").over(of_class)).where("meets > left")
    runs = rows.groupBy("run").agg(F.count("*").alias("members")).where("members > 1")
    rows = rows.join(runs, "run").withColumn("place", F.row_number().over(of_class.orderBy(F.desc("members"), "run")))
    return rows.where("place > left").select("run", "cls", "label", (F.col("place") - F.col("left")).alias("place"))


def cells(rows: DataFrame, classes: DataFrame, tested: DataFrame) -> DataFrame:
    """The rows that each cell of a run's search needs; runs with the same members are searched once."""
    runs = rows.groupBy("run").agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("y"))
    once = runs.where("members > 1").groupBy("members", "x", "y").agg(F.min("run").alias("run")).select("run")
    rows = rows.join(once, "run", "left_semi")
    sizes = rows.groupBy("run", "label").agg(F.count("*").alias("size")).groupBy("run").agg(F.sum("size").alias("members"), F.max(F.struct("size", "label")).alias("main"))
    sizes = sizes.select("run", F.col("main.label").alias("main"), F.ceil(F.col("members") / SLICE).cast("int").alias("across"), F.greatest(F.ceil((F.col("members") - F.col("main.size")) / SLICE), F.lit(1)).cast("int").alias("down"))
    rows = rows.join(sizes, "run").withColumns({"minor": F.col("label") != F.col("main"), "i": F.pmod(F.xxhash64("cls"), "across").cast("int"), "j": F.pmod(F.xxhash64("label", "cls"), "down").cast("int")})
    asked = F.transform(F.sequence(F.lit(0), F.col("down") - 1), lambda j: F.struct(F.col("i").alias("i"), j.alias("j")))
    held = F.transform(F.sequence(F.lit(0), F.col("across") - 1), lambda i: F.struct(i.alias("i"), F.col("j").alias("j")))
    places = F.when(F.col("minor"), F.array_union(asked, held)).otherwise(asked)
    rows = rows.select("run", "cls", "label", "minor", "i", "j", F.explode(places).alias("at"))
    rows = rows.select("run", "at", "cls", "label", "minor", (F.col("at.i") == F.col("i")).alias("asks"), (F.col("minor") & (F.col("at.j") == F.col("j"))).alias("held"))
    return rows.join(classes.select("cls", "n", "vec"), "cls").join(tested.select("cls", F.col("pivot").alias("tested")), "cls", "left").withColumn("tested", F.coalesce("tested", "cls"))


def searched(percent: int, nearest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The pairs of each cell; the rows come sorted by cell, and the last cell may go on in the next batch."""
        held, seen = None, set()
        for batch in batches:
            if batch.num_rows:
                held = yield from pairs(pa.Table.from_batches([*held, batch] if held else [batch]), False, seen)
        if held:
            yield from pairs(pa.Table.from_batches(held), True, seen)

    def pairs(rows: pa.Table, whole: bool, seen: set):
        cols = {c: rows[c].to_numpy() for c in rows.column_names}
        edges = np.flatnonzero(np.any([cols[c][1:] != cols[c][:-1] for c in ("run", "i", "j")], axis=0)) + 1
        edges = [0, *edges.tolist(), *([rows.num_rows] if whole else [])]
        found = [p for a, b in zip(edges, edges[1:], strict=False) for p in search({c: v[a:b] for c, v in cols.items()}, percent, nearest)]
        found = list(set(found) - seen)  # a pair may share many of the task's runs
        if found:
            if len(seen) > 200_000:
                seen.clear()
            seen.update(found)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["a", "b", "beyond"])
        return rows.slice(edges[-1]).to_batches()

    return run


def classes_and_groups(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, key, n, cls, twin) of each row, and (cls, group) of each class that links; key is a hash of the text."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = docs.count()
    places = parts(count, 2500, least)
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))

    # Every text once: its row, its class and point, its signatures; then runs, where the signatures meet.
    met = keyed.select("doc_id", "key", "text").mapInArrow(sets_found(words, percent, min(4 * places, 1 << 23)), FOUND)
    met = scratch.keep(met.repartition(places, "bucket").mapInArrow(meet, MET), "met")
    runs = met.where("run is not null").select("run", "cls", "pivot")
    seen = scratch.keep(met.where("run is null").select("doc_id", "key", "n", "cls", "twin"), "seen")

    # Each class against the one that it shares most runs with: bound first, then the sets.
    stars = scratch.keep(runs.groupBy("cls", "pivot").agg(F.count("*").alias("runs")), "stars")
    ids = stars.select("cls").union(stars.select("pivot")).distinct()
    classes = met.where("run is null and cls is not null").groupBy("cls").agg(F.min("key").alias("key"), F.max("n").alias("n"), F.max("point").alias("vec"))
    classes = scratch.keep(classes.join(ids, "cls", "left_semi"), "classes")
    tested = scratch.keep(stars.groupBy("cls").agg(F.max_by("pivot", F.struct("runs", "pivot")).alias("pivot")), "tested")
    links = verified(bounded(tested.select(F.col("cls").alias("a"), F.col("pivot").alias("b")), classes, percent), classes, keyed, words, percent, scratch, "links")
    found = scratch.keep(components(links), "found")

    # Then the runs that still hold several components, through the tree: first only each class's nearest neighbour in
    # another component, in a few runs, which leaves few components of what is linked at all; then every pair that the
    # bound allows.
    rows = scratch.keep(mixed_runs(stars, runs, found), "mixed")
    rows = scratch.keep(without_largest(rows, percent), "rows-0")
    scratch.drop("met", "stars", "mixed", "found")
    for k in range(1, ROUNDS + 1):
        nearest = k < ROUNDS
        places_of = cells(rows.where(F.col("place") <= NEAR) if nearest else rows, classes, tested).select("run", "at.i", "at.j", "cls", "label", "minor", "asks", "held", "n", "vec", "tested")
        places_of = places_of.repartition(parts(count, 5000, least), "run", "i", "j").sortWithinPartitions("run", "i", "j")
        pairs = places_of.mapInArrow(searched(percent, nearest), "a long, b long, beyond long")
        if nearest:
            pairs = pairs.groupBy("a").agg(F.max_by("b", F.struct("beyond", "b")).alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        pairs = scratch.keep(pairs.select("a", "b").distinct(), f"pairs-{k}")
        more = verified(pairs, classes, keyed, words, percent, scratch, f"links-{k}")
        if more.isEmpty():
            if nearest:
                continue
            break
        links = links.union(more)
        if nearest:
            found = components(links).select(F.col("node").alias("cls"), "component")
            named = rows.join(found, "cls", "left").select("run", "cls", F.coalesce("component", "cls").alias("label"), "place")
            mixed = named.groupBy("run").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("run")
            rows = scratch.keep(named.join(mixed, "run", "left_semi"), f"rows-{k}")
    groups = scratch.keep(components(links.union(more)).select(F.col("node").alias("cls"), F.col("component").alias("group")), "groups")
    scratch.drop("classes", "tested", "links", *(f"{t}-{k}" for t in ("rows", "pairs", "links") for k in range(ROUNDS + 1)))
    return seen, groups


def grouped(seen: DataFrame, groups: DataFrame, lowest) -> DataFrame:
    """(cls, twin, group, low): ``lowest`` over the rows of each class; a class that only its hash shares with another keeps to itself."""
    classes = seen.where("cls is not null").groupBy("cls", "twin").agg(lowest.alias("low"))
    owners = classes.groupBy("cls").agg(F.min("twin").alias("owner"))
    classes = classes.join(owners, "cls").join(groups, "cls", "left")
    own = F.xxhash64("cls", "twin")
    return classes.select("cls", "twin", "low", F.when(F.col("twin") == F.col("owner"), F.coalesce("group", "cls")).otherwise(own).alias("group"))


def join(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs``; sets link at a Jaccard similarity of ``percent`` / 100."""
    seen, groups = classes_and_groups(docs, words, percent)
    # The smallest doc_id of each class, and of each group of classes.
    classes = grouped(seen, groups, F.min("doc_id"))
    heads = classes.groupBy("group").agg(F.min("low").alias("head"))
    heads = classes.join(heads, "group").select("cls", "twin", "head")
    out = seen.join(heads, ["cls", "twin"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("head", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The row with the smallest doc_id of each group of linked documents, and all rows without words, with all columns."""
    seen, groups = classes_and_groups(docs, words, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key"))
    chosen = grouped(seen, groups, first).groupBy("group").agg(F.min("low").alias("first"))
    chosen = chosen.select(F.coalesce("first.doc_id", F.lit(-(2**63))).alias("id"), F.col("first.key").alias("key"))
    text = F.coalesce("doc.text", F.lit(""))
    keyed = packed(docs).withColumns({"id": F.coalesce("doc.doc_id", F.lit(-(2**63))), "key": F.xxhash64(text)})
    worded = text.rlike(r"[^\x20\x09-\x0D]")
    kept = keyed.where(worded).join(chosen, ["id", "key"], "left_semi").dropDuplicates(["id", "key"])
    return kept.unionByName(keyed.where(~worded), allowMissingColumns=False).select(*unpacked(docs.columns))
