"""Small helpers that the corpus operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# ASCII white space: the six bytes that bytes.split() and bytes.strip() use, i.e. [\x20\x09-\x0D].
SPACES = " \t\n\v\f\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_rows(df: DataFrame, columns: list[str], fn: Callable[..., Iterator[tuple]], schema: T.StructType) -> DataFrame:
    """Apply ``fn(*column lists)``, which yields output tuples, to each Arrow batch of the named columns.

    Only those columns reach Python, so extra columns of the input (whatever their names) do not matter.
    """
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                rows = list(fn(*(part.column(i).to_pylist() for i in range(part.num_columns))))
                if rows:
                    cols = [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow, strict=True)]
                    yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return df.select(*columns).mapInArrow(run, schema)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share.

    Where none is set, a local session (one machine, as in tests) gets a temporary one; a cluster raises.
    """
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isEmpty():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            import tempfile

            where = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(where)
    return context.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


class Scratch:
    """Tables of one job, written to the shared folder and dropped by path as soon as their last reader is done.

    A job that loses executors reads them again. The files of a write's own shuffles go when the write ends, and its Python
    workers get fewer rows at once than by default, as points and texts are long.
    """

    WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_folder(spark)}/work-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        before = {k: self.spark.conf.get(k) for k in self.WHILE_WRITING}
        try:
            for k, v in self.WHILE_WRITING.items():
                self.spark.conf.set(k, v)
            df.write.parquet(f"{self.root}/{name}")
        finally:
            for k, v in before.items():
                self.spark.conf.set(k, v)
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        jvm, context = self.spark._jvm, self.spark.sparkContext._jsc
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(context.hadoopConfiguration()).delete(path, True)


BITS = 1 << 23


def bits_for(keys: int) -> int:
    """Bits of a filter that lets about one in 32 other values pass: a power of two, from 8 KB to 16 MB."""
    return min(1 << 27, max(1 << 16, 1 << (32 * keys).bit_length()))


def passing(keys: DataFrame, size: int = BITS) -> Callable[[np.ndarray], np.ndarray]:
    """A function of an array of longs, for use in tasks: false only for values that are not among ``keys``.

    A filter of fixed size (``size`` bits, by default 1 MB, broadcast) that spares shuffles; with many more keys than bits
    it lets all pass, and no result depends on it.
    """
    words = keys.select(F.pmod(F.col(keys.columns[0]), F.lit(size)).alias("p")).groupBy((F.col("p") / 64).cast("int").alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits")
    )
    bits = np.zeros(size // 64, np.int64)
    for r in words.toLocalIterator():
        bits[r.w] = r.bits
    shared = keys.sparkSession.sparkContext.broadcast(bits)

    def maybe(values: np.ndarray) -> np.ndarray:
        p = values % size
        return (shared.value[p // 64] >> (p % 64)) & 1 == 1

    return maybe


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, as the variable of a one-element array's lambda."""
    return F.transform(F.array(value), body)[0]


def parts(rows: int, each: int, least: int = 1) -> int:
    """Number of groups of about ``each`` rows."""
    return max(least, -(-rows // each))


def packed(df: DataFrame) -> DataFrame:
    """All columns as one, ``doc``: so names of the input can't clash with those that an operator adds for itself."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("doc"))


def unpacked(columns: list[str], **changed) -> list:
    """The columns of ``doc``, with the ``changed`` ones as given; a column that an operator adds replaces one of its name."""
    return [changed.pop(c).alias(c) if c in changed else F.col("doc").getField(c).alias(c) for c in columns] + [v.alias(k) for k, v in changed.items() if v is not None]
