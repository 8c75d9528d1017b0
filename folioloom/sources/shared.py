"""The folder that driver and executors share, and tables cut off there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """That of spark.checkpoint.dir; without one a local session takes a temporary folder of its own, and a cluster raises."""
    context = spark.sparkContext._jsc.sc()
    if context.getCheckpointDir().isEmpty():
        where = spark.conf.get("spark.checkpoint.dir", None)
        if where is None:
            if spark.sparkContext.master.split("[")[0] != "local":
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            import tempfile

            where = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(where)
    return context.getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """``df`` as it is computed once, from the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
