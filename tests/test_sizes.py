"""Probed sizes: what is shuffled to find the facts of a document's sources."""

from pyspark.sql import functions as F

from folioloom.operators.documents import META, NODE
from folioloom.plans.pipeline import with_probed_sizes


def test_sources_alone_tell_documents_apart(spark):
    """Documents with equal sources, in any order and with any texts, share one map; a repeated source and none are no trouble."""
    fields = [f.split(":") for f in META.removeprefix("struct<").removesuffix(">").split(",")]
    node = lambda text, src: F.struct(text.alias("text"), F.when(src.isNotNull(), F.struct(*((src if f == "src" else F.lit(None)).cast(t).alias(f) for f, t in fields))).alias("meta")).cast(NODE)
    rows = [(1, "x", ["a", "b", "a"]), (2, "y", ["b", "a"]), (3, "z", ["c"]), (4, "z", []), (1, "x", ["a", "b", "a"])]
    docs = spark.createDataFrame(rows, "id int, t string, srcs array<string>")
    docs = docs.select("id", F.concat(F.array(node(F.col("t"), F.lit(None).cast("string"))), F.transform("srcs", lambda s: node(F.lit(None).cast("string"), s))).alias("nodes"))
    facts = spark.createDataFrame([("a", "png", 1, 2), ("a", "jpeg", 9, 9), ("b", "gif", 3, 4), (None, "gif", 5, 6)], "src string, format string, width int, height int")
    out = with_probed_sizes(docs, facts)
    told = F.transform("nodes", lambda n: F.concat_ws(" ", n["text"], n["meta"]["src"], n["meta"]["format"], n["meta"]["original_width"].cast("string")))
    got = sorted((r[0], r[1]) for r in out.select("id", told).collect())
    one = (1, ["x", "a png 1", "b gif 3", "a png 1"])
    assert got == [one, one, (2, ["y", "b gif 3", "a png 1"]), (3, ["z", "c"]), (4, ["z"])]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 2  # of the facts and of the maps; no row per document and source is shuffled to be made one
