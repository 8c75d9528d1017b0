"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the columns
of ``documents``; a changed text gets its new n_chars.

Null and empty texts: scored as empty by the classifier, which decides whether they go; those it keeps pass the other
stages as they are and are packed as one end id each. Repeated rows: the join keeps one of them, ties going to the smallest
doc_id. Rows without a doc_id are kept like others. Empty tables give empty results. Very long texts are worked on whole.
Columns of any name are passed on by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioloom.llm import ngram_jaccard, packing, quality_classifier, secret_scans, substring_dedup
from folioloom.llm.common import Scratch, documents
from folioloom.llm.queries import labels, tokenizer_path


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality_classifier.keep(docs, labels(spark, sf_dir))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near-duplicate links connect."""
    return ngram_jaccard.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without sentences that repeat elsewhere; a document of which nothing is left goes."""
    out = substring_dedup.dedup(docs).where("removed_sentences = 0 or removed_sentences is null or text <> ''")
    return as_documents(out, docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With secrets masked."""
    return as_documents(secret_scans.scan(docs, secret_scans.train(secret_scans.labelled_findings(spark))), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed into sequences."""
    return packing.pack(docs, tokenizer_path())


def as_documents(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("substring dedup", without_repeats),
    ("secret scans", without_secrets),
    ("packing", packed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's table goes when the next one has been written."""
    work, docs = Scratch(spark), documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = work.keep(stage(spark, docs, sf_dir), str(k))
        if k:
            work.drop(str(k - 1))
    return STAGES[-1][1](spark, docs, sf_dir)
