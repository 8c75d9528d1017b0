"""The registered queries: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, fill_in_middle, filter_audit, license_scans, mpeg_audio, ngram_jaccard, oracles, packing, quality_classifier, quality_rules, secret_scans, substring_dedup, warc_revisits
from .common import documents

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality_rules.apply(docs, quality_rules.fit(docs, labels(spark, sf_dir)))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), tokenizer_path(), digests=True)


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scans.scan(documents(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(documents(spark, sf_dir).select("doc_id", "text"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op6_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg_audio.from_media(mpeg_audio.to_media(documents(spark, sf_dir)))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = secret_scans.train(secret_scans.labelled_findings(spark))
    return secret_scans.scan(documents(spark, sf_dir).select("doc_id", "text"), forest)


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisits.resolve(warc_revisits.captures(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    pairs = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return found.withColumns({"ts": F.unix_timestamp("ts"), "response_ts": F.unix_timestamp("response_ts"), "headers": F.array_join(pairs, ";")})


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.join(documents(spark, sf_dir), words=4, percent=85)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(documents(spark, sf_dir), labels(spark, sf_dir))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle.transform(documents(spark, sf_dir).select("doc_id", "text"))
    back = fill_in_middle.restored(F.col("text"), F.col("form"))
    return out.select("doc_id", F.col("n_units").alias("n"), "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"), F.sha2("text", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.index(filter_audit.judged(documents(spark, sf_dir), labels(spark, sf_dir))))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_bpe, op3_license_scans, op4_substring_dedup, op5_packing, op6_mpeg_audio, op7_secret_scans,
        op8_warc_revisits, op9_ngram_jaccard, op10_quality_classifier, op11_fill_in_middle, op12_decontamination, op13_filter_audit,
    )
}
ORACLE_SQL = {
    "op8_warc_revisits": oracles.WARC_REVISITS, "op9_ngram_jaccard": oracles.NGRAM_JACCARD, "op11_fill_in_middle": oracles.FILL_IN_MIDDLE,
    "op12_decontamination": oracles.DECONTAMINATION, "op13_filter_audit": oracles.FILTER_AUDIT,
}
