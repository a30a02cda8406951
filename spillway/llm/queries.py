"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontam, exact_fill, line_rules, packing, ppm_langid, ri_quality, secret_ledger, simhash, ssk_toxicity, token_align, url_rules,
               warc, word_runs)
from .common import table
from .oracle import SQL

__all__ = ["QUERIES", "SQL"]


def secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secret_ledger.report(secret_ledger.scan_versions(table(spark, d, "documents"), secret_ledger.ledger_path(spark)))


def decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.matches(table(spark, d, "documents"), table(spark, d, "benchmark"))


def simhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, d, "documents"))


def language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return ppm_langid.predict(docs, ppm_langid.train(docs))


def url_filter(spark: SparkSession, d: str) -> DataFrame:
    return url_rules.judge(table(spark, d, "pages"), url_rules.default_rules(spark))


def warc_archive(spark: SparkSession, d: str) -> DataFrame:
    return warc.report(warc.archive(table(spark, d, "pages")))


def quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return line_rules.judge(table(spark, d, "documents")).select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "n_lines_removed", "lost_chars")


def quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    return ri_quality.classify(table(spark, d, "documents"), table(spark, d, "labels"))


def toxicity(spark: SparkSession, d: str) -> DataFrame:
    return ssk_toxicity.classify(table(spark, d, "documents"), table(spark, d, "labels"))


def sequence_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), packing.default_tokenizer())


def tokenizer_alignment(spark: SparkSession, d: str) -> DataFrame:
    found = token_align.align_documents(table(spark, d, "documents"), token_align.default_tokenizers(), digest=True)
    return found.withColumnRenamed("groups", "groups_sha256")


def best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return exact_fill.pack(table(spark, d, "documents"), packing.default_tokenizer())


def periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    return word_runs.report(word_runs.find_runs(table(spark, d, "documents"), word_runs.plant_period))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": secret_scan,
    "op2_decontamination": decontamination,
    "op3_simhash": simhash_dedup,
    "op4_language_id": language_id,
    "op5_url_filter": url_filter,
    "op6_warc": warc_archive,
    "op7_quality_rules": quality_rules,
    "op8_quality_classifier": quality_classifier,
    "op9_toxicity": toxicity,
    "op10_packing": sequence_packing,
    "op11_tokenizer_alignment": tokenizer_alignment,
    "op12_best_fit_packing": best_fit_packing,
    "op13_periodic_runs": periodic_runs,
}
