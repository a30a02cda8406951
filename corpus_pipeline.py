"""The corpus pipeline: quality rules, near-dedup, decontamination, secret masking and packing, in that order.

Every stage reads the table that the stage before it wrote. All but the last return the columns
of ``documents``; their decisions take effect in the rows (and texts) that they hand on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spillway.llm import decontam, line_rules, packing, secret_ledger, simhash
from spillway.session import pin, ship


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that fail the base rules or lose too much text go."""
    ship(spark)
    return line_rules.keep_clean(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (3-word shingles, 2 bits) one document stays."""
    ship(spark)
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    ship(spark)
    return decontam.keep_unleaked(docs, decontam.benchmark_of(docs, sf_dir))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; no document goes."""
    ship(spark)
    return secret_ledger.mask_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, packed along the curve."""
    ship(spark)
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secrets_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # fingerprints, edit distances and token ids have no SQL form: tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
