"""Subscription filter, record validation and relay counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def subscribe(messages: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Only subscribed topics (an IN filter, pushed to the Parquet scan
    when the topic column comes straight from a file)."""
    return messages.where(F.col("topic").isin(list(topics)))


def _reason() -> F.Column:
    return F.when(F.col("topic").isNull(), F.lit("missing_topic"))


def valid_records(records: DataFrame) -> DataFrame:
    """Records that can be relayed (a record needs a topic)."""
    return records.where(_reason().isNull())


def rejected_records(records: DataFrame) -> DataFrame:
    """R11 complement: skipped records with the reason; disjoint from
    ``valid_records`` and together equal to the input."""
    return records.withColumn("reason", _reason()).where(F.col("reason").isNotNull())


def relay_counts(gated: DataFrame) -> DataFrame:
    """Per partition, messages seen, pushed (gate open) and deferred, and
    the last pushed offset. One pass over messages carrying ``is_open``."""
    pushed = F.col("is_open")
    return gated.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).cast("bigint").alias("seen"),
        F.count_if(pushed).cast("bigint").alias("pushed"),
        F.count_if(~pushed).cast("bigint").alias("deferred"),
        F.max(F.when(pushed, F.col("offset"))).alias("last_pushed_offset"))
