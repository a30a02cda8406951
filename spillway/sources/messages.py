"""Message tables: the topic/partition/offset model the relay works on.

A message row is ``topic, partition, offset, timestamp, value, seq``: what a
Kafka source yields (``seq`` is arrival order). The shared test tables have no
offsets, so the adapters below derive them; real topic sources carry them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scan import row_index
from .tables import table

MESSAGE_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("value", T.StringType()),
    T.StructField("seq", T.LongType()),
])

LEDGER_COLUMNS = ["role", "topic", "partition", "offset", "seq", "timestamp"]

# Fixed values of the test mapping: 3 partitions per topic, and the cut that
# separates really-consumed ("formal") messages from all messages.
PARTITIONS = 3
FORMAL_CUT = dt.datetime(2024, 1, 10)


def messages_from_events(events: DataFrame, partitions: int = PARTITIONS,
                         chunked: bool | None = None, payload: bool = True,
                         offsets: bool = True) -> DataFrame:
    """events -> messages: topic=event_type, partition=user_id % n,
    offset = position in (ts, event_id) order within (topic, partition).

    ``payload=False`` leaves the value out (offset-only readers: ledgers, lag,
    gates). The optimiser would prune it too; the projection says so
    explicitly.
    ``offsets=False`` skips the numbering for readers that only count or name."""
    cols = [
        F.col("event_type").alias("topic"),
        (F.col("user_id") % partitions).cast("int").alias("partition"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
    ]
    if payload:
        cols.append(F.col("props").alias("value"))
    base = events.select(*cols, F.col("event_id").alias("seq"))
    if not offsets:
        return base
    with_offset = row_index(base, ["topic", "partition"], ["timestamp", "seq"], "offset",
                            chunked=chunked)
    names = [n for n in MESSAGE_SCHEMA.fieldNames() if payload or n != "value"]
    return with_offset.select(*names)


def load_messages(spark: SparkSession, sf_dir: str, chunked: bool | None = None,
                  payload: bool = True, offsets: bool = True,
                  topics: Sequence[str] | None = None) -> DataFrame:
    """``topics``: read only these. Offsets are numbered per topic, so the
    filter goes below the numbering and into the scan."""
    events = table(spark, sf_dir, "events")
    if topics is not None:
        events = events.where(F.col("event_type").isin(list(topics)))
    return messages_from_events(events, chunked=chunked, payload=payload, offsets=offsets)


def document_payloads(documents: DataFrame) -> DataFrame:
    """documents -> text payloads: topic=source, value=text, seq=doc_id."""
    return documents.select(F.col("source").alias("topic"), F.col("text").alias("value"),
                            F.col("doc_id").alias("seq"))


def ledger(messages: DataFrame, formal_cut: dt.datetime | Column = FORMAL_CUT) -> DataFrame:
    """Offset ledger with two roles: ``all`` sees every message, ``formal``
    only the ones really consumed (before the cut). One pass over messages."""
    cut = formal_cut if isinstance(formal_cut, Column) else F.lit(formal_cut).cast("timestamp_ntz")
    roles = F.when(F.col("timestamp") < cut, F.array(F.lit("all"), F.lit("formal"))) \
        .otherwise(F.array(F.lit("all")))
    return messages.select(F.explode(roles).alias("role"), "topic", "partition", "offset",
                           "seq", "timestamp")


def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(load_messages(spark, sf_dir, payload=False))
