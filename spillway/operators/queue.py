"""Queue tables: one ordered work queue per topic, as a DataFrame.

A queue row is ``queue, pos, payload, topic, partition, offset, batch_id``.
Order is ``(batch_id, pos)`` (columns, never implicit row order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.envelope import envelope, payload_text, queue_name
from ..plans.joins import lookup_join
from .scan import floored_sum, row_index

QUEUE_COLUMNS = ["queue", "pos", "payload", "topic", "partition", "offset", "batch_id"]

# Arrival order across partitions of one topic (ties broken by unique keys).
FIFO_ORDER = ["timestamp", "partition", "offset"]
# Order of items in a queue table: batches in arrival order, positions inside
# a batch (a stream writes batch-local positions; a batch table has one batch
# or globally dense positions, for which this is the same order).
FIFO_KEY = ["batch_id", "pos"]


def route(messages: DataFrame, prefix: str = "", batch_id: int | Column | None = 0,
          keep: Sequence[str] = ()) -> DataFrame:
    """R13 without positions: every message wrapped and routed to its topic's
    queue. Narrow (no shuffle): projection only. ``keep``: further columns."""
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    return messages.select(
        queue_name(F.col("topic"), prefix).alias("queue"),
        envelope(payload_text(F.col("value"))).alias("payload"),
        "topic", "partition", "offset", "timestamp",
        batch.cast("bigint").alias("batch_id"), *keep)


def with_positions(routed: DataFrame, order: Sequence[str] = FIFO_ORDER,
                   chunked: bool | None = None) -> DataFrame:
    """Dense FIFO position per queue (append at the tail)."""
    return row_index(routed, ["queue"], list(order), "pos", chunked=chunked)


def relay_batch(messages: DataFrame, prefix: str = "", chunked: bool | None = None) -> DataFrame:
    """The queue table a relay run produces from a message table. Messages
    are numbered per topic (one queue each) first and wrapped after the
    shuffle, so the shuffle carries plain values."""
    placed = row_index(messages, ["topic"], FIFO_ORDER, "pos", chunked=chunked)
    return route(placed, prefix, keep=["pos"]).select(*QUEUE_COLUMNS)


def pop_messages(messages: DataFrame, prefix: str = "", n: int = 1) -> DataFrame:
    """R13 and R20 in one: the first ``n`` queue items of every topic of a
    message table. A per-topic top-n on the arrival order: every task keeps at
    most ``n`` messages of a topic before the shuffle, and only those are wrapped."""
    first = F.row_number().over(Window.partitionBy("topic").orderBy(*FIFO_ORDER))
    placed = messages.withColumn("pos", first.cast("bigint")).where(F.col("pos") <= n).withColumn("pos", F.col("pos") - 1)
    return route(placed, prefix, keep=["pos"]).select(*QUEUE_COLUMNS)


def queue_depth(queue: DataFrame, queues: Sequence[str]) -> DataFrame:
    """Items per configured queue; a queue with no items has depth 0.
    The configured list is the only driver-side input (the options)."""
    spark: SparkSession = queue.sparkSession
    names = spark.range(1).select(
        F.explode(F.array(*[F.lit(name) for name in queues])).alias("queue"))
    counts = queue.groupBy("queue").agg(F.count(F.lit(1)).alias("depth"))
    return (names.join(counts, "queue", "left")
            .select("queue", F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth")))


def queue_pop(queue: DataFrame, n: int = 1) -> DataFrame:
    """The next ``n`` items of every queue, FIFO; an empty queue gives
    nothing. A per-queue top-n: Spark plans it as a window group limit that
    keeps at most ``n`` rows per queue in every task before the shuffle, so a
    hot queue never moves more than ``n`` rows per task."""
    w = Window.partitionBy("queue").orderBy(*FIFO_KEY)
    return queue.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def queue_remaining(queue: DataFrame, n: int = 1) -> DataFrame:
    """R20 complement: what stays after popping ``n`` from every queue. An
    anti-join against the popped items (at most ``n`` per queue, size-checked
    before broadcast): the queue itself is never shuffled."""
    popped = queue_pop(queue, n).select("queue", *FIFO_KEY)
    return lookup_join(queue, popped, ["queue", *FIFO_KEY], "left_anti", label="popped",
                       null_safe=True)


def queue_ops(messages: DataFrame, pop_every_even: int = 2, prefix: str = "") -> DataFrame:
    """Push/pop log from messages: +1 per message, and a pop of
    ``pop_every_even`` items right after each message with an even ``seq``."""
    ops = F.when(
        F.col("seq") % 2 == 0,
        F.array(F.struct(F.lit(0).alias("k"), F.lit(1).alias("delta")),
                F.struct(F.lit(1).alias("k"), F.lit(-pop_every_even).alias("delta"))),
    ).otherwise(F.array(F.struct(F.lit(0).alias("k"), F.lit(1).alias("delta"))))
    return (messages.select(queue_name(F.col("topic"), prefix).alias("queue"), "seq",
                            F.explode(ops).alias("op"))
            .select("queue", (F.col("seq") * 2 + F.col("op.k")).cast("bigint").alias("op_seq"),
                    F.col("op.delta").cast("bigint").alias("delta")))


def depth_timeline(ops: DataFrame, chunked: bool | None = None) -> DataFrame:
    """Queue depth after every push/pop, never below zero
    (``depth = max(0, depth + delta)``), as a skew-safe clamp scan."""
    return floored_sum(ops, ["queue"], ["op_seq"], F.col("delta"), "depth", chunked=chunked)
