"""Offset ledger analytics: latest offsets, lag, watermarks, positions, replay.

All of these are aggregations with map-side partial aggregation, so a hot
topic or partition never lands in one task: each task pre-reduces its rows to
one value per key before the (tiny) shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ticks import at_epoch, epoch_seconds, tick_end
from ..plans.joins import lookup_join
from ..session import CONF_GROUP_ROWS, DEFAULT_GROUP_ROWS, conf_int, pin
from .scan import previous_value, running_sum

KEY = ["role", "topic", "partition"]


def signed_offset(role: Column, offset: Column) -> Column:
    """``all`` adds, every other role subtracts."""
    return F.when(role == F.lit("all"), offset).otherwise(-offset)


def latest_offsets(ledger: DataFrame) -> DataFrame:
    """Last-written offset per (role, topic, partition); arrival order is
    ``seq`` (a rewind lowers the value, so this is not ``max(offset)``)."""
    return ledger.groupBy(*KEY).agg(F.max_by("offset", "seq").alias("offset"))


def topic_lag(latest: DataFrame) -> DataFrame:
    """``max(0, sum(all) - sum(formal))`` per topic, clamped after the
    sum. Topics without ledger rows produce no row."""
    return latest.groupBy("topic").agg(
        F.greatest(F.lit(0), F.sum(signed_offset(F.col("role"), F.col("offset"))))
        .cast("bigint").alias("lag"))


def watermarks(messages: DataFrame) -> DataFrame:
    """low = first offset, high = last offset + 1 per partition."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("low_watermark"),
        (F.max("offset") + 1).cast("bigint").alias("high_watermark"))


def next_positions(ledger: DataFrame, role: str = "formal") -> DataFrame:
    """Committed next position per partition: last consumed offset + 1."""
    return (ledger.where(F.col("role") == role).groupBy("topic", "partition")
            .agg((F.max_by("offset", "seq") + 1).cast("bigint").alias("next_offset")))


def committed_position(messages: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every known partition with its committed next position (NULL when
    nothing was committed). Both sides are per-partition aggregates."""
    marks = watermarks(messages).select("topic", "partition")
    return marks.join(next_positions(ledger), ["topic", "partition"], "left")


def partition_lag(messages: DataFrame, ledger: DataFrame) -> DataFrame:
    """``high - next`` per partition; a partition with no commit starts
    at its low watermark (earliest reset)."""
    pos = watermarks(messages).join(next_positions(ledger), ["topic", "partition"], "left")
    lag = F.col("high_watermark") - F.coalesce(F.col("next_offset"), F.col("low_watermark"))
    return pos.select("topic", "partition", "low_watermark", "high_watermark", "next_offset",
                      lag.cast("bigint").alias("lag"))


def ticks_per_key_bound(ledger: DataFrame, tick_seconds: int) -> int:
    """Most ticks any key can have: the time span in ticks (one cheap
    aggregate over the timestamp column, one row back)."""
    row = ledger.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).first()
    if row["a"] is None:
        return 0
    return int((row["b"] - row["a"]).total_seconds() // tick_seconds) + 2


def lag_timeline(ledger: DataFrame, tick_seconds: int = 10,
                 chunked: bool | None = None) -> DataFrame:
    """Topic lag as published at the end of every tick with activity.

    Telescoping keeps this on aggregates: per (role, topic, partition, tick)
    the last offset (partial aggregation), its change against the previous
    active tick of the same key, the signed changes summed per (topic, tick)
    and a running sum over ticks. Each key and topic has at most one row per
    tick, so the time span bounds every group; when that bound is above the
    per-group limit (very long histories), the previous value and the running
    sum use the skew-safe scans instead of windows.
    """
    if chunked is None:
        limit = conf_int(ledger.sparkSession, CONF_GROUP_ROWS, DEFAULT_GROUP_ROWS)
        chunked = ticks_per_key_bound(ledger, tick_seconds) > limit
    per_tick = (ledger.withColumn("tick", tick_end(F.col("timestamp"), tick_seconds))
                .groupBy(*KEY, "tick").agg(F.max_by("offset", "seq").alias("last")))
    if chunked:  # a chunked scan reads its input several times
        per_tick = pin(per_tick, "tick-offsets")
    change = previous_value(per_tick, KEY, ["tick"], "last", 0, "prev", chunked=chunked) \
        .withColumn("change", F.col("last") - F.col("prev"))
    # Summed per (topic, tick) in every task first: no topic meets in one task.
    per_topic = change.groupBy("topic", "tick").agg(
        F.sum(signed_offset(F.col("role"), F.col("change"))).alias("delta"))
    if chunked:
        per_topic = pin(per_topic, "tick-changes")
    running = running_sum(per_topic, ["topic"], ["tick"], F.col("delta"), "running",
                          chunked=chunked)
    return running.select("topic", "tick",
                          F.greatest(F.lit(0), F.col("running")).cast("bigint").alias("lag"))


def dense_lag_timeline(sparse: DataFrame, tick_seconds: int = 10, piece: int = 4096) -> DataFrame:
    """R25, every tick: from a topic's first published tick to the last tick
    of any topic, the lag as last published. The sparse timeline is pinned
    once; its last tick comes back as one scalar. Each row is repeated up to
    the topic's next row, found by a size-checked scan, and a long gap is
    cut into pieces of ``piece`` ticks, so no row holds a whole time span."""
    sparse = pin(sparse, "lag-timeline")
    last = sparse.agg(F.max(epoch_seconds(F.col("tick")))).first()[0]
    if last is None:
        return sparse
    # the next row is the previous one in descending order
    rows = sparse.select("topic", "lag", epoch_seconds(F.col("tick")).alias("at")).withColumn("back", -F.col("at"))
    rows = previous_value(rows, ["topic"], ["back"], "at", last + tick_seconds, "next")
    ticks = F.floor((F.col("next") - F.col("at")) / tick_seconds)
    rows = rows.withColumn("n", ticks).withColumn("cut", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / piece))))
    here = F.least(F.col("n") - F.col("cut") * piece, F.lit(piece)) - 1
    rows = rows.select("topic", "lag", "at", "cut", F.explode(F.sequence(F.lit(0).cast("bigint"), here)).alias("i"))
    return rows.select("topic", at_epoch(F.col("at") + (F.col("cut") * piece + F.col("i")) * tick_seconds).alias("tick"), "lag")


def replay(messages: DataFrame, positions: DataFrame) -> DataFrame:
    """Re-read each partition from a position (``next_offset``; none =
    from the beginning). ``positions`` is one row per partition; its size is
    checked before it is broadcast."""
    joined = lookup_join(messages, positions.select("topic", "partition", "next_offset"),
                         ["topic", "partition"], "left", label="replay-positions")
    return (joined.where(F.col("offset") >= F.coalesce(F.col("next_offset"), F.lit(0)))
            .drop("next_offset"))
