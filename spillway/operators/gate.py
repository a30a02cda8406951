"""Back-pressure gate: queue depth samples -> open/closed state -> admission.

A topic is open after a sample iff the sampled depth is at most ``cache_size``; a failed
sample (NULL depth) closes it. A state holds until the topic's next sample, and topics start
open. Messages of a closed topic are deferred (left in the source), never dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ticks import tick_end, tick_number
from ..plans.joins import lookup_join
from .scan import previous_value

SLOT_SECONDS = 3600  # width of the join slots; results do not depend on it


def depth_samples(messages: DataFrame, tick_seconds: int) -> DataFrame:
    """Depth samples from messages, taken at the end of each tick that has any: the number of
    its messages as the sampled length (partial aggregation)."""
    return (messages.groupBy("topic", tick_end(F.col("timestamp"), tick_seconds).alias("tick"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("len")))


def gate_state(samples: DataFrame, cache_size: int) -> DataFrame:
    """``is_open = len <= cache_size``; a NULL length (read error) closes."""
    return samples.select(
        "topic", "tick", "len",
        F.coalesce(F.col("len") <= F.lit(cache_size), F.lit(False)).alias("is_open"))


def gate_transitions(state: DataFrame) -> DataFrame:
    """pause/resume events, emitted only on a change; topics start open. The previous
    state comes from a size-checked scan, so a topic with very many samples is split."""
    return (previous_value(state, ["topic"], ["tick"], "is_open", True, "was_open")
            .where(F.col("was_open") != F.col("is_open"))
            .select("topic", "tick",
                    F.when(F.col("is_open"), F.lit("resume")).otherwise(F.lit("pause"))
                    .alias("event")))


def gate_slots(messages: DataFrame, state: DataFrame, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """(topic, slot, samples, carried): for every slot with messages or samples, the samples in
    it and the state carried in from the topic's last earlier sample (NULL: none). One row per
    active (topic, slot); a row holds the samples of one slot only.

    Both sides are reduced to slots before they meet; a topic has at most one row a slot of its time span, over
    which one window carries the last state forward."""
    sample = F.struct("tick", (~F.col("is_open")).alias("closed"))  # of equal ticks, closed counts
    samples = (state.where("topic IS NOT NULL AND tick IS NOT NULL").groupBy("topic", tick_number(F.col("tick"), slot_seconds).alias("slot"))
               .agg(F.collect_set(sample).alias("samples")))
    active = messages.select("topic", tick_number(F.col("timestamp"), slot_seconds).alias("slot"))
    active = active.where("topic IS NOT NULL AND slot IS NOT NULL").distinct()
    slots = (active.withColumn("samples", F.lit(None).cast(samples.schema["samples"].dataType)).unionByName(samples)
             .groupBy("topic", "slot").agg(F.max("samples").alias("samples")))
    earlier = Window.partitionBy("topic").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.last(~F.array_max("samples")["closed"], ignorenulls=True).over(earlier)
    return slots.withColumn("carried", carried)


def with_gate(messages: DataFrame, state: DataFrame, slot_seconds: int = SLOT_SECONDS) -> DataFrame:
    """Messages with the gate state of their topic when they arrive: the last sample at or before
    their timestamp, open before the first one. A NULL topic has no queue and is never open; a
    NULL timestamp counts as before the first sample. Messages are not shuffled: the slot table is
    looked up, and broadcast only after a check of its size."""
    slots = gate_slots(messages, state, slot_seconds)
    keyed = messages.withColumn("slot", tick_number(F.col("timestamp"), slot_seconds))
    joined = lookup_join(keyed, slots, ["topic", "slot"], "left", label="gate")
    seen = F.filter("samples", lambda s: s["tick"] <= F.col("timestamp"))
    is_open = F.coalesce(~F.array_max(seen)["closed"], F.col("carried"), F.lit(True)) & F.col("topic").isNotNull()
    return joined.withColumn("is_open", is_open).drop("slot", "samples", "carried")


def admitted(messages: DataFrame, state: DataFrame) -> DataFrame:
    """Messages whose topic's gate is open when they arrive."""
    return with_gate(messages, state).where(F.col("is_open")).drop("is_open")


def deferred(messages: DataFrame, state: DataFrame) -> DataFrame:
    """R12 complement: messages held back."""
    return with_gate(messages, state).where(~F.col("is_open")).drop("is_open")


def split_admission(messages: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    gated = with_gate(messages, state)
    return gated.where(F.col("is_open")).drop("is_open"), gated.where(~F.col("is_open")).drop("is_open")
