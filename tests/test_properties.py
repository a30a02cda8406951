"""Whole-table properties on the sf0.01 tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paths import SF_MID
from spillway.operators import gate, ledger as led, queue as q
from spillway.plans.catalog import OPTIONS
from spillway.sources.messages import ledger, load_messages


@pytest.fixture(scope="module")
def msgs(spark):
    return load_messages(spark, SF_MID).cache()


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_admitted_and_deferred_partition_the_input(msgs):
    state = gate.gate_state(gate.depth_samples(msgs, 1800), OPTIONS.cache_size)
    ok, held = gate.split_admission(msgs, state)
    assert ok.count() > 0 and held.count() > 0
    assert ok.join(held, ["topic", "partition", "offset"]).count() == 0
    assert same_rows(ok.unionByName(held), msgs)


def test_pop_and_remaining_partition_the_queue(msgs):
    queue = q.relay_batch(msgs, OPTIONS.prefix_redis).cache()
    popped, rest = q.queue_pop(queue, 3), q.queue_remaining(queue, 3)
    assert popped.count() == 3 * queue.select("queue").distinct().count()
    assert same_rows(popped.unionByName(rest), queue)


def test_offsets_dense_and_in_arrival_order(msgs):
    w = Window.partitionBy("topic", "partition").orderBy("timestamp", "seq")
    check = msgs.withColumn("expect", F.row_number().over(w) - 1)
    assert check.where(F.col("offset") != F.col("expect")).count() == 0
    stats = msgs.groupBy("topic", "partition").agg(F.min("offset").alias("lo"),
                                                  F.max("offset").alias("hi"),
                                                  F.count(F.lit(1)).alias("n"))
    assert stats.where((F.col("lo") != 0) | (F.col("hi") != F.col("n") - 1)).count() == 0


def test_queue_positions_follow_partition_order(msgs):
    queue = q.relay_batch(msgs, OPTIONS.prefix_redis)
    w = Window.partitionBy("queue", "partition").orderBy("pos")
    back = queue.withColumn("prev", F.lag("offset").over(w))
    assert back.where(F.col("prev") >= F.col("offset")).count() == 0


def test_lag_timeline_ends_at_topic_lag(msgs):
    lg = ledger(msgs)
    line = led.lag_timeline(lg)
    assert line.where(F.col("lag") < 0).count() == 0
    last = line.groupBy("topic").agg(F.max_by("lag", "tick").alias("lag"))
    assert same_rows(last, led.topic_lag(led.latest_offsets(lg)))


def test_replay_from_committed_positions(msgs):
    lg = ledger(msgs)
    replayed = led.replay(msgs, led.next_positions(lg))
    consumed = lg.where(F.col("role") == "formal").select("topic", "partition", "offset")
    assert same_rows(replayed.select("topic", "partition", "offset"),
                     msgs.select("topic", "partition", "offset").exceptAll(consumed))
