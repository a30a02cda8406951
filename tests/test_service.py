"""Service form: relay into the queue table, lag from topic positions + relay output."""

import time

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from spillway.operators import ledger as led
from spillway.options import RelayOptions
from spillway.session import scratch_path
from spillway.sinks.lag_sink import LagTable
from spillway.sinks import pop_log
from spillway.sinks.queue_sink import read_queue, write_queue
from spillway.sources.messages import FORMAL_CUT, MESSAGE_SCHEMA, ledger, load_messages
from spillway.streaming.relay import group_stream, staged_topics
from spillway.streaming.service import consumed_stream, start_lag, start_relay
from spillway.streaming.source import file_stream, stage_files


def test_lag_service_over_relay_output_equals_topic_lag(spark):
    msgs = load_messages(spark, SF_SMALL)
    consumed = msgs.where(F.col("timestamp") < F.lit(FORMAL_CUT).cast("timestamp_ntz"))
    staged = stage_files(consumed, files=2, by_topic=True)
    opts = RelayOptions(topics=staged_topics(spark, staged), prefix_redis="q:")
    queue_path = scratch_path(spark, "svc-queue")
    relays = start_relay(spark, opts, queue_path, scratch_path(spark, "svc-relay"),
                         topics_per_query=2, gated=False,
                         source=lambda group: group_stream(spark, staged, group, 1))
    for q in relays:
        q.awaitTermination()
    assert read_queue(spark, queue_path).count() == consumed.count()

    positions = file_stream(spark, stage_files(msgs, files=3)).select(
        "topic", "partition", "offset", "seq")
    table = LagTable(spark)
    lag = start_lag(spark, opts, positions, consumed_stream(spark, queue_path), table,
                    scratch_path(spark, "svc-state"), scratch_path(spark, "svc-lag"), drain=True)
    lag.awaitTermination()
    got = {r.topic: r.lag for r in table.read().collect()}
    want = {r.topic: r.lag for r in led.topic_lag(led.latest_offsets(ledger(msgs))).collect()}
    assert got == want and any(v > 0 for v in got.values())


def _queue(spark, rows):
    return spark.createDataFrame([(q, pos, f"{q}{batch}{pos}", q, 0, pos, batch) for q, batch, pos in rows],
                                 "queue string, pos bigint, payload string, topic string, partition int, offset bigint, batch_id bigint")


def test_pops_are_durable_and_repeatable(spark):
    path, log = scratch_path(spark, "t-pops"), scratch_path(spark, "t-log")
    write_queue(_queue(spark, [("007", 0, i) for i in range(3)] + [("b", 0, 0)]), path)
    probe = pop_log.depth_probe(spark, path, log)
    taken = lambda n, k: sorted((r.queue, r.batch_id, r.pos) for r in pop_log.pop(spark, path, log, n, k).collect())
    assert probe("007") == 3 and probe("nobody") == 0
    first = taken(2, 1)
    assert first == [("007", 0, 0), ("007", 0, 1), ("b", 0, 0)] == taken(2, 1)  # the same pop takes nothing more
    assert probe("007") == 1 and probe("b") == 0
    write_queue(_queue(spark, [("007", 1, 0), ("b", 1, 0)]), path)
    assert taken(2, 2) == [("007", 0, 2), ("007", 1, 0), ("b", 1, 0)]
    assert taken(2, 3) == [] and probe("007") == 0
    with pytest.raises(ValueError):
        pop_log.pop(spark, path, log, 2, 1)


def test_default_gate_waits_for_pops(spark):
    msgs = load_messages(spark, SF_SMALL).where(F.col("topic") == "click")
    staged = stage_files(msgs, files=3, by_topic=True)
    opts = RelayOptions(topics=("click",), prefix_redis="q:", cache_size=5, controller_time_s=0.05)
    path = scratch_path(spark, "t-gated")
    (query,) = start_relay(spark, opts, path, scratch_path(spark, "t-gated-ckpt"),
                           source=lambda group: group_stream(spark, staged, group, 1))
    try:
        deadline = time.monotonic() + 60
        probe = pop_log.depth_probe(spark, path, f"{path}-pops")
        while probe("q:click") == 0 and time.monotonic() < deadline:
            time.sleep(0.1)
        held = probe("q:click")
        time.sleep(1)
        assert 5 < held < msgs.count() and probe("q:click") == held  # full: the next batch is held back
        got, k = 0, 0
        while query.isActive and time.monotonic() < deadline:
            k += 1
            got += pop_log.pop(spark, path, f"{path}-pops", 1000, k).count()
        assert not query.isActive and query.exception() is None
        got += pop_log.pop(spark, path, f"{path}-pops", 10 ** 6, k + 1).count()
        assert got == msgs.count() == read_queue(spark, path).count()
    finally:
        query.stop()


def test_last_write_wins_after_a_rewind(spark):
    path = scratch_path(spark, "t-rewind")
    rows = [("t", 0, 0, 9), ("t", 1, 0, 4)]  # (topic, batch, pos, offset): 9 first, then back to 4
    write_queue(spark.createDataFrame([(t, p, "x", t, 0, o, b) for t, b, p, o in rows],
                                      "queue string, pos bigint, payload string, topic string, partition int, offset bigint, batch_id bigint"), path)
    newest = spark.createDataFrame([("t", 0, 10, None, "x", 10)], MESSAGE_SCHEMA)
    positions = file_stream(spark, stage_files(newest, files=1)).select("topic", "partition", "offset", "seq")
    table = LagTable(spark)
    start_lag(spark, RelayOptions(topics=("t",)), positions, consumed_stream(spark, path), table,
              scratch_path(spark, "t-state"), scratch_path(spark, "t-lag"), drain=True).awaitTermination()
    assert [(r.topic, r.lag) for r in table.read().collect()] == [("t", 6)]
