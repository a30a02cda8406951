"""Streams drained to the end equal the batch results; faults replay cleanly."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from spillway.operators import ledger as led
from spillway.operators.queue import route
from spillway.options import RelayOptions
from spillway.session import scratch_path
from spillway.sinks.queue_sink import read_queue, with_retry
from spillway.sources.messages import ledger, load_messages
from spillway.streaming.lag import lag_stream
from spillway.streaming.relay import (relay_metrics, relay_stream, run_relay, staged_topics, wait_until_open,
                                      write_counters)
from spillway.streaming.source import kafka_options, stage_files

OPTS = RelayOptions(topics=("click", "view"), prefix_redis="q:", sink_retry_delay_s=0.01,
                    sink_max_attempts=3, controller_time_s=0.01, consumer_num=2,
                    consumer_group="g")


def _cols(df):
    return df.select("queue", "payload", "topic", "partition", "offset")


def test_relay_stream_equals_batch(spark):
    msgs = load_messages(spark, SF_SMALL)
    got = relay_stream(spark, msgs, OPTS)
    want = _cols(route(msgs, OPTS.prefix_redis))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _run(spark, staged, options, fault=None, sink=None, ckpt=None, retries=None):
    sink = sink or scratch_path(spark, "t-queue")
    ckpt = ckpt or scratch_path(spark, "t-ckpt")
    run_relay(spark, staged, staged_topics(spark, staged), options, sink, ckpt, fault=fault,
              retries=retries)
    return staged, sink, ckpt


def test_sink_fault_retried_within_batch(spark):
    msgs = load_messages(spark, SF_SMALL).where(F.col("topic").isin("click", "view"))
    staged = stage_files(msgs, files=3, by_topic=True)
    _, clean, _ = _run(spark, staged, OPTS)

    def once(batch_id, attempt):
        if batch_id == 1 and attempt == 1:
            raise IOError("queue store unavailable")

    retries = []
    _, faulty, _ = _run(spark, staged, OPTS, fault=once, retries=retries)
    a, b = read_queue(spark, clean), read_queue(spark, faulty)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert any(used == 2 for _, bid, used in retries if bid == 1)


def test_relay_metrics_observed(spark):
    msgs = load_messages(spark, SF_SMALL).where(F.col("topic").isin("click", "view"))
    staged = stage_files(msgs, files=3, by_topic=True)
    metrics = run_relay(spark, staged, staged_topics(spark, staged), OPTS,
                        scratch_path(spark, "t-queue"), scratch_path(spark, "t-ckpt"))
    want = {r.topic: (r["count"], r["last"]) for r in
            msgs.groupBy("topic").agg(F.count(F.lit(1)).alias("count"),
                                      F.max("offset").alias("last")).collect()}
    assert {t: (m["seen"], m["last_offset"]) for t, m in metrics.items()} == want


def test_counters_cover_every_batch_and_replays(spark):
    msgs = load_messages(spark, SF_SMALL).where(F.col("topic") == "click").limit(130)
    path = scratch_path(spark, "t-counters")
    for batch_id in [*range(115), 7]:  # a stream's progress keeps 100 updates; batch 7 is replayed
        if batch_id % 23 == 7 or batch_id == 0:
            write_counters(msgs, "click", batch_id, path)
    rejected = msgs.limit(5).withColumn("topic", F.lit(None).cast("string"))
    write_counters(rejected, "click", 200, path)
    n = msgs.count()
    assert relay_metrics(spark, path)["click"] == {"seen": 6 * n + 5, "pushed": 6 * n, "rejected": 5, "batches": 7,
                                                   "last_offset": msgs.agg(F.max("offset")).first()[0]}


def test_regrouping_on_the_same_sink_is_refused(spark):
    msgs = load_messages(spark, SF_SMALL).where(F.col("topic").isin("click", "view"))
    staged = stage_files(msgs, files=2, by_topic=True)
    _, sink, ckpt = _run(spark, staged, OPTS)
    with pytest.raises(ValueError, match="another query"):
        run_relay(spark, staged, ("click", "view"), OPTS, sink, ckpt, topics_per_query=2)
    _run(spark, staged, OPTS, sink=sink, ckpt=ckpt)  # the same grouping goes on
    assert read_queue(spark, sink).count() == msgs.count()


def test_grouped_relay_equals_per_topic(spark):
    msgs = load_messages(spark, SF_SMALL)
    staged = stage_files(msgs, files=3, by_topic=True)
    topics = staged_topics(spark, staged)
    _, single, _ = _run(spark, staged, OPTS)
    sink = scratch_path(spark, "t-queue")
    metrics = run_relay(spark, staged, topics, OPTS, sink, scratch_path(spark, "t-ckpt"),
                        topics_per_query=2)
    assert len(metrics) == 3 and sum(m["seen"] for m in metrics.values()) == msgs.count()
    a = read_queue(spark, single).select("queue", "payload", "topic", "partition", "offset")
    b = read_queue(spark, sink).select("queue", "payload", "topic", "partition", "offset")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sink_fault_fails_batch_then_restart_replays(spark):
    msgs = load_messages(spark, SF_SMALL).where(F.col("topic") == "click")
    staged = stage_files(msgs, files=3, by_topic=True)
    _, clean, _ = _run(spark, staged, OPTS)
    strict = dataclasses.replace(OPTS, sink_max_attempts=1)
    sink, ckpt = scratch_path(spark, "t-queue"), scratch_path(spark, "t-ckpt")
    state = {"failed": False}

    def once(batch_id, attempt):
        if batch_id == 1 and not state["failed"]:
            state["failed"] = True
            raise IOError("queue store unavailable")

    with pytest.raises(Exception):
        run_relay(spark, staged, ("click",), strict, sink, ckpt, fault=once)
    run_relay(spark, staged, ("click",), strict, sink, ckpt, fault=once)  # restart
    a, b = read_queue(spark, clean), read_queue(spark, sink)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_lag_stream_equals_batch_lag(spark):
    msgs = load_messages(spark, SF_SMALL)
    got = {r.topic: r.lag for r in lag_stream(spark, msgs).collect()}
    want = {r.topic: r.lag for r in led.topic_lag(led.latest_offsets(ledger(msgs))).collect()}
    assert got == want


def test_gate_wait_polls_until_open():
    depths = iter([5, None, 3, 2])
    assert wait_until_open("q", lambda _: next(depths), 2, poll_s=0.0) == 3


def test_gate_wait_times_out():
    with pytest.raises(TimeoutError):
        wait_until_open("q", lambda _: 10, 2, poll_s=0.01, timeout_s=0.05)


def test_retry_counts_tries():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise IOError("down")

    assert with_retry(flaky, attempts=5, delay_s=0.0) == 3


def test_kafka_option_mapping():
    o = kafka_options(OPTS)
    assert o["subscribe"] == "click,view" and o["startingOffsets"] == "earliest"
    assert o["minPartitions"] == "4" and o["groupIdPrefix"] == "g"
    assert kafka_options(OPTS, group_suffix="_all")["groupIdPrefix"] == "g_all"


def test_pop_from_stream_written_queue_is_fifo(spark):
    from spillway.operators.queue import queue_pop
    msgs = load_messages(spark, SF_SMALL).where(F.col("topic") == "click")
    staged = stage_files(msgs, files=3, by_topic=True)
    _, sink, _ = _run(spark, staged, OPTS)
    table = read_queue(spark, sink)
    assert table.select("batch_id").distinct().count() > 1
    got = [r.offset for r in queue_pop(table, 7).orderBy("batch_id", "pos").collect()]
    want = [r.offset for r in msgs.orderBy("timestamp", "partition", "offset").limit(7).collect()]
    assert got == want
