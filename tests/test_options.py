"""Options contract, starting offsets for replay, gate probe on a list store."""

import json

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from spillway.operators.queue import route
from spillway.options import RelayOptions
from spillway.session import scratch_path
from spillway.sinks.list_store import FileListStore, store_depth_probe
from spillway.sinks.queue_sink import read_queue
from spillway.sources.messages import load_messages
from spillway.streaming.relay import run_relay, staged_topics
from spillway.streaming.source import stage_files, starting_offsets


def test_options_from_dict_keeps_defaults_for_zero_values():
    o = RelayOptions.from_dict({"topics": ["a", "b"], "cache_size": 0, "prefix_redis": "queues:",
                                "TopicLenMax": 5, "ControllerTime": 2, "start_lock": "x"})
    assert o.topics == ("a", "b") and o.cache_size == 10 and o.topic_len_max == 5
    assert o.controller_time_s == 2 and o.queue_of("a") == "queues:a"
    assert o.extra == {"start_lock": "x"} and o.accumulated == 1000
    with pytest.raises(ValueError):
        RelayOptions.from_dict({"cache_size": 5})


def test_sink_mode_from_host_and_port_counts():
    assert RelayOptions(redis_host=("h",), redis_port=("1",)).sink_mode() == "single"
    assert RelayOptions(redis_host=("h", "i"), redis_port=("1",)).sink_mode() == "sentinel"
    assert RelayOptions(redis_host=("h", "i"), redis_port=("1", "2")).sink_mode() == "cluster"
    assert RelayOptions(redis_host=("h",), redis_port=("1", "2")).sink_mode() == "none"


def test_starting_offsets_json(spark):
    pos = spark.createDataFrame([("t", 0, 45), ("t", 1, None), ("u", 0, 3)],
                                "topic string, partition int, next_offset bigint")
    assert json.loads(starting_offsets(pos)) == {"t": {"0": 45, "1": -2}, "u": {"0": 3}}
    with pytest.raises(ValueError):
        starting_offsets(pos, max_partitions=2)


def test_relay_waits_on_a_full_store_then_writes_everything(spark):
    opts = RelayOptions(topics=("click",), prefix_redis="q:", cache_size=2,
                        controller_time_s=0.01)
    msgs = load_messages(spark, SF_SMALL).where(F.col("topic") == "click")
    store = FileListStore(scratch_path(spark, "probe-store"))
    store.push("q:click", ["a", "b", "c"], (0, 2))  # over the limit: gate closed
    polls = {"n": 0}
    base = store_depth_probe(store)

    def probe(queue):
        polls["n"] += 1
        if polls["n"] == 3:
            store.pop(queue, 3)  # a worker drains the list: gate opens
        return base(queue)

    staged = stage_files(msgs, files=2, by_topic=True)
    sink = scratch_path(spark, "probe-queue")
    run_relay(spark, staged, staged_topics(spark, staged), opts, sink,
              scratch_path(spark, "probe-ckpt"), probe=probe)
    assert polls["n"] >= 3
    got = read_queue(spark, sink).select("queue", "payload", "topic", "partition", "offset")
    want = route(msgs, "q:").select("queue", "payload", "topic", "partition", "offset")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_kafka_rows_are_repaired_not_failed(spark):
    import datetime as dt
    from spillway.streaming.source import from_kafka_rows
    raw = spark.createDataFrame(
        [(None, bytearray(b"a\xffb"), "t", 0, 5, dt.datetime(2024, 1, 1), 0),
         (None, None, "t", 0, 6, dt.datetime(2024, 1, 1), 0)],
        "key binary, value binary, topic string, partition int, offset bigint, "
        "timestamp timestamp, timestampType int")
    rows = from_kafka_rows(raw, with_repair_flag=True).orderBy("offset").collect()
    assert rows[0].value == "a\ufffdb" and rows[0].repaired is True and rows[0].seq == 5
    assert rows[1].value is None and rows[1].repaired is False


def test_positions_from_progress(spark):
    from spillway.streaming.source import positions_from_progress
    progress = {"sources": [{"description": "KafkaV2[Subscribe[t,u]]",
                             "latestOffset": json.dumps({"t": {"0": 46, "1": 0},
                                                         "u": {"0": 3}})}]}
    rows = sorted(tuple(r) for r in positions_from_progress(spark, progress).collect())
    assert rows == [("all", "t", 0, 45, 45), ("all", "u", 0, 2, 2)]
