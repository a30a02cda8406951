"""Positions of a large batch by sorted runs: the same queue table as one window a topic, from many tasks."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from spillway.operators.queue import QUEUE_COLUMNS, route, with_positions
from spillway.options import RelayOptions
from spillway.session import scratch_path
from spillway.sinks.batch_runs import StagedBatch
from spillway.sinks.claims import kept_depth
from spillway.sinks.queue_sink import read_queue
from spillway.streaming.relay import batch_writer, read_rejected

OPTS = RelayOptions(topics=("hot", "cold", "none"), prefix_redis="q:", sink_retry_delay_s=0.01, sink_max_attempts=2)
SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp_ntz, value string, seq bigint"


def batch(spark, n=3000):
    """A third of the rows without order, two topics of very different size, equal timestamps, records without a topic."""
    at = dt.datetime(2024, 1, 1)
    rows = [("cold" if i % 50 == 7 else None if i % 50 == 9 else "hot", i % 3, i // 3, at + dt.timedelta(seconds=(i * 7919) % 40),
             f"v{i}", i) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).repartition(7)


@pytest.fixture
def no_coalesce(spark):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


def as_set(rows):
    return sorted(tuple(r) for r in rows.select(*QUEUE_COLUMNS).collect())


def test_runs_equal_one_window(spark, no_coalesce):
    rows = batch(spark)
    staged = StagedBatch(rows, scratch_path(spark, "staged"))
    assert staged.spans.where("topic = 'hot'").count() > 2  # the hot topic is in many runs
    assert staged.counts(OPTS.topics) == {"seen": 3000, "rejected": 60, "n0": 2880, "n1": 60, "n2": 0, "last_offset": 999}
    got = route(staged.positioned(), "q:", batch_id=4, keep=["pos"])
    want = with_positions(route(rows.where(F.col("topic").isNotNull()), "q:", batch_id=4), chunked=False)
    assert as_set(got) == as_set(want)


@pytest.mark.parametrize("limit", ["1000000", "0"])
def test_positions_with_and_without_broadcast(spark, no_coalesce, limit):
    spark.conf.set("spillway.broadcast.maxRows", limit)
    try:
        staged = StagedBatch(batch(spark, 400), scratch_path(spark, "staged"))
        places = staged.positioned().groupBy("topic").agg(F.sort_array(F.collect_list("pos")).alias("p")).collect()
    finally:
        spark.conf.unset("spillway.broadcast.maxRows")
    assert all(r.p == list(range(len(r.p))) for r in places) and len(places) == 2


def test_writer_tables_totals_and_replay(spark, no_coalesce):
    tables = {}
    for runs in (False, True):
        path = scratch_path(spark, "queue")
        write = batch_writer(path, OPTS, OPTS.topics, runs=runs)
        for batch_id in (0, 1, 1):  # the last is a replay
            write(batch(spark, 600 + 50 * batch_id), batch_id)
        depth = [kept_depth(spark, path, f"{path}-claims", f"q:{t}") for t in OPTS.topics]
        tables[runs] = as_set(read_queue(spark, path)), read_rejected(spark, path).count(), depth
    assert tables[True] == tables[False]
    assert tables[True][1] == 12 + 13


def test_fault_and_empty_batch(spark):
    path, faults = scratch_path(spark, "queue"), []

    def fault(batch_id, attempt):
        if attempt == 1:
            faults.append(batch_id)
            raise OSError("planted")

    write = batch_writer(path, OPTS, OPTS.topics, fault=fault, runs=True)
    write(batch(spark, 90), 0)
    write(batch(spark, 90).where("false"), 1)
    assert faults == [0, 1] and read_queue(spark, path).count() == 88


def test_the_trigger_limit_decides(spark, monkeypatch):
    from spillway.streaming import relay
    used = []
    monkeypatch.setattr(relay, "StagedBatch", lambda *a: used.append(a) or StagedBatch(*a))
    for limit in (10_000, 5_000_000):
        path = scratch_path(spark, "queue")
        batch_writer(path, dataclasses.replace(OPTS, max_records_per_trigger=limit), OPTS.topics)(batch(spark, 30), 0)
    assert len(used) == 1
