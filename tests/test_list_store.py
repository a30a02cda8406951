"""Queue table -> external list store: FIFO per queue, idempotent replays."""

import json

from pyspark.sql import functions as F

from paths import SF_SMALL
from spillway.operators.queue import relay_batch
from spillway.session import scratch_path
from spillway.sinks.list_store import FileListStore, push_ordered
from spillway.sources.messages import load_messages


def test_push_ordered_is_fifo_and_idempotent(spark):
    queue = relay_batch(load_messages(spark, SF_SMALL), "q:").cache()
    root = scratch_path(spark, "lists")
    factory = lambda: FileListStore(root)
    acks = {r.queue: r.pushed for r in push_ordered(queue, factory, chunk=7).collect()}
    want = {r.queue: r["count"] for r in queue.groupBy("queue").count().collect()}
    assert acks == want
    # A replay of the same rows pushes nothing new.
    again = {r.queue: r.pushed for r in push_ordered(queue, factory, chunk=7).collect()}
    assert all(v == 0 for v in again.values())
    store = FileListStore(root)
    for name, n in want.items():
        assert store.length(name) == n
        expect = [r.payload for r in queue.where(F.col("queue") == name).orderBy("pos")
                  .limit(3).collect()]
        assert store.pop(name, 3) == expect
        assert store.length(name) == n - 3
    assert json.loads(expect[0])["attempts"] == 1
    assert store.length("q:missing") == 0 and store.pop("q:missing") == []


def test_push_ordered_on_stream_batches(spark):
    # Batch-local positions repeat across batches; the (batch_id, pos) mark
    # keeps every item once and in order.
    rows = [("q", b, p, f"{b}-{p}", "t", 0, 10 * b + p) for b in range(3) for p in range(4)]
    queue = spark.createDataFrame(rows, "queue string, batch_id bigint, pos bigint, "
                                        "payload string, topic string, partition int, "
                                        "offset bigint")
    root = scratch_path(spark, "lists")
    factory = lambda: FileListStore(root)
    push_ordered(queue.where("batch_id < 2"), factory, chunk=3).collect()
    push_ordered(queue, factory, chunk=3).collect()  # replays batches 0-1, adds batch 2
    store = FileListStore(root)
    assert store.pop("q", 100) == [f"{b}-{p}" for b in range(3) for p in range(4)]
