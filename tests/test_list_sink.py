"""The list sink: runs staged by tasks, published by the driver, once whatever fails."""

import datetime as dt
import os
import tempfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.errors import StreamingQueryException

from spillway.operators.queue import route
from spillway.session import scratch_path
from spillway.sinks import list_sink
from spillway.sinks.list_sink import ListWriter, Pushed, QueueLists, RunLists, pieces, push_stream, read_lists
from spillway.streaming.topic_log import append_log, drain, log_stream

AT = dt.datetime(2024, 1, 1)
SCHEMA = "topic string, partition int, offset bigint, timestamp timestamp_ntz, value binary"


def append(spark, log, first, before, topics=("a", "b")):
    rows = [(t, p, n, AT, f"{t}{p}-{n}".encode()) for t in topics for p in range(2) for n in range(first, before)]
    append_log(spark.createDataFrame(rows, SCHEMA), log)


def push(spark, log, lists, checkpoint, store=QueueLists, limit=None):
    drain(push_stream(route(log_stream(spark, log, max_records=limit), "q:"), lists, checkpoint, store).start())


def content(spark, lists):
    out = {}
    for r in sorted(read_lists(spark, lists).collect(), key=lambda r: (r.queue, r.pos)):
        out.setdefault(r.queue, []).append((r.pos, r.partition, r.offset))
    return out


def whole(content, n, topics=("a", "b")):
    """Every item once, dense positions, each partition in the order of its offsets."""
    assert set(content) == {f"q:{t}" for t in topics}
    for items in content.values():
        assert [pos for pos, _, _ in items] == list(range(2 * n))
        for p in range(2):
            assert [o for _, q, o in items if q == p] == list(range(n))


@pytest.fixture
def folders(spark):
    return tuple(scratch_path(spark, f"ls-{x}") for x in ("log", "lists", "ckpt"))


def test_batches_and_restarts_push_once(spark, folders):
    log, lists, checkpoint = folders
    assert read_lists(spark, lists).count() == 0
    append(spark, log, 0, 40)
    push(spark, log, lists, checkpoint, limit=50)
    append(spark, log, 40, 60)
    push(spark, log, lists, checkpoint, limit=50)
    push(spark, log, lists, checkpoint)
    whole(content(spark, lists), 60)
    assert RunLists(lists).length("q:a") == 120 and RunLists(lists).length("q:none") == 0
    payload = read_lists(spark, lists).where("queue = 'q:b' and partition = 1 and offset = 59").first().payload
    assert '"b1-59"' in payload
    root = lists.removeprefix("file:")
    assert sum(len(f) for _, _, f in os.walk(f"{root}/open")) == 0


@pytest.mark.parametrize("where", ["stage", "publish", "after"])
def test_a_fault_leaves_neither_gaps_nor_copies(spark, folders, where):
    log, lists, checkpoint = folders
    marks = tempfile.mkdtemp(prefix="list-sink-faults-")

    class Faulty(RunLists):  # local classes go to the tasks by value
        def _once(self, what):
            if what.startswith(where) and len(os.listdir(marks)) < 2:  # the second call of the kind fails, once
                open(f"{marks}/{len(os.listdir(marks))}", "x").close()
                if len(os.listdir(marks)) == 2:
                    raise OSError("planted fault")

        def stage(self, writer, name, rows):
            self._once("stage")
            super().stage(writer, name, rows)

        def publish(self, writer, queue, batch_id, runs):
            self._once("publish")
            if where == "after" and queue == "q:b" and not os.listdir(marks):
                open(f"{marks}/0", "x").close()
                self.fs.create_dir(f"{self.root}/lists/{list_sink.folder_of(queue)}/runs/{batch_id:020d}")
                self.fs.move(f"{self._open(writer)}/{runs[0].name}.parquet",
                             f"{self.root}/lists/{list_sink.folder_of(queue)}/runs/{batch_id:020d}/000009.parquet")
                raise OSError("planted fault between a move and the entry")
            return super().publish(writer, queue, batch_id, runs)

    class FaultyLists(QueueLists):
        lists = Faulty

        @classmethod
        def name(cls):
            return f"faultylists{where}"

    append(spark, log, 0, 30)
    try:
        push(spark, log, lists, checkpoint, FaultyLists)
    except StreamingQueryException:
        pass
    assert os.listdir(marks)
    if where != "stage":  # one queue has the batch, the other has nothing of it
        seen = content(spark, lists)
        assert set(seen) == {"q:a"} and len(seen["q:a"]) == 60
    push(spark, log, lists, checkpoint, FaultyLists)
    append(spark, log, 30, 35)
    push(spark, log, lists, checkpoint, FaultyLists)
    whole(content(spark, lists), 35)


def batch_of(rows):
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("queue", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()),
                                                              ("payload", pa.string())]))


def item(queue, partition, offset):
    return {"queue": queue, "partition": partition, "offset": offset, "payload": f"{queue}{partition}-{offset}"}


def test_writer_cuts_runs_and_refuses_disorder(tmp_path, monkeypatch):
    monkeypatch.setattr(list_sink, "RUN_ITEMS", 3)
    lists = RunLists(str(tmp_path))
    writer = ListWriter(lists, "w")
    mixed = [item("a", 0, 0), item("b", 0, 5), item("a", 1, 0), item("a", 0, 1), item("a", 0, 2), item("a", 0, 7)]
    one = writer.write(iter([batch_of(mixed), batch_of([]), batch_of([item("a", 0, 8), item("b", 0, 6)])]))
    assert sorted((r.queue, r.partition, r.first, r.last, r.n) for r in one.runs) == [("a", 0, 0, 7, 4), ("a", 0, 8, 8, 1), ("a", 1, 0, 0, 1),
                                                                                     ("b", 0, 5, 6, 2)]
    two = writer.write(iter([batch_of([item("a", 0, 3)])]))  # inside the first run's span
    with pytest.raises(ValueError, match="order of their offsets"):
        writer.commit([one, two, None], 0)
    assert lists.length("a") == 0
    one = writer.write(iter([batch_of(mixed)]))
    writer.commit([one, Pushed([])], 0)
    writer.commit([writer.write(iter([batch_of(mixed)]))], 0)  # a replay
    assert (lists.length("a"), lists.length("b")) == (5, 1)
    with pytest.raises(ValueError, match="another stream"):
        lists.publish("other", "a", 1, [])
    for bad in ({"queue": None}, {"offset": None}, {"partition": None}):
        with pytest.raises(ValueError, match="needs a queue"):
            writer.write(iter([batch_of([item("a", 0, 9) | bad])]))


def test_pieces_are_growing_stretches():
    queues = pa.array(["x", "y", "x", "x", "x", "y"])
    got = [rows.tolist() for rows in pieces(queues, np.zeros(6, np.int32), np.array([1, 1, 2, 2, 3, 5]))]
    assert got == [[0, 2], [3, 4], [1, 5]]
