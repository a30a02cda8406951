"""Claims of many workers, kept depths, compaction and rejected records."""

import threading

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from spillway.operators.queue import QUEUE_COLUMNS, route, with_positions
from spillway.options import RelayOptions
from spillway.session import scratch_path
from spillway.sinks import claims, compaction, pop_log
from spillway.sinks.entries import Entries
from spillway.sinks.queue_sink import manifest_of, read_queue, write_queue
from spillway.sources.messages import MESSAGE_SCHEMA, load_messages
from spillway.streaming.relay import batch_writer, read_rejected

SCHEMA = "queue string, pos bigint, payload string, topic string, partition int, offset bigint, batch_id bigint"


def push(spark, path, rows):
    """rows: (queue, batch, pos)."""
    write_queue(spark.createDataFrame([(q, p, f"{q}{b}{p}", q, 0, p, b) for q, b, p in rows], SCHEMA), path)
    for queue, batch in sorted({(q, b) for q, b, _ in rows}, key=lambda x: x[1]):
        claims.record_pushes(spark, path, [(queue, batch, sum(r[:2] == (queue, batch) for r in rows))])


@pytest.fixture
def table(spark):
    path = scratch_path(spark, "t-claims")
    return path, f"{path}-claims"


def keys(df):
    return sorted((r.queue, r.batch_id, r.pos) for r in df.collect())


# --- entries -------------------------------------------------------------------------------

def test_an_entry_is_created_once(spark, tmp_path):
    a, b = (Entries(spark, str(tmp_path / "e"), keep=2) for _ in range(2))
    assert a.newest() == (-1, {}) and a.put(0, {"by": "a"}) and not b.put(0, {"by": "b"})
    assert b.newest() == (0, {"by": "a"})
    for n in range(1, 9):
        assert b.put(n, {"n": n})
    assert a.numbers() == [6, 7, 8] and a.newest(below=8) == (7, {"n": 7})
    assert not a.put(3, {"late": 1}) and a.newest() == (8, {"n": 8}) and 3 not in a.numbers()  # its entry is gone, not free
    assert a.put(8, {"again": 1}, replace=True) and b.newest() == (8, {"again": 1})


def test_racing_writers_create_each_number_once(spark, tmp_path):
    won = []

    def write(name):
        own = Entries(spark, str(tmp_path / "race"), keep=50)
        for n in range(40):
            if own.put(n, {"by": name}):
                won.append(n)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == len(set(won)) and max(won) == 39


# --- claims --------------------------------------------------------------------------------

def test_interleaved_workers_share_no_item(spark, table):
    path, log = table
    push(spark, path, [("q", 0, i) for i in range(4)] + [("q", 1, i) for i in range(3)] + [("other", 0, 0)])
    got = {}

    def second():  # commits between the first worker's look and its commit
        if "b" not in got:
            got["b"] = keys(claims.claim(spark, path, log, "q", 3, "b"))

    got["a"] = keys(claims.claim(spark, path, log, "q", 2, "a", before_commit=second))
    assert got["b"] == [("q", 0, 0), ("q", 0, 1), ("q", 0, 2)] and got["a"] == [("q", 0, 3), ("q", 1, 0)]
    assert claims.kept_depth(spark, path, log, "q") == 2
    assert keys(claims.claim(spark, path, log, "q", 3, "b")) == got["b"]  # repeated: the same items, nothing more
    assert keys(claims.claim(spark, path, log, "q", 99, "c")) == [("q", 1, 1), ("q", 1, 2)]
    assert keys(claims.claim(spark, path, log, "q", 5, "d")) == [] == keys(claims.claim(spark, path, log, "nobody", 5, "d"))
    push(spark, path, [("q", 2, 0)])
    assert keys(claims.claim(spark, path, log, "q", 5, "d")) == [("q", 2, 0)]  # an empty claim leaves no trace
    depths = {r.queue: (r.pushed, r.taken, r.depth) for r in claims.kept_depths(spark, path, log).collect()}
    assert depths == {"q": (8, 8, 0), "other": (1, 0, 1)}
    marks = {r.queue: (tuple(r.mark), r.taken) for r in claims.marks(spark, log).collect()}
    assert marks == {"q": ((2, 0), 8)}


def test_a_claim_lost_after_its_commit_is_found_again(spark, table):
    path, log = table
    push(spark, path, [("q", 0, i) for i in range(5)])
    claims.claim(spark, path, log, "q", 2, "a")  # the worker dies before it reads its items
    assert keys(claims.claim(spark, path, log, "q", 2, "b")) == [("q", 0, 2), ("q", 0, 3)]
    assert keys(claims.claim(spark, path, log, "q", 2, "a")) == [("q", 0, 0), ("q", 0, 1)]


def test_threads_claim_every_item_once(spark, table):
    path, log = table
    push(spark, path, [("q", b, i) for b in range(3) for i in range(10)])
    taken, failed = [], []

    def work(name):
        try:
            for k in range(20):
                own = keys(claims.claim(spark, path, log, "q", 4, f"{name}-{k}"))
                taken.extend(own)
                if not own:
                    return
        except Exception as err:  # noqa: BLE001
            failed.append(err)

    threads = [threading.Thread(target=work, args=(n,)) for n in "abc"]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and sorted(taken) == sorted(("q", b, i) for b in range(3) for i in range(10))


def test_pops_of_two_workers_are_disjoint(spark, table):
    path, log = table
    push(spark, path, [(q, 0, i) for q in ("x", "y", "007") for i in range(3)])
    one, two = (keys(pop_log.pop(spark, path, log, 2, k)) for k in (1, 2))
    assert len(one) == 6 and len(two) == 3 and not set(one) & set(two)
    assert keys(pop_log.pop(spark, path, log, 2, 2)) == two


# --- kept totals ---------------------------------------------------------------------------

def test_totals_follow_batches_and_replays(spark, table):
    path, log = table
    for batch, n in enumerate([3, 2, 4]):
        claims.record_pushes(spark, path, [("q", batch, n)])
    claims.record_pushes(spark, path, [("q", 2, 4)])  # replayed
    assert claims.kept_depth(spark, path, log, "q") == 9
    for batch in range(3, 60):
        claims.record_pushes(spark, path, [("q", batch, 1)])
    assert claims.kept_depth(spark, path, log, "q") == 66
    assert len(Entries(spark, f"{claims.pushes_of(path)}/{claims.folder_of('q')}").numbers()) < 60


def test_relay_keeps_totals_counters_and_rejected_records(spark, table):
    path, log = table
    opts = RelayOptions(topics=("click",), prefix_redis="q:")
    write = batch_writer(path, opts, ("click",), counters=f"{path}-counters")
    msgs = load_messages(spark, SF_SMALL).where("topic = 'click'").limit(9)
    bad = msgs.limit(2).withColumn("topic", F.lit(None).cast("string"))
    for batch_id, rows in ((0, msgs.unionByName(bad)), (1, msgs), (1, msgs), (2, bad), (3, spark.createDataFrame([], MESSAGE_SCHEMA))):
        write(rows, batch_id)
    n = msgs.count()
    assert claims.kept_depth(spark, path, log, "q:click") == 2 * n == read_queue(spark, path).count()
    rejected = read_rejected(spark, path).collect()
    assert sorted(r.batch_id for r in rejected) == [0, 0, 2, 2] and {r.reason for r in rejected} == {"missing_topic"}
    from spillway.streaming.relay import relay_metrics

    counted = relay_metrics(spark, f"{path}-counters")["click"]
    assert (counted["seen"], counted["pushed"], counted["rejected"], counted["batches"]) == (2 * n + 4, 2 * n, 4, 4)


# --- compaction ----------------------------------------------------------------------------

def test_many_batches_leave_few_files(spark, table):
    path, log = table
    want = []
    for turn in range(5):
        rows = [(q, turn * 20 + b, i) for q in ("q", "ü/=") for b in range(20) for i in range(3)]
        push(spark, path, rows)
        want += rows
        assert compaction.compact(spark, path, log)
        assert keys(read_queue(spark, path)) == sorted(want)
    assert compaction.file_count(spark, path) < 120  # 200 batches were written, the last 20 of each queue are replaced at the next turn
    compaction.compact(spark, path, log, keep_batches=1)
    assert keys(read_queue(spark, path)) == sorted(want)


def test_a_task_of_a_compaction_sorts_a_bounded_number_of_rows(spark, table, monkeypatch):
    path, log = table
    rows = [(q, b, i) for q in ("a", "b") for b in range(6) for i in range(20)]
    push(spark, path, rows)
    monkeypatch.setattr(compaction, "FILE_ROWS", 40)
    assert compaction.compact(spark, path, log)
    base = Entries(spark, manifest_of(path)).newest()[1]["base"]
    files = spark.read.parquet(base).groupBy(F.input_file_name().alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("queue", "batch_id", "pos")).alias("first"),
        F.max(F.struct("queue", "batch_id", "pos")).alias("last")).orderBy("first").collect()
    assert len(files) >= 4 and max(f.n for f in files) < 100 and sum(f.n for f in files) == 160
    assert all(a.last < b.first for a, b in zip(files, files[1:]))
    assert keys(read_queue(spark, path)) == sorted(rows)


def test_compaction_drops_what_was_taken_and_keeps_claims_repeatable(spark, table):
    path, log = table
    rows = [("q", b, i) for b in range(10) for i in range(4)]
    push(spark, path, rows)
    taken = [keys(claims.claim(spark, path, log, "q", 1, f"c{k}")) for k in range(24)]
    before = claims.kept_depth(spark, path, log, "q")
    assert compaction.compact(spark, path, log)
    assert len(keys(read_queue(spark, path))) < len(rows)
    assert keys(claims.claim(spark, path, log, "q", 1, "c23")) == taken[23]
    assert keys(claims.claim(spark, path, log, "q", 1, "new")) == [("q", 6, 0)] and claims.kept_depth(spark, path, log, "q") == before - 1
    rest = keys(claims.claim(spark, path, log, "q", 100, "rest"))
    assert sorted(sum(taken, []) + [("q", 6, 0)] + rest) == sorted(rows)


def test_a_crash_before_the_switch_is_harmless(spark, table, monkeypatch):
    path, log = table
    rows = [("q", b, i) for b in range(6) for i in range(2)]
    push(spark, path, rows)
    with monkeypatch.context() as m:
        m.setattr(Entries, "put", lambda *a, **k: (_ for _ in ()).throw(OSError("crash")))
        with pytest.raises(OSError):
            compaction.compact(spark, path, log)
    assert keys(read_queue(spark, path)) == sorted(rows) and Entries(spark, manifest_of(path)).newest() == (-1, {})
    assert compaction.compact(spark, path, log) and keys(read_queue(spark, path)) == sorted(rows)
    push(spark, path, [("q", 5, 0)])  # the newest batch is replayed with other rows: it was not merged
    assert keys(read_queue(spark, path)) == sorted(r for r in rows if r != ("q", 5, 1))


def test_readers_of_the_replaced_snapshot_finish(spark, table):
    path, log = table
    rows = [("q", b, i) for b in range(8) for i in range(2)]
    push(spark, path, rows)
    old = read_queue(spark, path)
    assert compaction.compact(spark, path, log)
    assert keys(old) == sorted(rows)


def test_one_of_two_compactions_wins(spark, table, monkeypatch):
    path, log = table
    push(spark, path, [("q", b, 0) for b in range(8)])
    real = Entries.put

    def late(self, number, entry, replace=False):
        monkeypatch.setattr(Entries, "put", real)
        assert compaction.compact(spark, path, log)  # another compaction switches first
        return real(self, number, entry, replace)

    monkeypatch.setattr(Entries, "put", late)
    assert compaction.compact(spark, path, log) is False
    assert keys(read_queue(spark, path)) == [("q", b, 0) for b in range(8)]


def test_stream_readers_hold_batches_back(spark, table):
    path, log = table
    push(spark, path, [("q", b, 0) for b in range(10)] + [("r", b, 0) for b in range(10)])
    assert compaction.compact(spark, path, log, streamed={"q": 3})
    assert Entries(spark, manifest_of(path)).newest()[1]["upto"] == {"q": 3}
    assert len(keys(read_queue(spark, path))) == 20


def test_positions_survive_compaction(spark, table):
    path, log = table
    routed = route(load_messages(spark, SF_SMALL), "q:", batch_id=F.floor(F.col("seq") / 200))
    rows = with_positions(routed).select(*QUEUE_COLUMNS)
    write_queue(rows, path)
    assert compaction.compact(spark, path, log)
    got = read_queue(spark, path)
    assert got.exceptAll(rows).count() == 0 and got.count() == rows.count()
