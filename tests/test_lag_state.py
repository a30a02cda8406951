"""Streaming lag with one state: bounded folders, restart, late and repeated rows."""

import pandas as pd
from pyspark.sql import functions as F

from paths import SF_SMALL
from spillway.operators import ledger as led
from spillway.session import scratch_path
from spillway.sinks.entries import subfolders
from spillway.sinks.lag_sink import LagTable
from spillway.sources.messages import ledger, load_messages
from spillway.streaming.lag import POSITIONS, lag_stream, start_updates
from spillway.streaming.source import file_stream


def lags(df):
    return {r.topic: r.lag for r in df.collect()}


def positions(spark, path):
    from pyspark.sql.types import _parse_datatype_string

    return file_stream(spark, path, schema=_parse_datatype_string(POSITIONS))


def add(spark, path, rows):
    spark.createDataFrame(rows, POSITIONS).coalesce(1).write.mode("append").parquet(path)


def drain(spark, path, table, ckpt):
    query = start_updates(positions(spark, path), table, ckpt, {"availableNow": True})
    query.awaitTermination()


def test_lag_over_restarts(spark):
    path, ckpt, table = scratch_path(spark, "t-pos"), scratch_path(spark, "t-ckpt"), LagTable(spark)
    add(spark, path, [("all", "a", 0, 10, 1), ("all", "a", 1, 5, 2), ("formal", "a", 0, 4, 1), ("all", "b", 0, 7, 3)])
    drain(spark, path, table, ckpt)
    assert lags(table.read()) == {"a": 11, "b": 7}
    add(spark, path, [("formal", "a", 0, 9, 2), ("all", "a", 0, 3, 0), ("all", None, 0, 99, 9), ("all", "a", None, 99, 9)])
    drain(spark, path, table, ckpt)  # a new query on the same checkpoint: an older seq and rows without a key change nothing
    assert lags(table.read()) == {"a": 6, "b": 7}
    add(spark, path, [("all", "a", 0, 2, 8), ("formal", "b", 0, 50, 1)])  # a rewind lowers the offset, the lag stops at 0
    drain(spark, path, table, ckpt)
    assert lags(table.read()) == {"a": 0, "b": 0}
    versions = {r.topic: r.version for r in table.read().collect()}
    assert versions["a"] == versions["b"] == 2


def test_folders_stay_few(spark):
    table = LagTable(spark)
    for version in range(30):
        table.upsert(spark.createDataFrame([(f"t{version % 3}", version)], "topic string, lag bigint"), version)
    assert lags(table.read()) == {"t0": 27, "t1": 28, "t2": 29}
    assert len([f for f in subfolders(spark, table.path) if f.startswith("snapshot")]) == 2
    table.upsert(spark.createDataFrame([("t2", 29)], "topic string, lag bigint"), 29)  # replayed
    table.upsert(spark.createDataFrame([("t0", 1)], "topic string, lag bigint"), 5)  # late
    assert lags(table.read()) == {"t0": 27, "t1": 28, "t2": 29}


def test_readers_of_the_previous_snapshot_finish(spark):
    table = LagTable(spark)
    assert table.read().count() == 0
    table.upsert(spark.createDataFrame([("a", 1)], "topic string, lag bigint"), 0)
    old = table.read()
    table.upsert(spark.createDataFrame([("a", 2)], "topic string, lag bigint"), 1)
    assert lags(old) == {"a": 1} and lags(table.read()) == {"a": 2}


def test_drained_state_equals_batch_lag(spark):
    msgs = load_messages(spark, SF_SMALL)
    assert lags(lag_stream(spark, msgs, files=3)) == lags(led.topic_lag(led.latest_offsets(ledger(msgs))))


def test_reduction_keeps_the_newest_of_each_key(spark):
    from spillway.streaming.lag import _newest

    rows = pd.DataFrame([("all", "a", 0, 5, 1), ("all", "a", 0, 3, 2), ("formal", "a", 0, 1, 9), ("all", None, 0, 1, 1)],
                        columns=["role", "topic", "partition", "offset", "seq"])
    assert sorted(map(tuple, _newest(rows).itertuples(index=False))) == [("all", "a", 0, 3, 2), ("formal", "a", 0, 1, 9)]
