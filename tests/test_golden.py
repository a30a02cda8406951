"""Hand-worked mini cases (FIXTURES.md 'Hand-made mini cases')."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spillway.functions.envelope import envelope, payload_text, repaired
from spillway.functions.ledger_keys import (key_is_ledger, key_partition, key_role_is_all,
                                            key_topic, ledger_key, parse_offset)
from spillway.functions.ticks import tick_end
from spillway.operators import gate, gauge, ledger as led, queue as q


def test_envelope_special_characters(spark):
    df = spark.createDataFrame([('a<b&"c"',), (None,), ("",), ("x>y\u2028z\u2029",)], "v string")
    got = [r[0] for r in df.select(envelope(payload_text(F.col("v")))).collect()]
    assert got == [
        '{"attempts":1,"data":"a\\u003cb\\u0026\\"c\\""}',
        '{"attempts":1,"data":""}',
        '{"attempts":1,"data":""}',
        '{"attempts":1,"data":"x\\u003ey\\u2028z\\u2029"}',
    ]


def test_envelope_round_trip(spark):
    df = spark.createDataFrame([("plain",), ("<&>",), ("line\nbreak",)], "v string")
    back = df.select(F.from_json(envelope(F.col("v")), "attempts int, data string").alias("e"),
                     "v")
    for row in back.collect():
        assert row.e.attempts == 1 and row.e.data == row.v


def test_invalid_utf8_is_repaired_and_counted(spark):
    df = spark.createDataFrame([(bytearray(b"a\xffb"),), (bytearray(b"ok"),)], "v binary")
    rows = df.select(payload_text(F.col("v"), binary=True).alias("t"),
                     repaired(F.col("v")).alias("r")).collect()
    assert rows[0].t == "a�b" and rows[0].r is True
    assert rows[1].t == "ok" and rows[1].r is False


def test_offset_parse(spark):
    df = spark.createDataFrame([("45",), ("unset",), (None,), ("-3",), (" 7",)], "t string")
    got = [r[0] for r in df.select(parse_offset(F.col("t"))).collect()]
    assert got == [45, 0, 0, -3, 0]


def test_ledger_key_encode_decode(spark):
    df = spark.createDataFrame([("all", 0, "t"), ("formal", 2, "a##b")],
                               "role string, partition int, topic string")
    keys = [r[0] for r in df.select(ledger_key(F.col("role"), F.col("partition"),
                                               F.col("topic"))).collect()]
    assert keys == ["<all>##<0>##t", "<formal>##<2>##a##b"]
    kd = spark.createDataFrame([(k,) for k in keys] + [("t",)], "key string")
    k = F.col("key")
    rows = kd.where(key_is_ledger(k)).select(key_role_is_all(k), key_partition(k),
                                             key_topic(k)).collect()
    # A bare key is skipped; a topic holding the separator is cut at it.
    assert [tuple(r) for r in rows] == [(True, 0, "t"), (False, 2, "a")]


def _samples(spark, lens):
    base = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [("t", base + dt.timedelta(hours=i), v) for i, v in enumerate(lens)],
        "topic string, tick timestamp_ntz, len bigint")


def test_gate_state_and_transitions(spark):
    state = gate.gate_state(_samples(spark, [99, 100, 101, None, 100]), 100)
    got = [r.is_open for r in state.orderBy("tick").collect()]
    assert got == [True, True, False, False, True]
    ev = gate.gate_transitions(state).orderBy("tick").collect()
    hours = [r.tick.hour for r in ev]
    assert [r.event for r in ev] == ["pause", "resume"] and hours == [2, 4]


MESSAGE = "topic string, partition int, offset bigint, timestamp timestamp_ntz, value string, seq bigint"


def test_admission_starts_open_and_carries_the_last_state(spark):
    at = lambda h, m, s=0: dt.datetime(2024, 1, 1, h, m, s)
    samples = [("t", at(0, 5), 9), ("t", at(0, 7), 1), ("t", at(5, 0), None), ("u", at(0, 5), 9), ("u", at(0, 5), 1), (None, at(0, 1), 1)]
    state = gate.gate_state(spark.createDataFrame(samples, "topic string, tick timestamp_ntz, len bigint"), 5)
    want = {("t", at(0, 4, 59)): True, ("t", at(0, 5)): False, ("t", at(0, 6, 59)): False, ("t", at(0, 7)): True,
            ("t", at(3, 30)): True, ("t", at(4, 59)): True, ("t", at(5, 0)): False, ("t", at(9, 0)): False,
            ("u", at(0, 6)): False,  # two samples at once: closed counts
            ("other", at(0, 0)): True, (None, at(0, 2)): False, ("t", None): True}
    rows = [(t, 0, i, ts, "x", i) for i, (t, ts) in enumerate(want)]
    msgs = spark.createDataFrame(rows, MESSAGE)
    for slot in (60, 3600, 10 ** 6):  # the join slots do not show in results
        got = {(r.topic, r.timestamp): r.is_open for r in gate.with_gate(msgs, state, slot).collect()}
        assert got == want, slot
    ok, held = gate.split_admission(msgs, state)
    assert ok.columns == msgs.columns and ok.count() + held.count() == len(rows)
    none = state.where("topic = 'nobody'")
    assert gate.deferred(msgs, none).count() == 1  # only the record without a topic


def test_gate_slots_on_both_scan_plans(spark):
    base = dt.datetime(2024, 1, 1)
    samples = [("t", base + dt.timedelta(minutes=37 * i), i % 7) for i in range(60)]
    state = gate.gate_state(spark.createDataFrame(samples, "topic string, tick timestamp_ntz, len bigint"), 3)
    msgs = spark.createDataFrame([("t", 0, i, base + dt.timedelta(minutes=11 * i), "x", i) for i in range(200)], MESSAGE)
    both = []
    for limit in ("0", "2000000"):
        spark.conf.set("spillway.scan.maxGroupRows", limit)
        try:
            both.append(sorted(r.offset for r in gate.admitted(msgs, state).collect()))
            both.append(sorted((r.tick, r.event) for r in gate.gate_transitions(state).collect()))
        finally:
            spark.conf.unset("spillway.scan.maxGroupRows")
    assert both[:2] == both[2:] and both[0]


@pytest.mark.parametrize("seconds", [1, 7, 10, 45, 90, 3600, 86400])
def test_ticks_of_any_length_in_any_zone(spark, seconds):
    epoch = dt.datetime(1970, 1, 1)
    times = [dt.datetime(2024, 1, 1, 0, 3, 50, 999999), dt.datetime(2024, 3, 10, 2, 30), dt.datetime(1969, 12, 31, 23, 59, 59), epoch]
    zone = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {r.ts: r.e for r in df.select("ts", tick_end(F.col("ts"), seconds).alias("e")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    step = dt.timedelta(seconds=seconds)
    assert got == {t: epoch + ((t - epoch) // step + 1) * step for t in times}


def test_dense_timeline_fills_gaps_in_pieces(spark):
    base = dt.datetime(2024, 1, 1)
    sparse = [("a", 0, 3), ("a", 25, 1), ("a", 26, 0), ("b", 7, 5)]  # ticks of 90 s
    df = spark.createDataFrame([(t, base + dt.timedelta(seconds=90 * i), lag) for t, i, lag in sparse], "topic string, tick timestamp_ntz, lag bigint")
    got = sorted((r.topic, (r.tick - base).total_seconds() / 90, r.lag) for r in led.dense_lag_timeline(df, 90, piece=4).collect())
    assert got == [("a", i, 3 if i < 25 else 1 if i < 26 else 0) for i in range(27)] + [("b", i, 5) for i in range(7, 27)]
    assert led.dense_lag_timeline(df.limit(0), 90).count() == 0


def _ledger(spark, rows):
    return spark.createDataFrame(rows, "role string, topic string, partition int, "
                                       "offset bigint, seq bigint")


def test_topic_lag_clamp_after_sum(spark):
    lg = _ledger(spark, [("all", "t", 0, 10, 1), ("all", "t", 1, 5, 2),
                         ("formal", "t", 0, 12, 3), ("formal", "t", 1, 1, 4),
                         ("formal", "u", 0, 7, 5)])
    got = {r.topic: r.lag for r in led.topic_lag(led.latest_offsets(lg)).collect()}
    assert got == {"t": 2, "u": 0}  # a per-partition clamp would give 4; unseen: no row


def test_last_write_wins(spark):
    lg = _ledger(spark, [("formal", "t", 0, 9, 1), ("formal", "t", 0, 4, 2)])
    assert led.latest_offsets(lg).first().offset == 4


def test_watermarks_and_partition_lag(spark):
    msgs = spark.createDataFrame([("t", p, o, o) for p in (0, 1, 2) for o in (3, 4, 5)],
                                 "topic string, partition int, offset bigint, seq bigint")
    marks = led.watermarks(msgs).where("partition = 0").first()
    assert (marks.low_watermark, marks.high_watermark) == (3, 6)
    lg = _ledger(spark, [("formal", "t", 0, 5, 1), ("formal", "t", 1, 3, 2)])
    got = {r.partition: r.lag for r in led.partition_lag(msgs, lg).collect()}
    assert got == {0: 0, 1: 2, 2: 3}


def test_depth_timeline(spark):
    ops = spark.createDataFrame([("q", i, d) for i, d in enumerate([1, 1, -3, 1])],
                                "queue string, op_seq bigint, delta bigint")
    for chunked in (False, True):
        got = [r.depth for r in q.depth_timeline(ops, chunked=chunked).orderBy("op_seq").collect()]
        assert got == [1, 2, 0, 1]


def test_pop_two(spark):
    rows = [("q", i, f"p{i}", "t", 0, i, 0) for i in range(3)]
    queue = spark.createDataFrame(rows, "queue string, pos bigint, payload string, topic string, "
                                        "partition int, offset bigint, batch_id bigint")
    assert [r.pos for r in q.queue_pop(queue, 2).orderBy("pos").collect()] == [0, 1]
    assert [r.pos for r in q.queue_remaining(queue, 2).collect()] == [2]
    assert q.queue_pop(queue.where("pos < 0"), 2).count() == 0


def test_gauge_steps_and_ceiling(spark):
    s = spark.createDataFrame([("t", i, v) for i, v in enumerate([800, 900, 10, 10, 0, 701])],
                              "topic string, seq bigint, len bigint")
    for chunked in (False, True):
        got = [r.gauge for r in gauge.pressure_timeline(s, chunked=chunked).orderBy("seq").collect()]
        assert got == [1000, 2000, 1000, 0, 0, 1000]
    s2 = spark.createDataFrame([("t", i, 900) for i in range(1001)],
                               "topic string, seq bigint, len bigint")
    assert gauge.pressure_gauge(s2).first().gauge == 1_000_000


def test_lag_upsert(spark):
    from spillway.sinks.lag_sink import LagTable
    lt = LagTable(spark)
    lt.upsert(spark.createDataFrame([("a", 5), ("b", 2)], "topic string, lag bigint"), 1)
    lt.upsert(spark.createDataFrame([("a", 0)], "topic string, lag bigint"), 2)
    assert {r.topic: r.lag for r in lt.read().collect()} == {"a": 0, "b": 2}


def test_partition_never_consumed_counts_fully(spark):
    # formal never saw partition 1: its contribution is the last `all` offset.
    lg = _ledger(spark, [("all", "t", 0, 10, 1), ("all", "t", 1, 5, 2),
                         ("formal", "t", 0, 3, 3)])
    assert led.topic_lag(led.latest_offsets(lg)).first().lag == 12


def test_other_roles_subtract_like_formal(spark):
    lg = _ledger(spark, [("all", "t", 0, 10, 1), ("replica", "t", 0, 4, 2)])
    assert led.topic_lag(led.latest_offsets(lg)).first().lag == 6


def test_pop_and_remaining_disjoint_with_null_queue(spark):
    rows = [(None if i < 3 else "q", i % 3, f"p{i}", "t", 0, i, 0) for i in range(6)]
    queue = spark.createDataFrame(rows, "queue string, pos bigint, payload string, topic string, "
                                        "partition int, offset bigint, batch_id bigint")
    popped, rest = q.queue_pop(queue, 2), q.queue_remaining(queue, 2)
    assert popped.count() + rest.count() == 6
    assert popped.join(rest, ["offset"]).count() == 0
