"""The chunked (skew-safe) scans agree with the per-group plans and with a
plain sequential fold, also when one group holds most of the rows."""

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from paths import SF_MID
from spillway.operators import gauge, queue as q
from spillway.operators.scan import (BIG, clamp_scan, compose_prefix, previous_value, row_index,
                                     running_sum)
from spillway.sources.messages import messages_from_events
from spillway.sources.tables import table


def fold(steps, init=0):
    x, out = init, []
    for d, lo, hi in steps:
        x = min(hi, max(lo, x + d))
        out.append(x)
    return out


step = st.tuples(st.integers(-50, 50), st.integers(-100, 20), st.integers(0, 120)).map(
    lambda t: (t[0], min(t[1], t[2]), max(t[1], t[2])))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), step), min_size=1, max_size=60))
def test_compose_prefix_matches_fold(items):
    items.sort(key=lambda t: t[0])
    seg = np.array([g for g, _ in items])
    d, lo, hi = (np.array([s[i] for _, s in items]) for i in range(3))
    pd_, plo, phi = compose_prefix(seg, d, lo, hi)
    got = np.minimum(np.maximum(pd_, plo), phi)  # applied to x0 = 0
    expect = []
    for g in sorted(set(seg)):
        expect += fold([s for gg, s in items if gg == g])
    assert got.tolist() == expect


@settings(max_examples=6, deadline=None)
@given(st.lists(step, min_size=1, max_size=300), st.integers(1, 5))
def test_chunked_clamp_scan_hot_group(spark, steps, cold):
    # Group "hot" holds nearly all rows; a few small groups around it.
    rows = [("hot", i, *s) for i, s in enumerate(steps)]
    rows += [(f"c{j}", i, 1, -BIG, BIG) for j in range(cold) for i in range(3)]
    df = spark.createDataFrame(rows, "g string, o bigint, d bigint, lo bigint, hi bigint")
    out = clamp_scan(df, ["g"], ["o"], F.col("d"), F.col("lo"), F.col("hi"), "x", chunked=True)
    got = {(r.g, r.o): r.x for r in out.collect()}
    assert [got[("hot", i)] for i in range(len(steps))] == fold(steps)
    assert all(got[(f"c{j}", i)] == i + 1 for j in range(cold) for i in range(3))


def test_row_index_chunked_equals_window_on_events(spark):
    events = table(spark, SF_MID, "events")
    a = messages_from_events(events, chunked=False)
    b = messages_from_events(events, chunked=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert b.count() == events.count()


def test_row_index_single_hot_group(spark):
    df = spark.range(0, 5000).select((F.col("id") % 7 == 0).cast("int").alias("g"),
                                     (F.col("id") * 7919 % 5003).alias("k"), "id")
    a = row_index(df, ["g"], ["k", "id"], "pos", chunked=False)
    b = row_index(df, ["g"], ["k", "id"], "pos", chunked=True)
    assert a.exceptAll(b).count() == 0 and b.count() == 5000


def test_depth_and_gauge_chunked_equal_on_events(spark):
    events = table(spark, SF_MID, "events")
    msgs = messages_from_events(events)
    ops = q.queue_ops(msgs)
    a, b = q.depth_timeline(ops, chunked=False), q.depth_timeline(ops, chunked=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    s = gauge.gauge_samples(events)
    a, b = gauge.pressure_timeline(s, chunked=False), gauge.pressure_timeline(s, chunked=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_running_sum_chunked_equals_window(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("g"), "id",
                                     ((F.col("id") * 37) % 11 - 5).alias("v"))
    a = running_sum(df, ["g"], ["id"], F.col("v"), "s", chunked=False)
    b = running_sum(df, ["g"], ["id"], F.col("v"), "s", chunked=True)
    assert a.exceptAll(b).count() == 0 and b.count() == 3000


def test_null_group_keys_survive_both_plans(spark):
    rows = [(None if i % 5 == 0 else ("a" if i % 2 else "b"), i, (i * 13) % 7 - 3)
            for i in range(400)]
    df = spark.createDataFrame(rows, "g string, o bigint, v bigint")
    for fn in (lambda c: row_index(df, ["g"], ["o"], "x", chunked=c),
               lambda c: running_sum(df, ["g"], ["o"], F.col("v"), "x", chunked=c),
               lambda c: clamp_scan(df, ["g"], ["o"], F.col("v"), F.lit(0), F.lit(5), "x",
                                    chunked=c)):
        a, b = fn(False), fn(True)
        assert b.count() == 400 and a.exceptAll(b).count() == 0


def test_previous_value_both_plans(spark):
    # A hot group, a NULL group and NULL values in the column itself.
    rows = [(None if i % 7 == 0 else ("hot" if i % 3 else "c"), i,
             None if i % 11 == 0 else i * 2) for i in range(600)]
    df = spark.createDataFrame(rows, "g string, o bigint, v bigint")
    a = previous_value(df, ["g"], ["o"], "v", -1, "p", chunked=False)
    b = previous_value(df, ["g"], ["o"], "v", -1, "p", chunked=True)
    assert b.count() == 600 and a.exceptAll(b).count() == 0
    firsts = b.where("p = -1").count()
    assert firsts == 3  # one first row per group (hot, c, NULL)


def test_plans_agree_on_null_steps_and_null_order(spark):
    from spillway.operators import scan
    from spillway.session import CONF_GROUP_ROWS

    df = spark.createDataFrame([("g", None, 5), ("g", 1, None), ("g", 2, 7), ("g", 3, -20), ("g", 4, 1)], "g string, o int, d bigint")
    results = []
    for limit in ("0", "1000"):
        spark.conf.set(CONF_GROUP_ROWS, limit)
        try:
            out = scan.floored_sum(df, ["g"], ["o"], F.col("d"), "depth")
            results.append(sorted((r.o or 0, r.depth) for r in out.collect()))
        finally:
            spark.conf.unset(CONF_GROUP_ROWS)
    assert results[0] == results[1] == [(0, 5), (1, 5), (2, 12), (3, 0), (4, 1)]


def test_chunked_scans_of_an_empty_table_and_of_tied_groups(spark):
    from spillway.operators.scan import floored_sum

    empty = spark.createDataFrame([], "g string, o bigint, v bigint")
    assert row_index(empty, ["g"], ["o"], "x", chunked=True).count() == 0
    assert floored_sum(empty, ["g"], ["o"], F.col("v"), "x", chunked=True).count() == 0
    one = spark.createDataFrame([("a", 1, None), ("a", 2, 4)], "g string, o bigint, v bigint")
    sums = running_sum(one, ["g"], ["o"], F.col("v"), "x", chunked=True)
    assert sorted((r.o, r.x) for r in sums.collect()) == [(1, None), (2, 4)]


def test_clamp_scan_holds_no_whole_group_and_passes_values_through(spark):
    n, wide = 500, 2 ** 53 + 1  # not exact as a float
    rows = [("g", i, (i * 13) % 9 - 4, None if i % 3 else wide + 2 * i) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, o bigint, v bigint, kept bigint").repartition(5)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "7")
    try:
        for chunked in (False, True):
            out = clamp_scan(df, ["g"], ["o"], F.col("v"), F.lit(0), F.lit(6), "x", chunked=chunked)
            got = sorted((r.o, r.x, r.kept) for r in out.collect())
            assert [x for _, x, _ in got] == fold([(r[2], 0, 6) for r in rows])
            assert [k for _, _, k in got] == [r[3] for r in rows]
            if not chunked:
                assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(key, old)
