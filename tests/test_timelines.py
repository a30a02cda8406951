"""Kept timelines: extended part by part they equal one scan; repeats, crashes and late rows."""

import pytest
from pyspark.sql import functions as F

from spillway.operators.gauge import pressure_timeline
from spillway.operators.queue import depth_timeline
from spillway.session import scratch_path
from spillway.sinks.timelines import kept_depth_timeline, kept_pressure_timeline

OPS = "queue string, op_seq bigint, delta bigint"
SAMPLES = "topic string, seq bigint, len bigint"


def ops(n):
    """A hot queue, a rare one, one without a name, and one that is seen late."""
    out = []
    for i in range(n):
        queue = None if i % 17 == 0 else "rare" if i % 11 == 0 else "late" if i > 0.7 * n and i % 5 == 0 else "hot"
        out.append((queue, i, None if i % 29 == 0 else [1, 1, -3, 2, -1, 1, -4][i % 7]))
    return out


def same(a, b):
    assert sorted(map(tuple, a.select(b.columns).collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.mark.parametrize("max_rows", ["2000000", "0"])  # the window plan, and the chunked one
def test_parts_equal_one_scan(spark, max_rows):
    spark.conf.set("spillway.scan.maxGroupRows", max_rows)
    try:
        rows = ops(300)
        line = kept_depth_timeline(spark, scratch_path(spark, "kept-depth"))
        for part, (a, b) in enumerate([(0, 180), (180, 297), (297, 300)]):
            assert line.extend(part, spark.createDataFrame(rows[a:b], OPS))
        same(line.read(), depth_timeline(spark.createDataFrame(rows, OPS)))

        samples = [(q, i, 0 if i % 23 == 0 else (i * 37) % 1400) for q, i, _ in rows]
        gauge = kept_pressure_timeline(spark, scratch_path(spark, "kept-gauge"), ceiling=3000)
        for part, (a, b) in enumerate([(0, 200), (200, 299), (299, 300)]):
            assert gauge.extend(part, spark.createDataFrame(samples[a:b], SAMPLES))
        same(gauge.read(), pressure_timeline(spark.createDataFrame(samples, SAMPLES), ceiling=3000))
    finally:
        spark.conf.unset("spillway.scan.maxGroupRows")


def test_repeats_gaps_late_rows_and_an_empty_part(spark):
    line = kept_depth_timeline(spark, scratch_path(spark, "kept-faults"))
    with pytest.raises(ValueError, match="no part"):
        line.read()
    first = spark.createDataFrame([("a", 1, 5), (None, 1, 2)], OPS)
    with pytest.raises(ValueError, match="do not come after"):
        line.extend(0, spark.createDataFrame([("a", None, 5)], OPS))
    assert line.extend(0, first) and not line.extend(0, first)  # a repeat changes nothing
    with pytest.raises(ValueError, match="comes before"):
        line.extend(2, first)
    for late in [("a", 1, 1), ("a", 0, 1), (None, 1, 1), ("a", None, 1)]:
        with pytest.raises(ValueError, match="do not come after"):
            line.extend(1, spark.createDataFrame([late], OPS))
    assert line.extend(1, spark.createDataFrame([], OPS))
    assert line.extend(2, spark.createDataFrame([("a", 2, -2), (None, 9, -5), ("b", 0, 1)], OPS))
    got = {(r.queue, r.op_seq): r.depth for r in line.read().collect()}
    assert got == {("a", 1): 5, (None, 1): 2, ("a", 2): 3, (None, 9): 0, ("b", 0): 1}


def test_what_a_crash_left_is_not_read(spark):
    path = scratch_path(spark, "kept-crash")
    line = kept_depth_timeline(spark, path)
    line.extend(0, spark.createDataFrame([("a", 1, 5)], OPS))
    # a writer that stopped before the switch: part and carry are written, the entry is not
    spark.createDataFrame([("a", 2, 9, 99)], OPS + ", depth bigint").write.parquet(f"{path}/part=1")
    spark.createDataFrame([("a", 2, 99)], "queue string, op_seq bigint, depth bigint").write.parquet(f"{path}/carry-1")
    assert [r.depth for r in line.read().collect()] == [5]
    assert line.extend(1, spark.createDataFrame([("a", 2, 1)], OPS))
    assert sorted(r.depth for r in line.read().collect()) == [5, 6]


def test_only_the_new_rows_are_read(spark):
    path = scratch_path(spark, "kept-reads")
    line = kept_depth_timeline(spark, path)
    line.extend(0, spark.createDataFrame(ops(200), OPS))
    seen = []
    line.scan, scan = (lambda rows: seen.append(rows.count()) or scan(rows)), line.scan
    line.extend(1, spark.createDataFrame([("hot", 200, 1), ("hot", 201, -1)], OPS))
    assert seen == [2 + line.read().where(F.col("op_seq") < 200).select("queue").distinct().count()]
