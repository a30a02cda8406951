"""Ordered per-group scans that stay balanced when one group is huge.

Every running value in this library is a prefix composition of steps
``x -> min(hi, max(lo, x + d))``: a dense position (d=1, no bounds), a running
sum (d=v), a queue depth that never goes below zero (lo=0), a bounded gauge
(lo=0, hi=ceiling; a reset is lo=hi=0). Steps compose inside the family:

    (d1, lo1, hi1) then (d2, lo2, hi2)
        = (d1 + d2, clip(lo1 + d2, lo2, hi2), clip(hi1 + d2, lo2, hi2))

so a scan can be cut into chunks, each chunk folded on its own, and the chunk
totals combined afterwards. Two plans, picked from a cheap size check (the
largest group's row count, one aggregate job):

* groups no larger than ``spillway.scan.maxGroupRows``: one shuffle on the
  group keys and a window function (JVM) or a fold over sorted Arrow batches;
* otherwise: the (group, order) space is cut at split points, taken once from
  a sample of the keys and kept as a one-row table, so a row's chunk is a
  function of its own keys: the same in every job and every retry, with no
  copy of the rows. The same window then runs per (group, chunk) -- one
  shuffle, balanced even when one group holds a third of all rows -- and a
  pass over keys and steps alone gives the chunk totals (at most chunks +
  groups rows), joined back as a size-checked lookup.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import (CONF_GROUP_ROWS, CONF_SCAN_CHUNKS, DEFAULT_GROUP_ROWS,
                       conf_int, pin)
from ..plans.joins import lookup_join

BIG = 2 ** 62  # stands for +/- infinity in step bounds


# ---------------------------------------------------------------- numpy core

def compose_prefix(seg: np.ndarray, d: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """Inclusive prefix composition of steps within runs of equal ``seg``.

    Hillis-Steele doubling: log2(n) vectorised passes, no per-row Python.
    """
    d, lo, hi = d.astype(np.int64).copy(), lo.astype(np.int64).copy(), hi.astype(np.int64).copy()
    n = len(d)
    k = 1
    while k < n:
        same = np.flatnonzero(seg[k:] == seg[:-k]) + k
        if same.size == 0:
            break
        prev = same - k
        pd_, plo, phi = d[prev], lo[prev], hi[prev]
        cd, clo, chi = d[same], lo[same], hi[same]
        d[same] = pd_ + cd
        lo[same] = np.minimum(np.maximum(plo + cd, clo), chi)
        hi[same] = np.minimum(np.maximum(phi + cd, clo), chi)
        k *= 2
    return d, lo, hi


def _then(a, b):
    """Compose step tuples elementwise: a first, then b."""
    d1, lo1, hi1 = a
    d2, lo2, hi2 = b
    return (d1 + d2,
            np.minimum(np.maximum(lo1 + d2, lo2), hi2),
            np.minimum(np.maximum(hi1 + d2, lo2), hi2))


def apply_step(x: Column, d: Column, lo: Column, hi: Column) -> Column:
    return F.least(F.greatest(x + d, lo), hi)


# ---------------------------------------------------------------- size check

def group_sizes(df: DataFrame, group_cols: list[str]) -> tuple[int, int]:
    """Rows of the biggest group and of all groups (partial aggregation, two numbers back)."""
    row = df.groupBy(*group_cols).count().agg(F.max("count").alias("m"), F.sum("count").alias("s")).first()
    return int(row["m"] or 0), int(row["s"] or 0)


def _rows_to_cut(df: DataFrame, group_cols: list[str], force: bool | None) -> int | None:
    """Row count of ``df`` where it needs chunks, else None."""
    if force is False:
        return None
    largest, rows = group_sizes(df, group_cols)
    limit = conf_int(df.sparkSession, CONF_GROUP_ROWS, DEFAULT_GROUP_ROWS)
    return rows if force or largest > limit else None


# ---------------------------------------------------------------- chunks

SAMPLES_PER_CHUNK = 20
MAX_CHUNKS = 20_000  # bounds the key sample of one task; beyond it chunks grow, and their sort spills


def _chunk_count(spark: SparkSession, rows: int) -> int:
    limit = conf_int(spark, CONF_GROUP_ROWS, DEFAULT_GROUP_ROWS) or DEFAULT_GROUP_ROWS
    default = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return min(max(conf_int(spark, CONF_SCAN_CHUNKS, default), -(-rows // limit)), MAX_CHUNKS)


def with_chunks(df: DataFrame, group_cols: list[str], order_cols: list[str], rows: int) -> DataFrame:
    """``df`` with ``_chunk``: how many split points are at or before the row's (group, order) key."""
    spark = df.sparkSession
    key = F.struct(*[F.col(c) for c in [*group_cols, *order_cols]])
    n = _chunk_count(spark, rows)
    fraction = n * SAMPLES_PER_CHUNK / max(1, rows)
    keys = df.select(key.alias("k"))
    keys = keys.sample(fraction, seed=17) if fraction < 1 else keys
    ordered = keys.agg(F.sort_array(F.collect_list("k")).alias("ks"))
    points = ordered.select(F.expr(f"""array_distinct(CASE WHEN size(ks) = 0 THEN ks ELSE transform(
        sequence(1, {max(1, n - 1)}), i -> ks[cast(floor(cast(i AS bigint) * size(ks) / {max(2, n)}) AS int)]) END)""").alias("p"))
    held = df.withColumn("_points", pin(points, "split-points").scalar()).withColumn("_key", key).withColumn("_chunk", F.lit(0))
    for bit in reversed(range(n.bit_length())):  # a binary search, one generated projection a step
        further = F.get(F.col("_points"), F.col("_chunk") + (1 << bit) - 1) <= F.col("_key")
        held = held.withColumn("_chunk", F.when(further, F.col("_chunk") + (1 << bit)).otherwise(F.col("_chunk")))
    return held.drop("_points", "_key")


def _earlier(group_cols: list[str]):
    """A group's earlier chunks (at most one row a chunk)."""
    return Window.partitionBy(*group_cols).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)


def _apply(keyed: DataFrame, totals: DataFrame, group_cols: list[str]) -> DataFrame:
    return lookup_join(keyed, totals, ["_chunk", *group_cols], "inner", label="chunk-totals", null_safe=True)


# ---------------------------------------------------------------- public API

def row_index(df: DataFrame, group_cols: list[str], order_cols: list[str],
              out: str = "offset", chunked: bool | None = None) -> DataFrame:
    """0-based dense position of each row inside its group, in ``order_cols`` order.

    ``order_cols`` must end with a unique column so the order is total.
    """
    rows = _rows_to_cut(df, group_cols, chunked)
    if rows is None:
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        return df.withColumn(out, (F.row_number().over(w) - 1).cast("bigint"))
    keyed = with_chunks(df, group_cols, order_cols, rows)
    counts = keyed.groupBy(*group_cols, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    bases = counts.select("_chunk", *group_cols, F.coalesce(F.sum("_n").over(_earlier(group_cols)), F.lit(0)).alias("_base"))
    w = Window.partitionBy(*group_cols, "_chunk").orderBy(*order_cols)
    placed = _apply(keyed.withColumn("_i", F.row_number().over(w) - 1), bases, group_cols)
    return placed.select(*df.columns, (F.col("_base") + F.col("_i")).cast("bigint").alias(out))


def running_sum(df: DataFrame, group_cols: list[str], order_cols: list[str],
                value: Column, out: str, chunked: bool | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` per group (NULL adds nothing; NULL before the first value)."""
    rows = _rows_to_cut(df, group_cols, chunked)
    if rows is None:
        w = (Window.partitionBy(*group_cols).orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return df.withColumn(out, F.sum(value.cast("bigint")).over(w).cast("bigint"))
    keyed = with_chunks(df.withColumn("_d", value.cast("bigint")), group_cols, order_cols, rows)
    totals = keyed.groupBy(*group_cols, "_chunk").agg(F.sum("_d").alias("_t"))
    bases = totals.select("_chunk", *group_cols, F.sum("_t").over(_earlier(group_cols)).alias("_base"))
    w = (Window.partitionBy(*group_cols, "_chunk").orderBy(*order_cols)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = _apply(keyed.withColumn("_s", F.sum("_d").over(w)), bases, group_cols)
    total = F.when(F.col("_base").isNull(), F.col("_s")).otherwise(F.col("_base") + F.coalesce("_s", F.lit(0)))
    return summed.select(*df.columns, total.cast("bigint").alias(out))


def clamp_scan(df: DataFrame, group_cols: list[str], order_cols: list[str],
               d: Column, lo: Column, hi: Column, out: str, init: int = 0,
               chunked: bool | None = None) -> DataFrame:
    """Running value ``x_i = min(hi_i, max(lo_i, x_{i-1} + d_i))``, ``x_0 = init``."""
    rows = _rows_to_cut(df, group_cols, chunked)
    if rows is None:
        return _grouped_scan(df, group_cols, order_cols, d, lo, hi, init, out)
    return _chunked_scan(df, group_cols, order_cols, d, lo, hi, init, out, rows)


def floored_sum(df: DataFrame, group_cols: list[str], order_cols: list[str], d: Column,
                out: str, chunked: bool | None = None) -> DataFrame:
    """Running ``x_i = max(0, x_{i-1} + d_i)`` from 0 (a depth that cannot go
    below zero; a NULL step is 0). In closed form, all in the JVM:
    ``x = S - min(0, min(S so far))`` with ``S`` the running sum."""
    steps = df.withColumn("_d", F.coalesce(d.cast("bigint"), F.lit(0).cast("bigint")))
    rows = _rows_to_cut(df, group_cols, chunked)
    chunks = rows is not None
    keyed = with_chunks(steps, group_cols, order_cols, rows) if chunks else steps
    w = (Window.partitionBy(*group_cols, *(["_chunk"] if chunks else [])).orderBy(*order_cols)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = keyed.withColumn("_s", F.sum("_d").over(w)).withColumn("_m", F.min("_s").over(w))
    if not chunks:
        return running.select(*df.columns, (F.col("_s") - F.least(F.lit(0), F.col("_m"))).cast("bigint").alias(out))
    # keys and steps only: a chunk's sum and its lowest running sum
    totals = (keyed.withColumn("_s", F.sum("_d").over(w)).groupBy(*group_cols, "_chunk")
              .agg(F.sum("_d").alias("_t"), F.min("_s").alias("_low")))
    earlier = _earlier(group_cols)
    bases = totals.withColumn("_base", F.coalesce(F.sum("_t").over(earlier), F.lit(0)))
    bases = bases.withColumn("_floor", F.least(F.lit(0), F.min(F.col("_base") + F.col("_low")).over(earlier)))
    applied = _apply(running, bases.select("_chunk", *group_cols, "_base", "_floor"), group_cols)
    depth = F.col("_base") + F.col("_s") - F.least(F.col("_floor"), F.col("_base") + F.col("_m"))
    return applied.select(*df.columns, depth.cast("bigint").alias(out))


def previous_value(df: DataFrame, group_cols: list[str], order_cols: list[str], col: str,
                   default, out: str, chunked: bool | None = None) -> DataFrame:
    """``col`` of the previous row of the same group (``default`` for a
    group's first row). Per-group plan: ``lag``. Large groups: ``lag`` inside
    each chunk; a chunk's first row takes the last value of the chunk before it."""
    rows = _rows_to_cut(df, group_cols, chunked)
    if rows is None:
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        return df.withColumn(out, F.lag(col, 1, default).over(w))
    keyed = with_chunks(df, group_cols, order_cols, rows)
    last = F.max_by(F.struct(F.col(col).alias("v")), F.struct(*order_cols)).alias("_last")
    lasts = keyed.groupBy(*group_cols, "_chunk").agg(last)
    before = lasts.select("_chunk", *group_cols, F.lag("_last").over(Window.partitionBy(*group_cols).orderBy("_chunk")).alias("_before"))
    w = Window.partitionBy(*group_cols, "_chunk").orderBy(*order_cols)
    near = _apply(keyed.withColumn("_near", F.lag(F.struct(F.col(col).alias("v"))).over(w)), before, group_cols)
    value = (F.when(F.col("_near").isNotNull(), F.col("_near.v"))
             .when(F.col("_before").isNotNull(), F.col("_before.v")).otherwise(F.lit(default)))
    return near.select(*df.columns, value.alias(out))


# ---------------------------------------------------------------- small groups

def _with_steps(df, d, lo, hi):
    return (df.withColumn("_d", F.coalesce(d.cast("bigint"), F.lit(0))).withColumn("_lo", lo.cast("bigint"))
            .withColumn("_hi", hi.cast("bigint")))


def _grouped_scan(df, group_cols, order_cols, d, lo, hi, init, out):
    """One task per group (groups are size-checked); Spark sorts it, Python holds one Arrow batch of it."""
    folded = _fold(_with_steps(df, d, lo, hi), group_cols, order_cols)
    value = apply_step(F.lit(init).cast("bigint"), F.col("_pd"), F.col("_plo"), F.col("_phi"))
    return folded.select(*df.columns, value.cast("bigint").alias(out))


# ---------------------------------------------------------------- large groups

def _chunked_scan(df, group_cols, order_cols, d, lo, hi, init, out, rows):
    """General clamp steps per (group, chunk), in Arrow batches: a task holds one batch and the open chunk's step."""
    names = df.columns
    keyed = with_chunks(_with_steps(df, d, lo, hi), group_cols, order_cols, rows)
    parts = ["_chunk", *group_cols]
    totals = (_fold(keyed.select("_chunk", "_d", "_lo", "_hi", *dict.fromkeys([*group_cols, *order_cols])), parts, order_cols)
              .groupBy("_chunk", *group_cols).agg(F.max_by(F.struct("_pd", "_plo", "_phi"), "_pos").alias("t"))
              .select("_chunk", *group_cols, "t._pd", "t._plo", "t._phi"))
    before_schema = T.StructType(
        [f for f in totals.schema.fields if f.name not in ("_pd", "_plo", "_phi")]
        + [T.StructField(c, T.LongType()) for c in ("_bd", "_blo", "_bhi")])

    def exclusive(pdf: pd.DataFrame) -> pd.DataFrame:
        # One group's chunk totals: at most one row a chunk.
        pdf = pdf.sort_values("_chunk")
        seg = np.zeros(len(pdf), dtype=np.int64)
        cd, clo, chi = compose_prefix(seg, pdf["_pd"].to_numpy(), pdf["_plo"].to_numpy(),
                                      pdf["_phi"].to_numpy())
        res = pdf.drop(columns=["_pd", "_plo", "_phi"])
        res["_bd"] = np.r_[0, cd[:-1]].astype(np.int64)
        res["_blo"] = np.r_[-BIG, clo[:-1]].astype(np.int64)
        res["_bhi"] = np.r_[BIG, chi[:-1]].astype(np.int64)
        return res

    before = totals.groupBy(*group_cols).applyInPandas(exclusive, before_schema)
    joined = _apply(_fold(keyed, parts, order_cols), before, group_cols)
    x0 = apply_step(F.lit(init).cast("bigint"), F.col("_bd"), F.col("_blo"), F.col("_bhi"))
    value = apply_step(x0, F.col("_pd"), F.col("_plo"), F.col("_phi"))
    return joined.select(*names, value.cast("bigint").alias(out))


def _fold(steps, part_cols, order_cols):
    """``steps`` with each row's step composed with the earlier ones of its part, in Arrow batches: the other columns pass
    through as they are."""
    placed = (steps.withColumn("_g", F.to_json(F.struct(*[F.col(c) for c in part_cols])))
              .repartition(*[F.col(c) for c in part_cols]).sortWithinPartitions(*part_cols, *order_cols))
    kept = [f for f in placed.schema.fields if f.name not in ("_d", "_lo", "_hi", "_g")]
    added = ["_pos", "_pd", "_plo", "_phi"]
    names = [*(f.name for f in kept), *added]
    schema = T.StructType(kept + [T.StructField(c, T.LongType()) for c in added])

    def local_fold(batches):
        carry_g, carry, pos = None, None, 0
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            column = dict(zip(batch.schema.names, batch.columns))
            g, d, lo, hi = (column[c].to_numpy(zero_copy_only=False) for c in ("_g", "_d", "_lo", "_hi"))
            seg = np.cumsum(np.r_[True, g[1:] != g[:-1]])
            pd_, plo, phi = compose_prefix(seg, d, lo, hi)
            if carry_g is not None and g[0] == carry_g:
                first = seg == seg[0]
                pd_[first], plo[first], phi[first] = _then(carry, (pd_[first], plo[first], phi[first]))
            carry_g, carry = g[-1], (pd_[-1], plo[-1], phi[-1])
            numbers = (np.arange(pos, pos + n, dtype=np.int64), pd_, plo, phi)
            yield pa.RecordBatch.from_arrays([*(column[f.name] for f in kept), *map(pa.array, numbers)], names)
            pos += n

    return placed.mapInArrow(local_fold, schema)
