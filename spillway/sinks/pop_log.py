"""Durable pops of all queues of a queue table, on claims, and the depth left behind them.

A pop is a claim of the next items of every queue (see ``claims``), named by a number that only grows: repeating
the same number returns the same items and takes nothing more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .claims import claim_all, has_totals, kept_depth, marks
from .entries import newest_of_each
from .queue_sink import path_exists, read_queue


def pop(spark: SparkSession, queue_path: str, log: str, n: int, pop_id: int) -> DataFrame:
    """R20 with memory: the next ``n`` items of every queue, never given to another ``pop_id``."""
    newest = max((int(c) for e in newest_of_each(spark, log) for c in e["claims"]), default=pop_id)
    if pop_id < newest:
        raise ValueError(f"pop {pop_id} is older than the last pop {newest}")
    return claim_all(spark, queue_path, log, n, str(pop_id))


def depths(spark: SparkSession, queue_path: str, log: str) -> DataFrame:
    """(queue, depth): pushed minus popped for every queue that the table knows."""
    pushed = read_queue(spark, queue_path).groupBy("queue").agg(F.count(F.lit(1)).alias("pushed"))
    return (pushed.join(marks(spark, log), "queue", "left")
            .select("queue", (F.col("pushed") - F.coalesce("taken", F.lit(0))).cast("bigint").alias("depth")))


def depth_probe(spark: SparkSession, queue_path: str, log: str) -> Callable[[str], int]:
    """Gate probe: items of one queue that are not popped yet (0 before the first write).

    Read from the kept totals; only a table that the relay did not write, which has none, is counted."""

    def probe(queue: str) -> int:
        if has_totals(spark, queue_path):
            return kept_depth(spark, queue_path, log, queue)
        if not path_exists(spark, queue_path):
            return 0
        row = depths(spark, queue_path, log).where(F.col("queue") == queue).first()
        return 0 if row is None else int(row["depth"])

    return probe
