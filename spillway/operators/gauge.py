"""Pressure gauge: a bounded up/down counter per topic driven by queue depth.

Each depth sample moves the gauge: up by ``step`` when ``len >= threshold``,
down by ``step`` otherwise, capped at ``ceiling`` and floored at 0; a sample
of length 0 resets it to 0. Each move is a clamp step, so the running gauge is
a clamp scan (see ``operators.scan``) and splits across chunks of a hot topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scan import clamp_scan


def gauge_samples(events: DataFrame) -> DataFrame:
    """Depth samples for the gauge from events: ``len = floor(value * 20)``
    per event, in event order."""
    return events.select(F.col("event_type").alias("topic"), F.col("event_id").alias("seq"),
                         F.floor(F.col("value") * 20).cast("bigint").alias("len"))


def pressure_timeline(samples: DataFrame, step: int = 1000, threshold: int = 700,
                      ceiling: int = 1_000_000, chunked: bool | None = None,
                      start: Column | None = None) -> DataFrame:
    """Gauge after every sample; where ``start`` is not NULL the row is no sample and sets the gauge to it."""
    reset = F.col("len") == 0
    d = F.when(reset, F.lit(0)).when(F.col("len") >= threshold, F.lit(step)).otherwise(F.lit(-step))
    hi = F.when(reset, F.lit(0)).otherwise(F.lit(ceiling))
    lo = F.lit(0)
    if start is not None:
        d, lo, hi = F.when(start.isNotNull(), F.lit(0)).otherwise(d), F.coalesce(start, lo), F.coalesce(start, hi)
    return clamp_scan(samples, ["topic"], ["seq"], d, lo, hi, "gauge", chunked=chunked)


def pressure_gauge(samples: DataFrame, step: int = 1000, threshold: int = 700,
                   ceiling: int = 1_000_000, chunked: bool | None = None) -> DataFrame:
    """Final gauge value per topic."""
    line = pressure_timeline(samples, step, threshold, ceiling, chunked)
    return line.groupBy("topic").agg(F.max_by("gauge", "seq").alias("gauge"))
