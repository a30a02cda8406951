"""Streaming pressure gauge (R29): one BIGINT of state per topic.

``applyInPandasWithState`` keeps the gauge of every topic between
micro-batches; each batch folds its samples for a topic (bounded by the
per-trigger limit) with the vectorised step composition of ``operators.scan``
and emits the gauge after every sample.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from ..operators.gauge import gauge_samples
from ..operators.scan import compose_prefix
from ..session import scratch_path
from .source import file_stream, stage_files, stream_partitions

SAMPLE_SCHEMA = T.StructType([T.StructField("topic", T.StringType()),
                              T.StructField("seq", T.LongType()),
                              T.StructField("len", T.LongType())])
OUT_SCHEMA = "topic string, seq bigint, len bigint, gauge bigint"


def gauge_steps(lens: np.ndarray, step: int, threshold: int, ceiling: int):
    reset = lens == 0
    d = np.where(reset, 0, np.where(lens >= threshold, step, -step)).astype(np.int64)
    lo = np.zeros(len(lens), dtype=np.int64)
    hi = np.where(reset, 0, ceiling).astype(np.int64)
    return d, lo, hi


def gauge_stream(samples: DataFrame, step: int = 1000, threshold: int = 700,
                 ceiling: int = 1_000_000) -> DataFrame:
    def fold(key, pdfs, state):
        x = state.get[0] if state.exists else 0
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values("seq", kind="mergesort")
        lens = pdf["len"].to_numpy()
        d, lo, hi = gauge_steps(lens, step, threshold, ceiling)
        pd_, plo, phi = compose_prefix(np.zeros(len(lens), dtype=np.int64), d, lo, hi)
        values = np.minimum(np.maximum(x + pd_, plo), phi)
        state.update((int(values[-1]),))
        yield pd.DataFrame({"topic": key[0], "seq": pdf["seq"].to_numpy(),
                            "len": lens, "gauge": values})

    return samples.groupBy("topic").applyInPandasWithState(
        fold, OUT_SCHEMA, "gauge long", "append", GroupStateTimeout.NoTimeout)


def pressure_stream(spark: SparkSession, events: DataFrame, files: int = 4) -> DataFrame:
    """R29 streamed and drained: the gauge timeline from staged samples."""
    staged = stage_files(gauge_samples(events), files=files)
    sink = scratch_path(spark, "gauge-out")
    with stream_partitions(spark):
        q = (gauge_stream(file_stream(spark, staged, schema=SAMPLE_SCHEMA)).writeStream
             .format("parquet").outputMode("append").option("path", sink)
             .option("checkpointLocation", scratch_path(spark, "gauge-ckpt"))
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink).select("topic", "seq", "len", "gauge")
