"""Streaming lag (R28): positions of both roles -> lag of each touched topic.

One stateful operator per query, keyed by topic. Its state, a map (role, partition) -> (offset, seq), holds one entry
for each partition and role, however many messages arrive, and lives in Spark's checkpointed state store alone. Every
micro-batch brings the newest position of each of its keys into the map and emits the lag of the topics it touched;
these rows are all that is written, into the latest-wins lag table (R04).

Positions are reduced to the newest of each key in every Arrow batch before they are shuffled, so a hot topic sends
its task a few rows for each batch read and not its messages.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.ledger import KEY
from ..session import scratch_path
from ..sinks.lag_sink import LagTable
from ..sources.messages import FORMAL_CUT, ledger
from .source import file_stream, stage_files, stream_partitions

POSITIONS = "role string, topic string, partition int, offset bigint, seq bigint"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def _newest(rows: pd.DataFrame) -> pd.DataFrame:
    """Of each key the row with the highest seq (rows without a topic, offset or seq have no position)."""
    rows = rows.dropna(subset=["role", "topic", "partition", "offset", "seq"])
    return rows.sort_values(["seq", "offset"], kind="stable").drop_duplicates(KEY, keep="last")


def reduce_positions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield _newest(batch)


class TopicLag(StatefulProcessor):
    """Last write wins by ``seq`` for each (role, partition); the lag is clamped after the sum over partitions."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "role string, partition int", "offset bigint, seq bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 - Spark's names
        known = {tuple(k): tuple(v) for k, v in self.last.iterator()}
        newest = _newest(pd.concat(list(rows)))
        for role, partition, offset, seq in zip(newest["role"], newest["partition"], newest["offset"], newest["seq"]):
            place, value = (role, int(partition)), (int(offset), int(seq))
            if place not in known or known[place][1] <= value[1]:
                known[place] = value
                self.last.updateValue(place, value)
        lag = sum(offset if role == "all" else -offset for (role, _), (offset, _) in known.items())
        yield pd.DataFrame({"topic": [key[0]], "lag": [max(0, lag)]})

    def close(self) -> None:
        pass


def lag_updates(positions: DataFrame) -> DataFrame:
    """(topic, lag) of the topics that each micro-batch of ``positions`` (POSITIONS) touches."""
    few = positions.select(*[c.split()[0] for c in POSITIONS.split(", ")]).mapInPandas(reduce_positions, POSITIONS)
    return few.groupBy("topic").transformWithStateInPandas(
        statefulProcessor=TopicLag(), outputStructType="topic string, lag bigint", outputMode="Update", timeMode="None")


@contextmanager
def map_state(spark: SparkSession):
    """Start streaming queries with the RocksDB state store, which map state needs; the session's own setting comes back."""
    old = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, old)


def start_updates(positions: DataFrame, table: LagTable, checkpoint: str, trigger: dict):
    """Keeps ``table`` current from a stream of positions; a replayed batch writes the same rows again."""
    spark = positions.sparkSession
    with stream_partitions(spark), map_state(spark):
        return (lag_updates(positions).writeStream.outputMode("update")
                .foreachBatch(lambda batch, batch_id: table.upsert(batch, version=batch_id))
                .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def lag_stream(spark: SparkSession, messages: DataFrame, files: int = 4,
               formal_cut=FORMAL_CUT) -> DataFrame:
    """R28 drained: returns the lag table after all staged messages."""
    staged = stage_files(messages, files=files)
    table = LagTable(spark)
    positions = ledger(file_stream(spark, staged)).select(*KEY, F.col("offset"), F.col("seq"))
    start_updates(positions, table, scratch_path(spark, "lag-ckpt"), {"availableNow": True}).awaitTermination()
    return table.read().select("topic", "lag")
