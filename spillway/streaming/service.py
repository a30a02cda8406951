"""Long-running relay and lag jobs (the service form of R26 and R28).

``start_relay`` reads the subscribed topics and writes every topic group into
the queue table, waiting on the gate. ``start_lag`` keeps the lag table
current from two streams: the newest positions in the topics (role ``all``)
and the relay's own output (role ``formal``: what really reached the
queues). Both return running ``StreamingQuery`` objects; tests drive the same
functions with file streams and ``availableNow``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..options import RelayOptions
from ..sinks.lag_sink import LagTable
from ..sinks.pop_log import depth_probe
from ..sinks.queue_sink import QUEUE_SCHEMA, claim_writers
from .lag import start_updates
from .relay import DepthProbe, _stable_id, batch_writer, observe_relay, topic_groups
from .source import positions_stream, stream_partitions, topic_stream


def _trigger(seconds: float | None) -> dict:
    return {"availableNow": True} if seconds is None else {"processingTime": f"{seconds} seconds"}


def start_relay(spark: SparkSession, options: RelayOptions, queue_path: str,
                checkpoint_root: str, probe: DepthProbe | None = None,
                topics_per_query: int = 1, source=None, gated: bool = True,
                pop_log: str | None = None, once: bool | None = None) -> list[StreamingQuery]:
    """One query per topic group from the topic source (``source(topics)``
    defaults to the Kafka source), triggered every ``controller_time_s``;
    ``once`` (the default with a ``source``) drains what is there and ends. With
    a topic log such a run takes one trigger's records; ``once=False`` goes on.

    Every batch waits until its queues hold at most ``cache_size`` items. The
    default probe counts what is pushed to the queue table and not yet popped
    (``pop_log``, by default beside the table); ``gated=False`` drains a
    bounded source without consumers."""
    make = source or (lambda topics: topic_stream(spark, options, topics))
    if gated and probe is None:
        probe = depth_probe(spark, queue_path, pop_log or f"{queue_path}-pops")
    once = source is not None if once is None else once
    queries = []
    groups = topic_groups(tuple(options.topics), topics_per_query)
    claim_writers(spark, queue_path, {t: f"{checkpoint_root}/{_stable_id('+'.join(g))}" for g in groups for t in g})
    with stream_partitions(spark):
        for group in groups:
            name = "+".join(group)
            q = (observe_relay(make(group), name).writeStream
                 .foreachBatch(batch_writer(queue_path, options, group, probe if gated else None,
                                           counters=f"{checkpoint_root}/counters"))
                 .option("checkpointLocation", f"{checkpoint_root}/{_stable_id(name)}")
                 .trigger(**_trigger(None if once else options.controller_time_s))
                 .queryName(f"relay_{_stable_id(checkpoint_root + name)}")
                 .start())
            queries.append(q)
    return queries


def consumed_stream(spark: SparkSession, queue_path: str) -> DataFrame:
    """The relay's queue table as a stream of consumed offsets (role ``formal``).

    Arrival order is the batch and the position in it, not the offset: after a
    rewind the offset that was written last counts, although it is smaller."""
    rows = spark.readStream.schema(QUEUE_SCHEMA).parquet(queue_path)
    arrival = F.shiftleft(F.col("batch_id"), 32) + F.col("pos")  # positions of a batch stay far below 2^32
    return rows.select("topic", "partition", "offset", arrival.alias("seq"))


def start_lag(spark: SparkSession, options: RelayOptions, all_positions: DataFrame | None,
              consumed: DataFrame, table: LagTable, state_path: str | None, checkpoint: str,
              drain: bool = False) -> StreamingQuery:
    """The newest position per (role, topic, partition) over both roles; every trigger
    (``topic_len_to_cache_time_s``) publishes the lag of the touched topics into ``table``.
    The state is in ``checkpoint``; ``state_path`` is not used any more."""
    every = all_positions if all_positions is not None else positions_stream(spark, options)
    roles = (every.select(F.lit("all").alias("role"), "topic", "partition", "offset", "seq")
             .unionByName(consumed.select(F.lit("formal").alias("role"), "topic", "partition",
                                          "offset", "seq")))
    return start_updates(roles, table, checkpoint, _trigger(None if drain else options.topic_len_to_cache_time_s))
