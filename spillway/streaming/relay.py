"""Gated relay stream (R26) with bounded sink retry.

One streaming query per topic, so a full queue holds back only its own topic.
Each micro-batch (bounded by the per-trigger limit) is wrapped and routed,
then the batch writer waits while the topic's gate is closed and writes the
batch into the queue table. Waiting -- never filtering -- is what keeps a held
batch whole: Spark logs the batch as done only after ``foreachBatch`` returns,
and a failed batch is replayed with the same id and rows, which the queue
sink's per-batch overwrite turns into an idempotent write. Positions are
batch-local: the queue table's FIFO key is ``(batch_id, pos)``.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.queue import route, with_positions
from ..operators.routing import rejected_records, valid_records
from ..options import RelayOptions
from ..session import CONF_GROUP_ROWS, DEFAULT_GROUP_ROWS, conf_int, scratch_path
from ..sinks.batch_runs import StagedBatch
from ..sinks.claims import record_pushes
from ..sinks.entries import Entries, folder_of, newest_of_each
from ..sinks.queue_sink import claim_writers, path_exists, read_queue, with_retry, write_queue
from .source import file_stream, stage_files, stream_partitions

DepthProbe = Callable[[str], "int | None"]


def wait_until_open(queue: str, probe: DepthProbe, cache_size: int, poll_s: float,
                    timeout_s: float | None = None) -> int:
    """Block while ``probe(queue) > cache_size`` (or the probe fails / returns
    None); returns the number of closed polls."""
    closed, start = 0, time.monotonic()
    while True:
        try:
            depth = probe(queue)
        except Exception:  # noqa: BLE001 - a failed read keeps the gate closed
            depth = None
        if depth is not None and depth <= cache_size:
            return closed
        closed += 1
        if timeout_s is not None and time.monotonic() - start > timeout_s:
            raise TimeoutError(f"gate for {queue} stayed closed for {timeout_s}s")
        time.sleep(poll_s)


def batch_writer(path: str, options: RelayOptions, topics: tuple[str, ...],
                 probe: DepthProbe | None = None,
                 fault: Callable[[int, int], None] | None = None,
                 retries: list | None = None, counters: str | None = None, runs: bool | None = None):
    """``foreachBatch`` function: gate wait for every queue of the group, then
    an idempotent queue write. Positions come from one window a topic, or, with ``runs`` (by default where a
    trigger may take more than ``spillway.scan.maxGroupRows`` records), from sorted runs over many tasks; both
    give the same table. Records without a topic are counted and go, with the
    reason, to the table ``<path>-rejected``. The kept totals of the queues and the writer's
    ``counters`` are replaced by a replay."""
    queues = [options.queue_of(t) for t in topics]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if probe is not None:
            for queue in queues:  # a group waits for its fullest queue
                wait_until_open(queue, probe, options.cache_size, options.controller_time_s)
        tries = {"n": 0, "row": None, "rows": batch}
        sorted_runs = options.max_records_per_trigger > conf_int(spark, CONF_GROUP_ROWS, DEFAULT_GROUP_ROWS) if runs is None else runs

        def attempt() -> None:
            tries["n"] += 1
            if fault is not None:
                fault(batch_id, tries["n"])
            if sorted_runs:
                staged = StagedBatch(batch, f"{path}-staging/{folder_of('+'.join(topics))}")
                tries["row"], tries["rows"] = staged.counts(topics), staged.rows
                write_queue(route(staged.positioned(), options.prefix_redis, batch_id=batch_id, keep=["pos"]), path, clustered=True)
                return
            seen = Observation()  # counted while the rows are written: the batch is read once
            own = [F.count_if(F.col("topic") == t).alias(f"n{i}") for i, t in enumerate(topics)]
            watched = batch.observe(seen, *_batch_counts(), *own)
            rows = with_positions(route(valid_records(watched), options.prefix_redis, batch_id=batch_id), chunked=False)
            write_queue(rows, path, clustered=True)  # one batch, clustered by queue
            try:
                tries["row"] = seen.get
            except Exception:  # noqa: BLE001 - with no row to write, adaptive execution drops the branch and its counters
                tries["row"] = batch.agg(*_batch_counts(), *own).first().asDict()

        used = with_retry(attempt, options.sink_max_attempts, options.sink_retry_delay_s)
        counted = tries["row"]
        if counted["rejected"]:
            write_rejected(tries["rows"], "+".join(topics), batch_id, rejected_of(path))
        record_pushes(spark, path, [(q, batch_id, counted[f"n{i}"]) for i, q in enumerate(queues)])
        if counters is not None:
            _put_counters(spark, counted, "+".join(topics), batch_id, counters)
        if retries is not None:
            retries.append((",".join(topics), batch_id, used))

    return write


def rejected_of(path: str) -> str:
    return f"{path}-rejected"


def write_rejected(batch: DataFrame, writer: str, batch_id: int, path: str) -> None:
    """R11 on a stream: the batch's rejected records with their reason, replaced when the batch is replayed."""
    rows = rejected_records(batch).select("topic", "partition", "offset", "timestamp", "value", "reason")
    (rows.withColumn("writer", F.lit(writer)).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("writer", "batch_id").parquet(path))


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The records that the relay into the queue table ``path`` has rejected."""
    folder = rejected_of(path)
    return spark.read.schema(REJECTED).parquet(folder) if path_exists(spark, folder) else spark.createDataFrame([], REJECTED)


def _stable_id(text: str) -> str:
    """Same id in every process (checkpoint folders must survive restarts)."""
    return hashlib.sha1(text.encode()).hexdigest()[:16]


def topic_groups(topics: tuple[str, ...], per_query: int = 1) -> list[tuple[str, ...]]:
    """Topics split into groups of ``per_query``; one streaming query each."""
    return [tuple(topics[i:i + per_query]) for i in range(0, len(topics), per_query)]


def group_stream(spark: SparkSession, staged: str, group: tuple[str, ...],
                 files_per_trigger: int) -> DataFrame:
    if len(group) == 1:
        return file_stream(spark, staged, files_per_trigger, topic=group[0])
    # The topic folders of a by-topic staging are partitions: the filter
    # prunes every other topic's files.
    return (file_stream(spark, staged, files_per_trigger)
            .where(F.col("topic").isin(list(group))))


def run_relay(spark: SparkSession, staged: str, topics: tuple[str, ...], options: RelayOptions,
              sink: str, checkpoint_root: str, probe: DepthProbe | None = None,
              fault: Callable[[int, int], None] | None = None, files_per_trigger: int = 1,
              retries: list | None = None, topics_per_query: int = 1, runs: bool | None = None
              ) -> dict[str, dict[str, int]]:
    """Start one query per topic group, drain everything available, wait for
    all; returns the counters of every group, over all its batches."""
    queries = []
    groups = topic_groups(topics, topics_per_query)
    counters = f"{checkpoint_root}/counters"
    claim_writers(spark, sink, {t: f"{checkpoint_root}/{_stable_id('+'.join(g))}" for g in groups for t in g})
    with stream_partitions(spark):
        for group in groups:
            name = "+".join(group)
            stream = observe_relay(group_stream(spark, staged, group, files_per_trigger), name)
            q = (stream.writeStream
                 .foreachBatch(batch_writer(sink, options, group, probe, fault, retries, counters, runs))
                 .option("checkpointLocation", f"{checkpoint_root}/{_stable_id(name)}")
                 .trigger(availableNow=True)
                 .queryName(f"relay_{_stable_id(checkpoint_root + name)}")
                 .start())
            queries.append(q)
    errors = []
    for q in queries:
        try:
            q.awaitTermination()
        except Exception as err:  # noqa: BLE001 - surface after all stopped
            errors.append(err)
    if errors:
        raise errors[0]
    return relay_metrics(spark, counters)


def observe_relay(stream: DataFrame, topic: str) -> DataFrame:
    """R31 on a stream: per-batch counters reported in the query progress."""
    return stream.observe(f"relay_{topic}", F.count(F.lit(1)).alias("seen"),
                          F.max("offset").alias("last_offset"))


REJECTED = ("topic string, partition int, offset bigint, timestamp timestamp_ntz, value string, reason string, "
            "writer string, batch_id bigint")


def _batch_counts() -> list:
    return [F.count(F.lit(1)).alias("seen"), F.count_if(F.col("topic").isNull()).alias("rejected"),
            F.max(F.when(F.col("topic").isNotNull(), F.col("offset"))).cast("bigint").alias("last_offset")]


def write_counters(batch: DataFrame, writer: str, batch_id: int, path: str) -> None:
    """R31 on a stream, kept: the totals of a writer after each batch; a replayed batch replaces its own."""
    _put_counters(batch.sparkSession, batch.agg(*_batch_counts()).first().asDict(), writer, batch_id, path)


def _put_counters(spark: SparkSession, counted: dict, writer: str, batch_id: int, path: str) -> None:
    entries = Entries(spark, f"{path}/{folder_of(writer)}")
    before = entries.newest(below=batch_id)[1]
    last = [x for x in (before.get("last_offset"), counted["last_offset"]) if x is not None]
    entries.put(batch_id, {"writer": writer, "seen": before.get("seen", 0) + counted["seen"],
                           "rejected": before.get("rejected", 0) + counted["rejected"],
                           "batches": before.get("batches", 0) + 1, "last_offset": max(last, default=None)}, replace=True)


def relay_metrics(spark: SparkSession, path: str) -> dict[str, dict[str, int]]:
    """Counters of every writer over all its batches."""
    return {e["writer"]: {"seen": e["seen"], "rejected": e["rejected"], "pushed": e["seen"] - e["rejected"],
                          "last_offset": -1 if e["last_offset"] is None else e["last_offset"], "batches": e["batches"]}
            for e in newest_of_each(spark, path)}


def staged_topics(spark: SparkSession, staged: str) -> tuple[str, ...]:
    """Topics present in a staged folder (from its partition directories)."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(staged)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path) if s.isDirectory()]
    return tuple(sorted(n.split("=", 1)[1] for n in names if n.startswith("topic=")))


def relay_stream(spark: SparkSession, messages: DataFrame, options: RelayOptions,
                 probe: DepthProbe | None = None, files: int = 4) -> DataFrame:
    """R26 drained: stage the messages, relay them through per-topic streams
    into a queue table and return that table (without batch-local order)."""
    staged = stage_files(messages, files=files, by_topic=True)
    sink = scratch_path(spark, "relay-queue")
    ckpt = scratch_path(spark, "relay-ckpt")
    run_relay(spark, staged, staged_topics(spark, staged), options, sink, ckpt, probe)
    return read_queue(spark, sink).select("queue", "payload", "topic", "partition", "offset")


def relay_runs(spark: SparkSession, messages: DataFrame, options: RelayOptions, files: int = 4) -> DataFrame:
    """R26 with all topics in one large batch, numbered by sorted runs: the queue table, with positions."""
    staged = stage_files(messages, files=files, by_topic=True)
    sink = scratch_path(spark, "runs-queue")
    topics = staged_topics(spark, staged)
    run_relay(spark, staged, topics, options, sink, scratch_path(spark, "runs-ckpt"), files_per_trigger=files * len(topics) * 1000,
              topics_per_query=len(topics), runs=True)
    return read_queue(spark, sink)


def drain_messages(spark: SparkSession, messages: DataFrame, files: int = 4) -> DataFrame:
    """R01 drained: messages through a bounded file stream into a Parquet sink."""
    staged = stage_files(messages, files=files)
    sink = scratch_path(spark, "stream-out")
    with stream_partitions(spark):
        q = (file_stream(spark, staged).writeStream.format("parquet")
             .option("path", sink).option("checkpointLocation", scratch_path(spark, "stream-ckpt"))
             .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(sink).select(
        "topic", "partition", "offset", "timestamp", "value", F.col("seq"))
