"""Named queries over the shared test tables: ``(spark, sf_dir) -> DataFrame``.

Keys are the operator keys of the blueprint; every query reads whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.envelope import envelope, payload_text, queue_name
from ..functions.ledger_keys import (key_is_ledger, key_partition, key_role_is_all, key_topic,
                                     ledger_key, offset_text, parse_offset)
from ..operators import gate, gauge, ledger as led, queue as q, routing
from ..operators.scan import row_index
from ..options import RelayOptions
from ..sources.messages import MESSAGE_SCHEMA, document_payloads, ledger, load_messages
from ..sources.tables import table

# Fixed test parameters (kept identical in the oracle SQL).
OPTIONS = RelayOptions(
    topics=("click", "error", "purchase", "signup", "view", "refund"),
    prefix_redis="queues:",
    cache_size=2,  # against half-hourly depth samples: both gate states occur
    consumer_group="relay",
)
SUBSCRIBED = ("click", "purchase", "signup")
POP_N = 5
LAG_TICK_S = 10
GATE_TICK_S = 1800
NO_TOPIC_LANG = "es"  # documents in it arrive without a topic
BATCH_SEQ = 1000  # messages per relay batch (seq // BATCH_SEQ)
CLAIM_BATCH_SEQ = 20_000  # the same for the tables that workers claim from
EARLY_CUT = dt.datetime(2024, 1, 1, 2)  # position snapshot for offset text
OLD_LAG_CUT = dt.datetime(2024, 1, 20)  # lag table version 1
NEW_LAG_FROM = dt.datetime(2024, 1, 30, 23, 30)  # topics touched by version 2

Query = Callable[[SparkSession, str], DataFrame]


def _messages(spark, sf):
    return load_messages(spark, sf)


def _offsets(spark, sf):
    """Messages without payloads, for offset-only queries."""
    return load_messages(spark, sf, payload=False)


def _arrivals(spark, sf):
    """Messages without offsets and payloads, for queries that count or name."""
    return load_messages(spark, sf, payload=False, offsets=False)


# ------------------------------------------------------------- scans / sinks

def ledger_all(spark, sf):
    return ledger(_offsets(spark, sf)).where(F.col("role") == "all") \
        .select("role", "topic", "partition", "offset", "seq")


def queue_append(spark, sf):
    from ..session import scratch_path
    from ..sinks.queue_sink import read_queue, write_queue
    routed = q.route(_messages(spark, sf), OPTIONS.prefix_redis,
                     batch_id=F.floor(F.col("seq") / BATCH_SEQ))
    rows = q.with_positions(routed).select(*q.QUEUE_COLUMNS)
    path = scratch_path(spark, "queue-table")
    write_queue(rows, path)
    # A replayed batch rewrites only its own partitions: no duplicates.
    write_queue(rows.where(F.col("batch_id") == 3), path)
    return read_queue(spark, path)


def _queue_table(spark, sf):
    """A queue table of many batches, with its totals, as the relay leaves it: (path, claim log)."""
    from ..session import scratch_path
    from ..sinks.claims import record_table
    from ..sinks.queue_sink import read_queue, write_queue
    routed = q.route(_messages(spark, sf), OPTIONS.prefix_redis, batch_id=F.floor(F.col("seq") / CLAIM_BATCH_SEQ))
    path = scratch_path(spark, "claimed-queue")
    write_queue(q.with_positions(routed), path)
    record_table(spark, path, read_queue(spark, path))
    return path, f"{path}-claims"


def queue_claim(spark, sf):
    """Two workers claim items of every queue in turn; the first repeats its claim, which takes nothing more."""
    from ..sinks.claims import claim_all
    path, log = _queue_table(spark, sf)
    one, two, _ = (claim_all(spark, path, log, POP_N, worker) for worker in ("one", "two", "one"))
    return one.withColumn("worker", F.lit("one")).unionByName(two.withColumn("worker", F.lit("two")))


def queue_depth_kept(spark, sf):
    from ..sinks.claims import claim_all, kept_depths
    path, log = _queue_table(spark, sf)
    for worker in ("one", "two"):
        claim_all(spark, path, log, POP_N, worker)
    return kept_depths(spark, path, log)


def queue_compacted(spark, sf):
    """What is left in the queues, read through a compaction: merged batches without what was taken, then the newest batches."""
    from ..sinks.claims import claim_all, unclaimed
    from ..sinks.compaction import compact
    path, log = _queue_table(spark, sf)
    for k in range(2):
        claim_all(spark, path, log, POP_N, f"claim-{k}")
        compact(spark, path, log, keep_batches=3 - k)
    return unclaimed(spark, path, log)


def lag_table_upsert(spark, sf):
    from ..sinks.lag_sink import LagTable
    msgs = _offsets(spark, sf)
    lt = LagTable(spark)
    old = led.topic_lag(led.latest_offsets(ledger(msgs.where(F.col("timestamp") < OLD_LAG_CUT))))
    lt.upsert(old, version=1)
    touched = msgs.where(F.col("timestamp") >= NEW_LAG_FROM).select("topic").distinct()
    new = led.topic_lag(led.latest_offsets(ledger(msgs))).join(touched, "topic", "left_semi")
    lt.upsert(new, version=2)
    return lt.read()


def stream_source(spark, sf):
    from ..streaming.relay import drain_messages
    return drain_messages(spark, _messages(spark, sf))


def log_source(spark, sf):
    """Messages in two appends to a topic log, each drained by a stream that goes on from its checkpoint."""
    from ..session import scratch_path
    from ..sources.messages import FORMAL_CUT
    from ..streaming.topic_log import append_log, copy_log
    log, sink, checkpoint = (scratch_path(spark, f"log-{x}") for x in ("topics", "copy", "ckpt"))
    msgs = _messages(spark, sf)
    early = F.col("timestamp") < F.lit(FORMAL_CUT).cast("timestamp_ntz")
    for part in (msgs.where(early), msgs.where(~early)):
        append_log(part, log)
        copy_log(spark, log, sink, checkpoint, max_records=OPTIONS.max_records_per_trigger)
    return spark.read.schema(MESSAGE_SCHEMA).parquet(sink)


def log_rewind(spark, sf):
    """A topic log read to its end, moved back to the committed positions and read again: what each epoch read."""
    from ..session import scratch_path
    from ..streaming.source import OFFSET_BITS
    from ..streaming.topic_log import append_log, copy_log, rewind
    log, sink, checkpoint = (scratch_path(spark, f"rewind-{x}") for x in ("topics", "copy", "ckpt"))
    msgs = _messages(spark, sf)
    append_log(msgs, log)
    copy_log(spark, log, sink, checkpoint, payload=False)
    rewind(spark, log, led.committed_position(msgs, ledger(msgs)))
    copy_log(spark, log, sink, checkpoint, payload=False)
    read = spark.read.schema(MESSAGE_SCHEMA).parquet(sink)
    return (read.groupBy("topic", "partition", F.shiftright("seq", OFFSET_BITS).alias("epoch"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"),
                 F.max_by("offset", "seq").alias("latest_offset")))


def list_sink(spark, sf):
    """A topic log pushed to a list store in two runs of one stream; an item's place among those of its partition."""
    from ..session import scratch_path
    from ..sinks.list_sink import push_stream, read_lists
    from ..sources.messages import FORMAL_CUT
    from ..streaming.topic_log import append_log, drain, log_stream
    log, lists, checkpoint = (scratch_path(spark, f"list-{x}") for x in ("topics", "store", "ckpt"))
    msgs = _messages(spark, sf)
    early = F.col("timestamp") < F.lit(FORMAL_CUT).cast("timestamp_ntz")
    for part in (msgs.where(early), msgs.where(~early)):
        append_log(part, log)
        stream = q.route(log_stream(spark, log, max_records=10 * OPTIONS.max_records_per_trigger), OPTIONS.prefix_redis)
        drain(push_stream(stream, lists, checkpoint).start())
    items = read_lists(spark, lists)
    return row_index(items, ["queue", "partition"], ["pos"], "place").select("queue", "partition", "offset", "place", "payload")


# ------------------------------------------------------------- projections

def msg_projection(spark, sf):
    return _messages(spark, sf).select("topic", "partition", "offset",
                                       payload_text(F.col("value")).alias("data"))


def envelope_q(spark, sf):
    docs = document_payloads(table(spark, sf, "documents"))
    return docs.select("topic", "seq", envelope(payload_text(F.col("value"))).alias("payload"))


def queue_name_q(spark, sf):
    return _arrivals(spark, sf).select(
        "seq", "topic", queue_name(F.col("topic"), OPTIONS.prefix_redis).alias("queue"))


def ledger_key_q(spark, sf):
    latest = led.latest_offsets(ledger(_offsets(spark, sf)))
    return latest.select(ledger_key(F.col("role"), F.col("partition"), F.col("topic")).alias("key"),
                         "offset")


def ledger_key_decode(spark, sf):
    msgs = _offsets(spark, sf)
    keyed = led.latest_offsets(ledger(msgs)).select(
        ledger_key(F.col("role"), F.col("partition"), F.col("topic")).alias("key"), "offset")
    # Bare-topic entries share the map (gauge values) and must be skipped.
    bare = msgs.groupBy("topic").agg(F.count(F.lit(1)).alias("offset")) \
        .select(F.col("topic").alias("key"), "offset")
    k = F.col("key")
    return (keyed.unionByName(bare).where(key_is_ledger(k))
            .select("key", key_role_is_all(k).alias("is_all"), key_partition(k).alias("partition"),
                    key_topic(k).alias("topic"), "offset"))


def offset_parse(spark, sf):
    msgs = _offsets(spark, sf)
    snap = led.next_positions(ledger(msgs, formal_cut=F.lit(EARLY_CUT).cast("timestamp_ntz")))
    texts = (led.watermarks(msgs).join(snap, ["topic", "partition"], "left")
             .select("topic", "partition", offset_text(F.col("next_offset")).alias("offset_text")))
    return texts.withColumn("offset", parse_offset(F.col("offset_text")))


# ------------------------------------------------------------- filters, routing

def subscribe_filter(spark, sf):
    return routing.subscribe(load_messages(spark, sf, topics=SUBSCRIBED), SUBSCRIBED)


def _records(spark, sf):
    msgs = load_messages(spark, sf, offsets=False).select("topic", "seq", "value")
    # some documents arrive without a topic, so both halves of the split have rows
    docs = table(spark, sf, "documents")
    docs = docs.withColumn("source", F.when(F.col("lang") != NO_TOPIC_LANG, F.col("source")))
    return msgs.unionByName(document_payloads(docs).select("topic", "seq", "value"))


def valid_records_q(spark, sf):
    return routing.valid_records(_records(spark, sf))


def rejected_records_q(spark, sf):
    return routing.rejected_records(_records(spark, sf))


def _gate_state(msgs):
    return gate.gate_state(gate.depth_samples(msgs, GATE_TICK_S), OPTIONS.cache_size)


def admitted_q(spark, sf):
    msgs = _messages(spark, sf)
    return gate.admitted(msgs, _gate_state(_arrivals(spark, sf)))


def deferred_q(spark, sf):
    msgs = _messages(spark, sf)
    return gate.deferred(msgs, _gate_state(_arrivals(spark, sf)))


def relay_batch_q(spark, sf):
    return q.relay_batch(_messages(spark, sf), OPTIONS.prefix_redis)


# ------------------------------------------------------------- aggregations

def latest_offset(spark, sf):
    return led.latest_offsets(ledger(_offsets(spark, sf)))


def topic_lag(spark, sf):
    return led.topic_lag(led.latest_offsets(ledger(_offsets(spark, sf))))


def partition_lag(spark, sf):
    msgs = _offsets(spark, sf)
    return led.partition_lag(msgs, ledger(msgs))


def watermarks(spark, sf):
    return led.watermarks(_offsets(spark, sf))


def committed_position(spark, sf):
    msgs = _offsets(spark, sf)
    return led.committed_position(msgs, ledger(msgs))


def queue_depth(spark, sf):
    routed = _arrivals(spark, sf).select(queue_name(F.col("topic"), OPTIONS.prefix_redis).alias("queue"))
    return q.queue_depth(routed, [OPTIONS.queue_of(t) for t in OPTIONS.topics])


# ------------------------------------------------------------- queues, windows

def queue_pop(spark, sf):
    return q.pop_messages(_messages(spark, sf), OPTIONS.prefix_redis, POP_N)


def queue_remaining(spark, sf):
    return q.queue_remaining(relay_batch_q(spark, sf), POP_N)


def queue_position(spark, sf):
    conv = table(spark, sf, "conversations").select(
        queue_name(F.col("role"), OPTIONS.prefix_redis).alias("queue"), "conv_id", "turn",
        envelope(payload_text(F.col("text"))).alias("payload"))
    return row_index(conv, ["queue"], ["conv_id", "turn"], "pos")


def queue_depth_timeline(spark, sf):
    return q.depth_timeline(q.queue_ops(_arrivals(spark, sf), prefix=OPTIONS.prefix_redis))


def _in_two_parts(line, rows, order):
    """``line`` extended by the first 99 % of the order keys' range, then by the rest."""
    cut = F.lit((rows.agg(F.max(order)).first()[0] or 0) * 99 // 100)
    line.extend(0, rows.where(F.col(order) <= cut))
    line.extend(1, rows.where(F.col(order) > cut))
    return line.read()


def depth_timeline_kept(spark, sf):
    from ..session import scratch_path
    from ..sinks.timelines import kept_depth_timeline
    ops = q.queue_ops(_arrivals(spark, sf), prefix=OPTIONS.prefix_redis)
    return _in_two_parts(kept_depth_timeline(spark, scratch_path(spark, "kept-depth")), ops, "op_seq")


def pressure_timeline_kept(spark, sf):
    from ..session import scratch_path
    from ..sinks.timelines import kept_pressure_timeline
    samples = gauge.gauge_samples(table(spark, sf, "events"))
    return _in_two_parts(kept_pressure_timeline(spark, scratch_path(spark, "kept-gauge")), samples, "seq")


def gate_state_q(spark, sf):
    return _gate_state(_arrivals(spark, sf))


def gate_transitions_q(spark, sf):
    return gate.gate_transitions(_gate_state(_arrivals(spark, sf)))


def lag_timeline(spark, sf):
    return led.lag_timeline(ledger(_offsets(spark, sf)), LAG_TICK_S)


def lag_timeline_dense(spark, sf):
    return led.dense_lag_timeline(lag_timeline(spark, sf), LAG_TICK_S)


# ------------------------------------------------------------- streaming, state

def relay_stream(spark, sf):
    from ..streaming.relay import relay_stream as run
    return run(spark, _messages(spark, sf), OPTIONS)


def relay_runs(spark, sf):
    from ..streaming.relay import relay_runs as run
    return run(spark, _messages(spark, sf), OPTIONS)


def lag_stream(spark, sf):
    from ..streaming.lag import lag_stream as run
    return run(spark, _offsets(spark, sf))


def lag_service(spark, sf):
    """Relay the consumed messages (before the formal cut) into a queue table,
    then keep lag from topic positions (all) and that table (formal)."""
    from ..session import scratch_path
    from ..sinks.lag_sink import LagTable
    from ..sources.messages import FORMAL_CUT
    from ..streaming.relay import group_stream, staged_topics
    from ..streaming.service import consumed_stream, start_lag, start_relay
    from ..streaming.source import file_stream, stage_files
    msgs = _messages(spark, sf)
    consumed = msgs.where(F.col("timestamp") < F.lit(FORMAL_CUT).cast("timestamp_ntz"))
    staged = stage_files(consumed, files=4, by_topic=True)
    opts = RelayOptions(topics=staged_topics(spark, staged), prefix_redis=OPTIONS.prefix_redis)
    queue_path = scratch_path(spark, "service-queue")
    for query in start_relay(spark, opts, queue_path, scratch_path(spark, "service-relay"),
                             gated=False,  # a bounded source, and nothing pops here
                             source=lambda group: group_stream(spark, staged, group, 1)):
        query.awaitTermination()
    positions = file_stream(spark, stage_files(_offsets(spark, sf), files=4)).select(
        "topic", "partition", "offset", "seq")
    table = LagTable(spark)
    start_lag(spark, opts, positions, consumed_stream(spark, queue_path), table,
              scratch_path(spark, "service-state"), scratch_path(spark, "service-lag"),
              drain=True).awaitTermination()
    return table.read().select("topic", "lag")


def pressure_gauge_q(spark, sf):
    return gauge.pressure_gauge(gauge.gauge_samples(table(spark, sf, "events")))


def pressure_timeline_q(spark, sf):
    return gauge.pressure_timeline(gauge.gauge_samples(table(spark, sf, "events")))


def pressure_stream_q(spark, sf):
    from ..streaming.gauge import pressure_stream
    return pressure_stream(spark, table(spark, sf, "events"))


def replay_q(spark, sf):
    msgs = _messages(spark, sf)
    return led.replay(msgs, led.next_positions(ledger(msgs)))


def relay_counts_q(spark, sf):
    msgs = _offsets(spark, sf)
    return routing.relay_counts(gate.with_gate(msgs, _gate_state(_arrivals(spark, sf))))


QUERIES: dict[str, Query] = {
    # sources and sinks
    "stream_source": stream_source,
    "log_source": log_source,
    "log_rewind": log_rewind,
    "ledger_all": ledger_all,
    "queue_append": queue_append,
    "list_sink": list_sink,
    "queue_claim": queue_claim,
    "queue_depth_kept": queue_depth_kept,
    "queue_compacted": queue_compacted,
    "lag_table_upsert": lag_table_upsert,
    # projections and scalar functions
    "msg_projection": msg_projection,
    "envelope": envelope_q,
    "queue_name": queue_name_q,
    "ledger_key": ledger_key_q,
    "ledger_key_decode": ledger_key_decode,
    "offset_parse": offset_parse,
    # filters and routing
    "subscribe_filter": subscribe_filter,
    "valid_records": valid_records_q,
    "rejected_records": rejected_records_q,
    "admitted": admitted_q,
    "deferred": deferred_q,
    "relay_batch": relay_batch_q,
    # aggregations
    "latest_offset": latest_offset,
    "topic_lag": topic_lag,
    "partition_lag": partition_lag,
    "watermarks": watermarks,
    "committed_position": committed_position,
    "queue_depth": queue_depth,
    # queues, order, windows
    "queue_pop": queue_pop,
    "queue_remaining": queue_remaining,
    "queue_position": queue_position,
    "queue_depth_timeline": queue_depth_timeline,
    "depth_timeline_kept": depth_timeline_kept,
    "pressure_timeline_kept": pressure_timeline_kept,
    "gate_state": gate_state_q,
    "gate_transitions": gate_transitions_q,
    "lag_timeline": lag_timeline,
    "lag_timeline_dense": lag_timeline_dense,
    # streaming and state
    "relay_stream": relay_stream,
    "relay_runs": relay_runs,
    "lag_stream": lag_stream,
    "lag_service": lag_service,
    "pressure_gauge": pressure_gauge_q,
    "pressure_timeline": pressure_timeline_q,
    "pressure_stream": pressure_stream_q,
    "replay": replay_q,
    "relay_counts": relay_counts_q,
}

__all__ = ["QUERIES", "OPTIONS"]
