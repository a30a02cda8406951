"""Queue relay and lag analytics as Spark DataFrame and Structured Streaming jobs.

The operators are plain ``DataFrame -> DataFrame`` functions; the most used
ones are re-exported here.
"""

from .functions.envelope import envelope, payload_text, queue_name
from .functions.ledger_keys import ledger_key, parse_offset
from .operators.gate import admitted, deferred, gate_state, gate_transitions
from .operators.gauge import pressure_gauge, pressure_timeline
from .operators.ledger import (committed_position, dense_lag_timeline, lag_timeline,
                               latest_offsets, partition_lag, replay, topic_lag, watermarks)
from .operators.queue import (depth_timeline, queue_depth, queue_pop, queue_remaining,
                              relay_batch, route)
from .operators.scan import clamp_scan, row_index, running_sum
from .options import RelayOptions
from .sources.messages import ledger, messages_from_events

__all__ = [
    "RelayOptions", "admitted", "clamp_scan", "committed_position", "deferred",
    "dense_lag_timeline", "depth_timeline", "envelope", "gate_state", "gate_transitions",
    "lag_timeline", "latest_offsets", "ledger", "ledger_key", "messages_from_events",
    "parse_offset", "partition_lag", "payload_text", "pressure_gauge", "pressure_timeline",
    "queue_depth", "queue_name", "queue_pop", "queue_remaining", "relay_batch", "replay",
    "route", "row_index", "running_sum", "topic_lag", "watermarks",
]
