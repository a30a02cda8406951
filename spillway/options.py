"""Relay options: the configuration contract of the relay and lag jobs.

A plain dataclass handed to the jobs; there is no file/env loader. Field names
follow the JSON names of the original configuration so a user can build it
from an existing config dict with ``RelayOptions.from_dict``.
"""

from __future__ import annotations

from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class RelayOptions:
    # Fixed defaults that must match the original service's behaviour.
    # kafka_addr=localhost:9092, redis_host=localhost, redis_port=6379,
    # cache_size=10, topics_queue_len="topics_queue_len", accumulated=1000,
    # min_accumulated=700, consumer_num=1, TopicLenMax=1000000,
    # ControllerTime=1 s, TopicLenToCacheTime=10 s, prefix_redis="".
    kafka_addr: tuple[str, ...] = ("localhost:9092",)
    redis_host: tuple[str, ...] = ("localhost",)
    redis_port: tuple[str, ...] = ("6379",)
    sentinel_master_name: str = ""
    cache_size: int = 10
    topics: tuple[str, ...] = ()
    consumer_group: str = ""
    prefix_redis: str = ""
    consumer_num: int = 1
    topics_queue_len: str = "topics_queue_len"
    accumulated: int = 1000
    min_accumulated: int = 700
    topic_len_max: int = 1_000_000
    controller_time_s: float = 1.0
    topic_len_to_cache_time_s: float = 10.0
    # Spark-side knobs (not in the original service).
    max_records_per_trigger: int = 10_000
    sink_retry_delay_s: float = 2.0
    sink_max_attempts: int = 5
    extra: dict = field(default_factory=dict, compare=False)

    @staticmethod
    def from_dict(conf: dict) -> "RelayOptions":
        """Build options from a config mapping; zero/empty values keep defaults."""
        aliases = {
            "TopicLenMax": "topic_len_max",
            "ControllerTime": "controller_time_s",
            "TopicLenToCacheTime": "topic_len_to_cache_time_s",
        }
        known = {f.name for f in fields(RelayOptions)}
        kwargs, extra = {}, {}
        for key, value in conf.items():
            name = aliases.get(key, key)
            if name not in known:
                extra[key] = value
                continue
            if value in (None, 0, "", [], ()):
                continue
            kwargs[name] = tuple(value) if isinstance(value, list) else value
        if not kwargs.get("topics"):
            raise ValueError("topics is required")
        return RelayOptions(**kwargs, extra=extra)

    def queue_of(self, topic: str) -> str:
        return f"{self.prefix_redis}{topic}"

    def sink_mode(self) -> str:
        """Queue back-end topology implied by host/port counts."""
        hosts, ports = len(self.redis_host), len(self.redis_port)
        if hosts > 1 and ports > 1 and hosts == ports:
            return "cluster"
        if hosts > 1 and ports == 1:
            return "sentinel"
        if hosts == 1 and ports == 1:
            return "single"
        return "none"
