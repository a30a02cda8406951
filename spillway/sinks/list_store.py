"""External list-store back-end for queues (push / pop / length).

A store keeps one FIFO list per queue plus the (batch_id, pos) of the last item
pushed to it. ``push_ordered`` appends a queue table to such a store: rows are
clustered by queue and sorted by (batch_id, pos) (a list has one append order,
so each queue is written by one task), sent in pipelined chunks, and every
chunk moves the mark with it. A retried task or a replayed batch first reads the
mark and skips what the list already holds, so replays never duplicate items.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .queue_sink import with_retry


Mark = tuple[int, int]  # (batch_id, pos) of the last item pushed to a list
NO_MARK: Mark = (-1, -1)


class ListStore(Protocol):
    def push(self, queue: str, items: Sequence[str], mark: Mark) -> None:
        """Append ``items`` at the tail and record ``mark`` (atomically)."""

    def last_mark(self, queue: str) -> Mark:
        """(batch_id, pos) of the last pushed item, ``NO_MARK`` if none."""

    def pop(self, queue: str, n: int = 1) -> list[str]:
        """Take up to ``n`` items from the head."""

    def length(self, queue: str) -> int:
        """Items in the list (0 for a missing list)."""


def push_ordered(rows: DataFrame, store_factory: Callable[[], ListStore], chunk: int = 500,
                 attempts: int = 5, delay_s: float = 2.0) -> DataFrame:
    """Lazily push ``queue, batch_id, pos, payload`` rows; returns per-queue
    pushed counts (run it with any action, e.g. ``.collect()`` of the counts)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    clustered = (rows.select("queue", "batch_id", "pos", "payload").repartition(n, "queue")
                 .sortWithinPartitions("queue", "batch_id", "pos"))

    def push_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = store_factory()
        marks: dict[str, Mark] = {}
        pushed: dict[str, int] = {}
        for pdf in batches:
            if pdf["queue"].isna().any():
                raise ValueError("a row without a queue cannot be pushed")
            for queue, part in pdf.groupby("queue", sort=False):
                if queue not in marks:
                    marks[queue] = tuple(store.last_mark(queue))
                mb, mp = marks[queue]
                b, p = part["batch_id"], part["pos"]
                fresh = part[(b > mb) | ((b == mb) & (p > mp))]
                for start in range(0, len(fresh), chunk):
                    piece = fresh.iloc[start:start + chunk]
                    items = piece["payload"].tolist()
                    last = (int(piece["batch_id"].iloc[-1]), int(piece["pos"].iloc[-1]))
                    with_retry(lambda: store.push(queue, items, last), attempts, delay_s)
                    marks[queue] = last
                    pushed[queue] = pushed.get(queue, 0) + len(items)
        if pushed:
            yield pd.DataFrame({"queue": pd.Series(list(pushed), dtype=object),
                                "pushed": pd.Series(list(pushed.values()), dtype="int64")})

    acks = clustered.mapInPandas(push_batches, "queue string, pushed bigint")
    return acks.groupBy("queue").agg(F.sum("pushed").alias("pushed"))


class FileListStore:
    """A list store on a shared folder (one JSON-lines file per queue plus a
    mark file). For tests and single-writer-per-queue use."""

    def __init__(self, root: str):
        self.root = root.removeprefix("file:")
        os.makedirs(self.root, exist_ok=True)

    def _file(self, queue: str, kind: str) -> str:
        safe = queue.replace("/", "%2F")
        return os.path.join(self.root, f"{safe}.{kind}")

    def push(self, queue: str, items: Sequence[str], mark: Mark) -> None:
        with open(self._file(queue, "list"), "a", encoding="utf-8") as fh:
            fh.writelines(json.dumps(item) + "\n" for item in items)
        tmp = self._file(queue, "mark.tmp")
        with open(tmp, "w") as fh:
            fh.write(json.dumps(list(mark)))
        os.replace(tmp, self._file(queue, "mark"))

    def last_mark(self, queue: str) -> Mark:
        try:
            with open(self._file(queue, "mark")) as fh:
                batch_id, pos = json.load(fh)
                return int(batch_id), int(pos)
        except FileNotFoundError:
            return NO_MARK

    def _items(self, queue: str) -> list[str]:
        try:
            with open(self._file(queue, "list"), encoding="utf-8") as fh:
                return [json.loads(line) for line in fh]
        except FileNotFoundError:
            return []

    def pop(self, queue: str, n: int = 1) -> list[str]:
        items = self._items(queue)
        head, rest = items[:n], items[n:]
        with open(self._file(queue, "list"), "w", encoding="utf-8") as fh:
            fh.writelines(json.dumps(item) + "\n" for item in rest)
        return head

    def length(self, queue: str) -> int:
        return len(self._items(queue))


def store_depth_probe(store: ListStore) -> Callable[[str], int]:
    """Gate probe for the relay stream: the list's current length."""
    return store.length
