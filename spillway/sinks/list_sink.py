"""A stream sink into ordered lists with a commit protocol.

Tasks do not append to a list. Each *stages* its rows as runs: rows of one (queue, partition) with growing offsets, under
a name of the attempt's own, which no reader sees. Their names, bounds and sizes, and no payload, go to the driver as the
tasks' commit messages. When all tasks of a batch are done, the driver *publishes*: for each queue it orders the runs by
(partition, first offset), moves them to the list and creates the batch's entry, at which moment they are part of the list. A
queue that already has the batch is left as it is, so a batch that failed anywhere (half staged, or between two queues'
entries) can be run again and leaves neither gaps nor copies; what a failed attempt staged is dropped.

Order: batches, then (partition, offset) as a topic keeps it. ``RunLists`` is such a store on a shared folder; a networked
store has the same three calls (``stage``, ``publish``, ``discard``), and a subclass of ``QueueLists`` names it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

from ..plans.joins import lookup_join
from ..session import file_system, register_source
from .entries import folder_of
from .queue_sink import path_exists

COLUMNS = ["queue", "partition", "offset", "payload"]
ITEMS = "queue string, partition int, offset bigint, payload string"
ENTRY = "queue string, batch_id bigint, runs array<struct<file: string, base: bigint, n: bigint>>, total bigint, writer string"
RUN_ITEMS = 5_000  # a run is staged when it holds so many items ...
HELD_ITEMS = 50_000  # ... or a task holds so many in all its open runs


@dataclass
class Run:
    queue: str
    partition: int
    first: int
    last: int
    n: int
    name: str


@dataclass
class Pushed(WriterCommitMessage):
    runs: list[Run]


class RunLists:
    """Lists on a shared folder: Parquet runs and, for each queue, one small entry a batch."""

    def __init__(self, path: str):
        self.fs, self.root = file_system(path)

    def _open(self, writer: str) -> str:
        return f"{self.root}/open/{folder_of(writer)}"

    def _there(self, folder: str) -> list:
        from pyarrow import fs

        return self.fs.get_file_info(fs.FileSelector(folder, allow_not_found=True))

    def stage(self, writer: str, name: str, rows) -> None:
        """Keeps the rows of a run aside, unseen."""
        import pyarrow.parquet as pq

        self.fs.create_dir(self._open(writer))
        pq.write_table(rows, f"{self._open(writer)}/{name}.parquet", filesystem=self.fs)

    def newest(self, queue: str) -> tuple[int, dict]:
        """(batch, entry) that was published last, (-1, {}) for a list without any."""
        names = sorted(f.base_name for f in self._there(f"{self.root}/lists/{folder_of(queue)}/done") if f.base_name.endswith(".json"))
        if not names:
            return -1, {}
        with self.fs.open_input_stream(f"{self.root}/lists/{folder_of(queue)}/done/{names[-1]}") as file:
            return int(names[-1][:-5]), json.loads(file.read())

    def length(self, queue: str) -> int:
        """Items that were ever pushed to the list."""
        return self.newest(queue)[1].get("total", 0)

    def publish(self, writer: str, queue: str, batch_id: int, runs: list[Run]) -> bool:
        """Appends the runs to the list, all or none; False where the list has this batch already."""
        home = f"{self.root}/lists/{folder_of(queue)}"
        newest, last = self.newest(queue)
        if last and last["writer"] != writer:
            raise ValueError(f"{queue} is filled by another stream, whose batch numbers are its own")
        if newest >= batch_id:
            return False
        folder, place, kept = f"{home}/runs/{batch_id:020d}", last.get("total", 0), []
        if self._there(folder):
            self.fs.delete_dir_contents(folder)  # of an attempt that ended before its entry
        self.fs.create_dir(folder)
        self.fs.create_dir(f"{home}/done")
        for i, run in enumerate(runs):
            name = f"{folder_of(queue)}/runs/{batch_id:020d}/{i:06d}.parquet"
            self.fs.move(f"{self._open(writer)}/{run.name}.parquet", f"{self.root}/lists/{name}")
            kept.append({"file": name, "base": place, "n": run.n})
            place += run.n
        spare = f"{home}/.{uuid.uuid4().hex}"
        with self.fs.open_output_stream(spare) as file:
            file.write(json.dumps({"queue": queue, "batch_id": batch_id, "runs": kept, "total": place, "writer": writer}).encode())
        self.fs.move(spare, f"{home}/done/{batch_id:020d}.json")
        return True

    def discard(self, writer: str) -> None:
        """Drops what the writer has staged and not published."""
        if self._there(self._open(writer)):
            self.fs.delete_dir_contents(self._open(writer))


def pieces(queues, partitions: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers of each stretch of one (queue, partition) whose offsets grow, in the order in which the rows came."""
    codes = queues.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    order = np.lexsort((np.arange(len(codes)), partitions, codes))
    c, p, o = codes[order], partitions[order], offsets[order]
    cuts = np.flatnonzero((c[1:] != c[:-1]) | (p[1:] != p[:-1]) | (o[1:] <= o[:-1])) + 1
    return (rows for rows in np.split(order, cuts) if len(rows))


class ListWriter(DataSourceStreamArrowWriter):
    def __init__(self, lists: RunLists, writer: str):
        self.lists, self.writer = lists, writer

    def write(self, iterator: Iterator) -> Pushed:
        import pyarrow as pa

        held: dict[tuple[str, int], list] = {}
        size: dict[tuple[str, int], int] = {}
        done: list[Run] = []

        def close(key: tuple[str, int]) -> None:
            rows = pa.concat_tables(held.pop(key))
            size.pop(key)
            name, offsets = uuid.uuid4().hex, rows.column("offset")
            self.lists.stage(self.writer, name, rows)
            done.append(Run(*key, offsets[0].as_py(), offsets[-1].as_py(), rows.num_rows, name))

        for batch in iterator:
            rows = pa.Table.from_batches([batch]).select(COLUMNS).combine_chunks()
            if any(rows.column(c).null_count for c in COLUMNS[:3]):
                raise ValueError("an item needs a queue, a partition and an offset")
            if not rows.num_rows:
                continue
            queue, partition, offset, _ = (rows.column(c).chunk(0) for c in COLUMNS)
            partition, offset = partition.to_numpy(), offset.to_numpy()
            for at in pieces(queue, partition, offset):
                key = (queue[int(at[0])].as_py(), int(partition[at[0]]))
                if key in held and held[key][-1].column("offset")[-1].as_py() >= offset[at[0]]:
                    close(key)
                held.setdefault(key, []).append(rows.take(pa.array(at)))
                size[key] = size.get(key, 0) + len(at)
                if size[key] >= RUN_ITEMS:
                    close(key)
            if sum(size.values()) >= HELD_ITEMS:
                for key in list(held):
                    close(key)
        for key in list(held):
            close(key)
        return Pushed(done)

    def commit(self, messages: list, batchId: int) -> None:  # noqa: N803 - Spark's name
        queues: dict[str, list[Run]] = {}
        for run in (run for message in messages if message for run in message.runs):
            queues.setdefault(run.queue, []).append(run)
        for queue, runs in sorted(queues.items()):
            runs.sort(key=lambda r: (r.partition, r.first))
            for a, b in zip(runs, runs[1:]):
                if a.partition == b.partition and b.first <= a.last:
                    raise ValueError(f"{queue}: rows of partition {a.partition} did not come in the order of their offsets")
            self.lists.publish(self.writer, queue, batchId, runs)
        self.lists.discard(self.writer)

    def abort(self, messages: list, batchId: int) -> None:  # noqa: N803
        self.lists.discard(self.writer)


class QueueLists(DataSource):
    """Options: path, writer (who fills the lists; batch numbers are the writer's own)."""

    lists = RunLists

    @classmethod
    def name(cls) -> str:
        return "queuelists"

    def schema(self) -> str:
        return ITEMS

    def streamWriter(self, schema, overwrite: bool) -> ListWriter:  # noqa: N802
        return ListWriter(self.lists(self.options["path"]), self.options["writer"])


def push_stream(rows: DataFrame, path: str, checkpoint: str, store: type[QueueLists] = QueueLists) -> DataStreamWriter:
    """Routed rows (queue, partition, offset, payload) of a stream into the lists at ``path``; not started yet.

    Rows of a partition have to come in the order of their offsets within a task, and not overlap between tasks, as a topic
    source gives them; anything else fails the batch. A NULL payload stays NULL; repeated runs of a batch push nothing twice."""
    register_source(rows.sparkSession, store)
    return (rows.select(*COLUMNS).writeStream.format(store.name()).option("path", path).option("writer", checkpoint)
            .option("checkpointLocation", checkpoint))


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    """Every published item with ``pos``, its place in its list."""
    if not path_exists(spark, f"{path}/lists"):
        return spark.createDataFrame([], f"{ITEMS}, pos bigint")
    entries = spark.read.schema(ENTRY).json(f"{path}/lists/*/done/*.json").select(F.inline("runs")).select("file", "base")
    items = spark.read.schema(ITEMS).parquet(f"{path}/lists/*/runs/*")
    items = items.select("*", F.substring_index("_metadata.file_path", "/", -4).alias("file"), F.col("_metadata.row_index").alias("_row"))
    return lookup_join(items, entries, ["file"], "inner", label="list-entries").select(*COLUMNS, (F.col("base") + F.col("_row")).alias("pos"))
