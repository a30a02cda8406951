"""Queue compaction: the many small (queue, batch) folders of a queue table become one sorted base table.

A stream writes a folder per queue and batch. ``compact`` rewrites all batches up to a bound into a new base folder, without the
items that no claim can read again, and then creates the next manifest entry ({base, upto per queue}). The entry
is the switch: before it readers see the old base and the old folders, after it the new base and the folders behind
``upto``. A crash before the switch leaves an unused folder; of two compactions at once one creates the entry.

What an entry replaced stays until the next compaction, for readers that began with it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.queue import FIFO_KEY, QUEUE_COLUMNS
from .claims import oldest_kept
from .entries import Entries, subfolders
from .queue_sink import manifest_of, read_queue

FILE_BYTES = 32 << 20  # of the base, compressed; a task sorts one file's rows
FILE_ROWS = 500_000  # and the most rows: well-compressed ones are far larger in a sort


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _queue_of(spark: SparkSession, folder: str) -> str:
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.split("=", 1)[1])


def batch_folders(spark: SparkSession, path: str) -> dict[str, dict[int, str]]:
    """queue -> batch -> folder, from the listing (no rows are read)."""
    out: dict[str, dict[int, str]] = {}
    for folder in subfolders(spark, path):
        if folder.startswith("queue="):
            own = {int(b.split("=", 1)[1]): f"{path}/{folder}/{b}" for b in subfolders(spark, f"{path}/{folder}") if b.startswith("batch_id=")}
            out[_queue_of(spark, folder)] = own
    return out


def compact(spark: SparkSession, path: str, log: str, keep_batches: int = 2, streamed: dict[str, int] | None = None) -> bool:
    """Merges all but the newest ``keep_batches`` batches of each queue; FALSE where another compaction was first.

    The newest batch is never merged (a replay may write it again). ``streamed``: per queue the last batch that every
    stream reader of the table has taken; batches behind it stay, and a queue without an entry is left as it is.
    """
    manifest = Entries(spark, manifest_of(path), keep=2)
    number, current = manifest.newest()
    old_upto = current.get("upto", {})
    folders = batch_folders(spark, path)
    upto = dict(old_upto)
    for queue, batches in folders.items():
        left = sorted(batches)[:-max(1, keep_batches)]
        if streamed is not None:
            left = [b for b in left if b <= streamed.get(queue, -1)]
        if left:
            upto[queue] = max(left[-1], old_upto.get(queue, left[-1]))
    if upto == old_upto:
        return True
    dropped = {q: tuple(key) for q, key in oldest_kept(spark, log).items()}
    bounds = spark.createDataFrame([(q, b, dropped.get(q)) for q, b in upto.items()],
                                   "queue string, _upto bigint, _gone struct<batch_id: bigint, pos: bigint>")
    rows = read_queue(spark, path).join(F.broadcast(bounds), "queue").where(  # one row a queue
        (F.col("batch_id") <= F.col("_upto")) & (F.col("_gone").isNull() | (F.struct(*FIFO_KEY) > F.col("_gone"))))
    base = f"{path}-base/{number + 1}-{uuid.uuid4().hex[:8]}"
    size = sum(_bytes(spark, f) for q, own in folders.items() for b, f in own.items() if old_upto.get(q, -1) < b <= upto.get(q, -1))
    size += _bytes(spark, current["base"]) if current else 0
    files = max(1, -(-size // FILE_BYTES), -(-rows.count() // FILE_ROWS))
    (rows.select(*QUEUE_COLUMNS).repartitionByRange(files, "queue", *FIFO_KEY).sortWithinPartitions("queue", *FIFO_KEY)
     .write.parquet(base))
    if not manifest.put(number + 1, {"base": base, "upto": upto, "replaced": current.get("base")}):
        _delete(spark, base)
        return False
    for queue, own in folders.items():  # what the entry before last replaced
        for batch, folder in own.items():
            if batch <= old_upto.get(queue, -1):
                _delete(spark, folder)
    for folder in subfolders(spark, f"{path}-base"):
        whole = f"{path}-base/{folder}"
        if int(folder.split("-")[0]) <= number and whole != current.get("base"):
            _delete(spark, whole)
    return True


def _bytes(spark: SparkSession, path: str) -> int:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()


def file_count(spark: SparkSession, path: str) -> int:
    """Files of the queue table, its base folders and its manifest."""
    total = 0
    for folder in (path, f"{path}-base", manifest_of(path)):
        root = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        total += fs.getContentSummary(root).getFileCount() if fs.exists(root) else 0
    return total
