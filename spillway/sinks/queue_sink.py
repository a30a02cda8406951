"""Queue sink: a Parquet queue table partitioned by (queue, batch_id).

Writing uses dynamic partition overwrite, so re-running a batch (a stream
replay after a failure) replaces exactly that batch's partitions: appends are
idempotent per batch and a replay never duplicates items.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.queue import QUEUE_COLUMNS
from .entries import Entries

QUEUE_SCHEMA = T.StructType([
    T.StructField("queue", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("payload", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])


def write_queue(rows: DataFrame, path: str, clustered: bool = False) -> None:
    """Overwrite the (queue, batch_id) partitions present in ``rows``.

    Rows are clustered by the partition columns first, so there is one file per
    (queue, batch) instead of one per task and partition. Batches are bounded
    by the per-trigger limit, so no cluster is hot, and an explicit count keeps
    the write parallel (AQE would otherwise fold small data into one writer).
    ``clustered=True`` skips this when the rows already arrive clustered by
    queue within one batch (straight out of the per-queue position window).
    """
    out = rows.select(*QUEUE_COLUMNS)
    if not clustered:
        n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        out = out.repartition(n, "queue", "batch_id")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("queue", "batch_id").parquet(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of the file system that the path names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def claim_writers(spark: SparkSession, path: str, writers: dict[str, str]) -> None:
    """Records which writer (a checkpoint) fills the queue table for each topic, beside the table.

    Batch numbers are a writer's own, so a topic that moved to another writer would start at
    batch 0 again and repeat or overwrite rows: that is refused."""
    log = f"{path}-writers"
    known = {}
    if path_exists(spark, log):
        known = {r.topic: r.writer for r in spark.read.schema("topic string, writer string").json(log).collect()}  # one row a topic
    moved = sorted(t for t, w in writers.items() if known.get(t, w) != w)
    if moved:
        raise ValueError(f"topics {moved} were written to {path} by another query: keep their grouping and checkpoint, or use a new table")
    new = [(t, w) for t, w in writers.items() if t not in known]
    if new:
        spark.createDataFrame(new, "topic string, writer string").coalesce(1).write.mode("append").json(log)


def manifest_of(path: str) -> str:
    return f"{path}-manifest"


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """The queue table: the base that the newest manifest entry names and the batches behind it (all of them without an entry)."""
    rows = spark.read.schema(QUEUE_SCHEMA).parquet(path)  # inferred folder types would turn queue 007 into 7
    rows = rows.select(*QUEUE_COLUMNS[:-1], F.col("batch_id").cast("bigint").alias("batch_id"))
    _, entry = Entries(spark, manifest_of(path)).newest()
    if not entry:
        return rows
    upto = spark.createDataFrame(list(entry["upto"].items()), "queue string, _upto bigint")
    tail = rows.join(F.broadcast(upto), "queue", "left").where(F.col("_upto").isNull() | (F.col("batch_id") > F.col("_upto")))  # one row a queue
    base = spark.read.schema(QUEUE_SCHEMA).parquet(entry["base"])
    return base.select(*QUEUE_COLUMNS).unionByName(tail.select(*QUEUE_COLUMNS))


def with_retry(write: Callable[[], None], attempts: int, delay_s: float,
               on_retry: Callable[[int, BaseException], None] | None = None) -> int:
    """Run ``write``; on failure wait ``delay_s`` and try again, at most
    ``attempts`` times, then re-raise (the stream replays the batch from its
    checkpoint). Returns the number of tries used."""
    for attempt in range(1, attempts + 1):
        try:
            write()
            return attempt
        except Exception as err:  # noqa: BLE001 - any sink error is retried
            if attempt == attempts:
                raise
            if on_retry is not None:
                on_retry(attempt, err)
            time.sleep(delay_s)
    return attempts
