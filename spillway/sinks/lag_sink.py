"""Lag table sink: ``topic -> lag`` with latest-wins upsert.

The table is one small snapshot (a row a topic). An upsert merges its rows into the snapshot, writes
a new one and switches to it by a numbered entry; the one before stays for readers that began with it, older ones go.
So reads and folders do not grow with the number of upserts. Topics absent from an upsert keep their
previous value; an upsert that is repeated under the same version changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .entries import Entries, subfolders

SCHEMA = "topic string, lag bigint, version bigint"


class LagTable:
    """One writer at a time (a streaming query); any number of readers."""

    def __init__(self, spark: SparkSession, path: str | None = None,
                 name: str = "topics_queue_len"):
        self.spark = spark
        self.path = path or scratch_path(spark, name)
        self._entries = Entries(spark, f"{self.path}/entries", keep=1)

    def upsert(self, lag: DataFrame, version: int) -> None:
        number, current = self._entries.newest()
        rows = lag.select("topic", F.col("lag").cast("bigint").alias("lag"), F.lit(version).cast("bigint").alias("version"))
        merged = self._snapshot(current).withColumn("fresh", F.lit(0)).unionByName(rows.withColumn("fresh", F.lit(1)))
        newest = merged.groupBy("topic").agg(F.max_by(F.struct("lag", "version"), F.struct("version", "fresh")).alias("x"))
        folder = f"snapshot-{number + 1}-{uuid.uuid4().hex[:8]}"
        newest.select("topic", "x.lag", "x.version").coalesce(1).write.parquet(f"{self.path}/{folder}")  # a row a topic
        if not self._entries.put(number + 1, {"folder": folder}):
            raise RuntimeError(f"another writer has changed the lag table {self.path}")
        for old in subfolders(self.spark, self.path):
            if old.startswith("snapshot-") and old not in (folder, current.get("folder")):
                root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{old}")
                root.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(root, True)

    def _snapshot(self, entry: dict) -> DataFrame:
        if not entry:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(f"{self.path}/{entry['folder']}")

    def read(self) -> DataFrame:
        return self._snapshot(self._entries.newest()[1])
