"""Dense arrival positions of one large stream batch, without a window over a whole topic.

The batch is kept once as it came and once as sorted runs: range-partitioned by (topic, arrival order), one file a task. A
row's place in its file is known to the reader, so its position is that place plus a base: how many rows of its
topic are in earlier runs. The bases come from one count a (topic, run) over key columns. So a hot topic is spread over
as many tasks as its bytes ask for, and positions depend on the rows alone, not on where the runs were cut: a replay
gives the same ones. The three tables of a writer are replaced by its next batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.queue import FIFO_ORDER
from ..plans.joins import fits_broadcast

COLUMNS = ["topic", "partition", "offset", "timestamp", "value"]


class StagedBatch:
    def __init__(self, batch: DataFrame, folder: str):
        self.spark: SparkSession = batch.sparkSession
        self.folder = folder
        self.rows = self._kept(batch.select(*COLUMNS), "rows")  # the source is read once; the cut points are sampled here
        keys = ["topic", *FIFO_ORDER]
        runs = self._kept(self.rows.repartitionByRange(*keys).sortWithinPartitions(*keys), "runs")
        self._placed = runs.select(*COLUMNS, F.col("_metadata.file_path").alias("_run"), F.col("_metadata.row_index").alias("_at"))
        self.spans = self._kept(
            self._placed.groupBy("topic", "_run").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"),
                                                      F.min(F.struct(*FIFO_ORDER)).alias("_key"), F.max("offset").alias("_last")), "spans")

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def counts(self, topics: tuple[str, ...]) -> dict:
        """Rows seen, rejected (no topic) and of each topic, and the last offset that has a topic."""
        of = [F.sum(F.when(F.col("topic") == t, F.col("_n"))) for t in topics]
        totals = [F.sum("_n").alias("seen"), F.sum(F.when(F.col("topic").isNull(), F.col("_n"))).alias("rejected"),
                  *[c.alias(f"n{i}") for i, c in enumerate(of)]]
        last = F.max(F.when(F.col("topic").isNotNull(), F.col("_last"))).cast("bigint").alias("last_offset")
        found = self.spans.agg(*totals, last).first().asDict()
        return {name: n if name == "last_offset" else n or 0 for name, n in found.items()}

    def positioned(self) -> DataFrame:
        """The rows that have a topic, with ``pos``: 0, 1, … in arrival order for each topic."""
        earlier = Window.partitionBy("topic").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)  # one row a run
        base = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
        bases = self.spans.where(F.col("topic").isNotNull()).select("topic", "_run", base.alias("_base"))
        bases = F.broadcast(bases) if fits_broadcast(self.spans) else bases
        return self._placed.join(bases, ["topic", "_run"]).select(*COLUMNS, (F.col("_base") + F.col("_at")).alias("pos"))
