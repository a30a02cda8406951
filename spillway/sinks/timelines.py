"""Kept timelines that new rows extend without a second look at the old ones.

A timeline is a table of parts. Beside it lies the *carry*: the last order key and value of every group. Extending it puts
one start row a group before the new rows, which sets the scan to the carried value, runs the same skew-safe scan over
these rows alone and writes the next part. The numbered entry of a part is the switch: what a crash left behind is not
read, and the same part written again takes its place. One writer at a time; any number of readers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gauge import pressure_timeline
from ..operators.queue import depth_timeline
from .entries import Entries

START = "_start"  # the carried value in a start row, NULL in a new one


class KeptTimeline:
    """``scan`` gives the timeline of rows with a column START: where that is not NULL the value becomes it."""

    def __init__(self, spark: SparkSession, path: str, group: str, order: str, value: str, scan: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.group, self.order, self.value, self.scan = spark, path, group, order, value, scan
        self._entries = Entries(spark, f"{path}/entries", keep=1)

    def extend(self, part: int, rows: DataFrame) -> bool:
        """Adds ``rows`` as part ``part`` (0, 1, …); False where that part is already in, and nothing is read.

        Within a group all rows come after those of earlier parts: a late or repeated order key, also a NULL one, fails
        before anything is written. Rows without a group (NULL) are a group of their own."""
        newest, entry = self._entries.newest()
        if part <= newest:
            return False
        if part != newest + 1:
            raise ValueError(f"part {newest + 1} comes before part {part}")
        group, order, value = self.group, self.order, self.value
        given = rows.withColumn(START, F.lit(None).cast("bigint"))
        if newest < 0:
            carry = None
            late = rows.where(F.col(order).isNull())
        else:
            carry = self.spark.read.schema(self._carry_schema(entry["columns"])).parquet(f"{self.path}/carry-{newest}")
            first = rows.groupBy(group).agg(F.min(order).alias("first"), F.count_if(F.col(order).isNull()).alias("without"))
            late = (first.join(carry.withColumnRenamed(group, "g"), F.col(group).eqNullSafe(F.col("g")), "left")
                    .where((F.col("first") <= F.col(order)) | (F.col("without") > 0)))  # a row a group on both sides
            given = given.unionByName(carry.withColumnRenamed(value, START), allowMissingColumns=True)
        if not late.isEmpty():
            raise ValueError("rows that do not come after the timeline's last")
        line = self.scan(given).where(F.col(START).isNull()).drop(START)
        line.write.mode("overwrite").parquet(f"{self.path}/part={part}")
        columns = {f.name: f.dataType.simpleString() for f in line.schema.fields}
        done = self.spark.read.schema(self._schema(columns)).parquet(f"{self.path}/part={part}")
        last = done.select(group, order, value)
        if carry is not None:
            last = last.unionByName(carry)
        (last.groupBy(group).agg(F.max_by(F.struct(order, value), order).alias("x")).select(group, f"x.{order}", f"x.{value}")
         .write.mode("overwrite").parquet(f"{self.path}/carry-{part}"))
        if not self._entries.put(part, {"columns": columns}):
            raise RuntimeError(f"another writer has extended the timeline {self.path}")
        self._drop_carry(part - 2)
        return True

    def read(self) -> DataFrame:
        """The timeline over all parts that are in."""
        newest, entry = self._entries.newest()
        if newest < 0:
            raise ValueError(f"the timeline {self.path} has no part yet")
        parts = [f"{self.path}/part={n}" for n in range(newest + 1)]
        return self.spark.read.schema(self._schema(entry["columns"])).parquet(*parts)

    def _schema(self, columns: dict[str, str]) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())

    def _carry_schema(self, columns: dict[str, str]) -> str:
        return self._schema({name: columns[name] for name in (self.group, self.order, self.value)})

    def _drop_carry(self, number: int) -> None:
        if number >= 0:
            root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/carry-{number}")
            root.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(root, True)


def kept_depth_timeline(spark: SparkSession, path: str) -> KeptTimeline:
    """R22, extended by push/pop operations (queue, op_seq, delta)."""
    def scan(ops: DataFrame) -> DataFrame:
        return depth_timeline(ops.withColumn("delta", F.coalesce(START, "delta")))

    return KeptTimeline(spark, path, "queue", "op_seq", "depth", scan)


def kept_pressure_timeline(spark: SparkSession, path: str, **knobs) -> KeptTimeline:
    """R29, extended by depth samples (topic, seq, len); ``knobs`` as of ``pressure_timeline``."""
    return KeptTimeline(spark, path, "topic", "seq", "gauge", lambda samples: pressure_timeline(samples, start=F.col(START), **knobs))
