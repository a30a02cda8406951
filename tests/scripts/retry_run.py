"""Run skew-safe scans with one failing first task attempt; print result digests.

usage: python retry_run.py <sf_dir> <fail: 0|1>
"""

import hashlib
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import pandas as pd  # noqa: E402
from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from spillway.operators import queue as q  # noqa: E402
from spillway.session import shared_dir  # noqa: E402
from spillway.sources.messages import messages_from_events  # noqa: E402
from spillway.sources.tables import table  # noqa: E402


def main() -> None:
    sf, fail = sys.argv[1], sys.argv[2] == "1"
    spark = (SparkSession.builder.master("local[4,3]")  # up to 3 attempts per task
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "6")
             .config("spillway.scan.maxGroupRows", "0").getOrCreate())
    spark.sparkContext.setLogLevel(os.environ.get("RETRY_LOG", "OFF"))
    shared_dir(spark)

    @F.pandas_udf("string")
    def flaky(s: pd.Series) -> pd.Series:
        ctx = TaskContext.get()
        if fail and ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        return s

    events = table(spark, sf, "events").withColumn("props", flaky("props"))
    msgs = messages_from_events(events)
    depth = q.depth_timeline(q.queue_ops(msgs))
    for name, df in (("messages", msgs), ("depth", depth)):
        rows = sorted(tuple(r) for r in df.collect())
        print(name, len(rows), hashlib.sha256(repr(rows).encode()).hexdigest())


if __name__ == "__main__":
    main()
