"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

# Knobs of this library, read from the Spark conf so a cluster can tune them.
CONF_GROUP_ROWS = "spillway.scan.maxGroupRows"  # above: skew-safe chunked scans
CONF_SCAN_CHUNKS = "spillway.scan.chunks"  # range chunks of a chunked scan
CONF_BROADCAST_ROWS = "spillway.broadcast.maxRows"  # size check before broadcast
CONF_BROADCAST_BYTES = "spillway.broadcast.maxBytes"  # and of the small side's files

DEFAULT_GROUP_ROWS = 2_000_000
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 << 20


def build_session(master: str | None = None, app: str = "spillway",
                  shuffle_partitions: int | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder
    if "PYSPARK_GATEWAY_PORT" not in os.environ:  # else a submitted job: the cluster sets master, memory and width
        builder = (builder.master(master or f"local[{cpus}]").config("spark.driver.memory", "16g")
                   .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus))))
    builder = (
        builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session. Only a local-mode session without one gets a
    fresh temporary folder (tests); on a cluster a missing setting is an error,
    because a machine-local folder would not survive an executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
    path = tempfile.mkdtemp(prefix="spillway-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/spillway/{label}-{uuid.uuid4().hex[:12]}"


def pin(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts lineage (a lost executor re-reads the table instead of re-running the
    upstream plan) and freezes values that depend on physical placement.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once for each Spark application.

    Workers import the module of a function that they run; without an installed package or
    a shared PYTHONPATH they get it as a zip through Spark's own file distribution.
    """
    sc = spark.sparkContext
    if getattr(sc, "_spillway_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="spillway-zip-")  # on the driver; executors fetch it from there
    path = os.path.join(folder, "spillway_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for base, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._spillway_shipped = True


def file_system(path: str):
    """The pyarrow file system of a shared folder and the folder's name in it; for Python sources and sinks, which have no JVM."""
    from pyarrow import fs

    if urlparse(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(path).path
    return fs.FileSystem.from_uri(path)


def register_source(spark: SparkSession, source: type) -> None:
    """Registers a Python data source. Spark plans a Python stream in a process of the driver that does not get the
    shipped package: it finds it by path."""
    ship(spark)
    env = spark.sparkContext.environment
    before = env.get("PYTHONPATH")
    env["PYTHONPATH"] = os.pathsep.join([os.path.dirname(os.path.dirname(os.path.abspath(__file__))), *([before] if before else [])])
    try:
        spark.dataSource.register(source)  # takes the environment as it is now
    finally:
        if before is None:
            del env["PYTHONPATH"]
        else:
            env["PYTHONPATH"] = before
