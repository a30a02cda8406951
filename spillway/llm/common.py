"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts`` (NULL for a NULL id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """TRUE for the held-out fold; a NULL id is in no fold (FALSE)."""
    return F.coalesce(fold(doc_id, parts) == part, F.lit(False))


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores added until it clashes with no column (case-insensitive)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def width(spark: SparkSession) -> int:
    """Shuffle width of the session, for explicit range partitionings."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
