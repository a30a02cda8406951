"""Joins against a small side whose size is checked, never assumed."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import (CONF_BROADCAST_BYTES, CONF_BROADCAST_ROWS, DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, conf_int,
                       pin)


def pinned_bytes(df: DataFrame) -> int:
    """Bytes of a pinned table's files, from the optimizer's statistics (no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(pinned: DataFrame) -> bool:
    """Whether a pinned table is within the byte and the row limit of a broadcast."""
    spark = pinned.sparkSession
    return (pinned_bytes(pinned) <= conf_int(spark, CONF_BROADCAST_BYTES, DEFAULT_BROADCAST_BYTES)
            and pinned.count() <= conf_int(spark, CONF_BROADCAST_ROWS, DEFAULT_BROADCAST_ROWS))


def lookup_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left",
                label: str = "lookup", null_safe: bool = False) -> DataFrame:
    """Join ``big`` with a derived lookup table ``small``.

    ``small`` is pinned in the shared folder (computed once, lineage cut) and
    counted; it is broadcast only when its rows are within
    ``spillway.broadcast.maxRows`` and the bytes of its files within
    ``spillway.broadcast.maxBytes``, otherwise the join is left to a shuffle
    join on the keys (AQE may still pick broadcast at run time). With
    ``null_safe`` a NULL key matches a NULL key (``<=>``), as in grouping.
    """
    small = pin(small, label)
    broadcast = fits_broadcast(small)
    if not null_safe:
        return big.join(F.broadcast(small) if broadcast else small, on, how)
    keyed = small.select(*[F.col(c).alias(f"_key_{c}") if c in on else F.col(c)
                           for c in small.columns])
    if broadcast:
        keyed = F.broadcast(keyed)
    cond = reduce(and_, [big[c].eqNullSafe(keyed[f"_key_{c}"]) for c in on])
    joined = big.join(keyed, cond, how)
    return joined.drop(*[f"_key_{c}" for c in on]) if how not in ("left_semi", "left_anti") \
        else joined
