"""Ticks of wall-clock timestamps, without any time zone: only calendar fields of the value are used."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970-01-01 00:00:00 of the same wall clock."""
    days = F.datediff(ts.cast("date"), F.to_date(F.lit("1970-01-01"))).cast("bigint")
    return days * DAY + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.floor(F.second(ts)).cast("bigint")


def at_epoch(seconds: Column) -> Column:
    """Wall-clock timestamp of a second count."""
    days = F.floor(seconds / DAY)
    return (F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
            + F.make_dt_interval(days.cast("int"), F.lit(0), F.lit(0), (seconds - days * DAY).cast("decimal(18,6)")))


def tick_number(ts: Column, seconds: int) -> Column:
    """Number of the ``seconds``-long tick with ``ts``; ticks count from the epoch, for any positive length."""
    if seconds <= 0:
        raise ValueError("a tick needs a positive length")
    return F.floor(epoch_seconds(ts) / seconds)


def tick_end(ts: Column, seconds: int) -> Column:
    """End of the tick that contains ``ts``."""
    return at_epoch((tick_number(ts, seconds) + 1) * seconds)
