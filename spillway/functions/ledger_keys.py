"""Ledger key text form and offset text parsing.

The key form is ``<role>##<partition>##topic``. Decoding keeps keys with more
than two ``##`` parts; the role part is compared with ``<all>`` and every other
role counts as consumed; the topic is the third part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEP = "##"
ALL_TOKEN = "<all>"


def ledger_key(role: Column, partition: Column, topic: Column) -> Column:
    return F.concat(F.lit("<"), role, F.lit(">##<"), partition.cast("string"), F.lit(">##"),
                    topic)


def key_parts(key: Column) -> Column:
    return F.split(key, KEY_SEP)


def key_is_ledger(key: Column) -> Column:
    return F.size(key_parts(key)) > 2


def key_role_is_all(key: Column) -> Column:
    return key_parts(key).getItem(0) == F.lit(ALL_TOKEN)


def key_partition(key: Column) -> Column:
    token = key_parts(key).getItem(1)
    return F.regexp_extract(token, r"^<(.*)>$", 1).try_cast("int")


def key_topic(key: Column) -> Column:
    return key_parts(key).getItem(2)


def parse_offset(text: Column) -> Column:
    """Offset text to BIGINT; anything that is not a plain integer (``unset``,
    ``beginning``, NULL, out of range) is 0."""
    clean = F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))
    return F.coalesce(clean, F.lit(0).cast("bigint"))


def offset_text(offset: Column) -> Column:
    """Committed-position text as a topic client prints it: NULL is ``unset``."""
    return F.coalesce(offset.cast("string"), F.lit("unset"))
