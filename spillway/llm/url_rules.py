"""URL filters as a sort-merge range join.

A rule (host, path) becomes the key ``reversed host labels NUL path``; the keys that it fits
start with it, one interval of the sort order, and two intervals nest or are apart. A URL
gives one key for each suffix of its host (``a.b.net/x``: net, b.net, a.b.net). Keys are dealt
into ranges and sorted; one sweep over each range keeps a stack of the rules whose interval is open, and
the top of the stack is the longest rule of that host suffix. Rules open across a range's start
are dealt to that range too. A row's longest rule over its suffixes then decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import width

SEP, ESCAPE = "\x01", "\x02"  # SEP stands between labels and before the path, and in no label

# The rules of the registered query (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def labels(host_: Column) -> Column:
    """Labels of a host, the last first; a separator within one is written as two escapes, an escape as escape and \\x03."""
    plain = F.replace(F.replace(host_, F.lit(ESCAPE), F.lit(ESCAPE + "\x03")), F.lit(SEP), F.lit(ESCAPE * 2))
    return F.reverse(F.split(plain, r"\."))


def rule_key(host_: Column, path_: Column) -> Column:
    return F.concat(F.array_join(labels(host_), SEP), F.lit(SEP), path_)


def suffix_keys(host_: Column, path_: Column) -> Column:
    """One key for each host suffix, the whole host last."""
    own = labels(host_)
    return F.transform(F.sequence(F.lit(1), F.size(own)), lambda n: F.concat(F.array_join(F.slice(own, 1, n), SEP), F.lit(SEP), path_))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row of ``pages``; ``rules``: (host, path, verdict).

    Both tables may be of any size: keys are range-partitioned with a unique tie-break, so a hot URL
    or host is spread over tasks; a task holds one batch and the stack of nested rules.

    Defined cases: a NULL url or one without ``://`` has an empty host and path and no rule; no
    fitting rule gives ``default`` and a NULL rule; of equal rules (same host and path) the
    alphabetically first verdict counts; rules with a NULL host or path, or a path that no url
    has (one without a leading slash), are ignored; repeated
    rows are each judged; an empty table gives no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    # a row id that stays: the table is written once, and ids are per task and row
    rows = pin(pages.select(F.col(id_col).alias("page_id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
               .withColumn("row", F.monotonically_increasing_id()), "url-rows")
    keyed = (rows.where("host <> ''").select("row", F.explode(suffix_keys(F.col("host"), F.col("path"))).alias("key"))
             .repartitionByRange(width(spark), "key", "row").withColumn("part", F.spark_partition_id()))
    keyed = pin(keyed, "url-keys")
    bounds = keyed.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))  # one row a range
    named = (rules.where("host IS NOT NULL AND (path = '' OR startswith(path, '/'))").groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
             .select(rule_key(F.col("host"), F.col("path")).alias("rkey"), F.concat("host", "path").alias("rule"), "verdict"))
    # a rule goes to every range that its interval meets: few ranges, but for the broadest rules
    dealt = named.join(F.broadcast(bounds), (F.col("rkey") <= F.col("high")) & ((F.col("rkey") >= F.col("low")) | F.col("low").startswith(F.col("rkey"))))
    events = (keyed.select("part", "key", F.lit(1).alias("kind"), "row", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
              .unionByName(dealt.select("part", F.col("rkey").alias("key"), F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("row"), "rule", "verdict")))
    events = events.repartition(width(spark), "part").sortWithinPartitions("part", "key", "kind")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state: dict = {"part": None, "active": []}
        for batch in batches:
            out = []
            for part, key, kind, row, rule, verdict in zip(*(batch[c] for c in ("part", "key", "kind", "row", "rule", "verdict"))):
                if part != state["part"]:
                    state["part"], state["active"] = part, []
                active = state["active"]
                while active and not key.startswith(active[-1][0]):
                    active.pop()
                if kind == 0:
                    active.append((key, rule, verdict))
                elif active:
                    out.append((int(row), active[-1][1], active[-1][2], len(active[-1][1])))
            yield pd.DataFrame(out, columns=["row", "rule", "verdict", "size"])

    hits = events.mapInPandas(run, "row bigint, rule string, verdict string, size int")
    best = hits.groupBy("row").agg(F.max(F.struct("size", "rule", "verdict")).alias("best")).withColumnRenamed("row", "r")
    return (rows.join(best, rows.row == F.col("r"), "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")))


def default_rules(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "host string, path string, verdict string")
