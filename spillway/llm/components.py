"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (a BIGINT, b BIGINT): root = smallest node reachable.

    Each round is two shuffles of the edge list; its result is written to the shared
    folder, which cuts the lineage and lets a lost executor re-read it. The number of
    rounds grows with the logarithm of the longest chain, never with the data alone.
    Loops (a = b), NULL ends and repeated edges are ignored; an empty table gives no rows.
    """
    state = pin(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .distinct(), "cc")
    mark = _fingerprint(state)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(lowest, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        parent = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(parent, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(parent.select("u", F.col("m").alias("v"))).distinct())
        state = pin(small, "cc")
        now = _fingerprint(state)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (state.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
            .unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))


def _fingerprint(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h), F.bit_xor(F.xxhash64("v", "u"))).first())
