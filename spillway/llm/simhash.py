"""SimHash near-dedup by covering locality-sensitive hashing.

A document's 64-bit fingerprint has a bit set where over half of its shingle hashes have
it. Fingerprints at ``radius`` or fewer differing bits are linked and connected groups
are numbered by their smallest doc_id.

Candidate search. Bit ``i`` gets the vector ``(i mod (2^(r+1)-1)) + 1`` in GF(2)^(r+1).
Table ``v`` (every non-zero vector, 7 tables for radius 2) keeps the bits whose vector has
an odd product with ``v``. The vectors of r differing bits never span the whole space, so
some ``v`` is orthogonal to all of them: that table drops every differing bit, and the
pair meets there. No pair within the radius is missed.

Buckets. Members of a bucket of at most ``PAIR_LIMIT`` fingerprints are compared directly.
A larger bucket is not expanded into pairs: each of its members lists itself and its
64 one-bit neighbours, and two fingerprints are within 2 bits exactly when they share
such a neighbour, so linking every list to its smallest member gives the same
groups with 65 rows a fingerprint, however large the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import free_name
from .components import connected_components

PAIR_LIMIT = 32
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """SimHash of one text, unsigned; NULL and texts without words give 0."""
    if not text:
        return 0
    w = text.encode("utf-8", "surrogatepass").lower().split()  # ASCII case and white space only
    if not w:
        return 0
    if len(w) < words:
        grams = iter([b" ".join(w)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(w[i:] for i in range(words))))
        n = len(w) - words + 1
    hashes = map(partial(xxhash.xxh64_intdigest, seed=seed), grams)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):  # a very long text is folded in bounded pieces
        h = np.fromiter(hashes, np.uint64, min(CHUNK, n - start))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: Column, words: int = 3, seed: int = 42) -> Column:
    """BIGINT with the bits of the SimHash of ``text``."""

    @F.pandas_udf("bigint")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(np.array([fingerprint(x, words, seed) for x in batch], np.uint64).view(np.int64))

    return prints(text)


def covering_masks(radius: int = 2, bits: int = 64) -> list[int]:
    """The structured masks, as signed BIGINT values: one for each non-zero vector of radius + 1 bits."""
    top = 2 ** (radius + 1)
    masks = (sum(1 << i for i in range(bits) if (v & (i % (top - 1) + 1)).bit_count() & 1) for v in range(1, top))
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints (column ``fp``) that connect all pairs within ``radius``."""
    if radius != 2:
        raise ValueError("the one-bit neighbour lists of large buckets are exact for radius 2")
    masks = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                      for t, m in enumerate(covering_masks(radius))])
    keyed = prints.select("fp", F.explode(masks).alias("b")).select("fp", "b.t", "b.key")
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = pin(keyed.join(sizes, ["t", "key"]), "simhash-buckets")
    pairs = (members.where(F.col("n") <= PAIR_LIMIT).groupBy("t", "key").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
             .select(F.explode(F.expr(f"""flatten(transform(fps, (x, i) -> transform(
                 filter(slice(fps, i + 2, size(fps)), y -> bit_count(x ^ y) <= {radius}),
                 y -> struct(x AS a, y AS b))))""")).alias("p")).select("p.a", "p.b"))
    near = F.concat(F.array(F.col("fp")), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), i))))
    large = (members.where(F.col("n") > PAIR_LIMIT).select("fp").distinct().select("fp", F.explode(near).alias("x"))
             .groupBy("x").agg(F.collect_list("fp").alias("fps"))  # at most 65 distinct fingerprints are that near
             .where("size(fps) > 1").select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b"))
    return pairs.unionByName(large).distinct()


def grouped(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, root, component_id) for each row: the group's smallest fingerprint and smallest doc_id."""
    fps = pin(docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(F.col(text_col), words).alias("fp")), "simhash")
    reps = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(links(reps.select("fp"), radius))
    rooted = reps.join(roots, reps.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    label = rooted.join(groups, "root").select(F.col("fp").alias("fp_"), "root", "component_id")
    # hot fingerprints: the adaptive skew join splits them
    return fps.join(label, fps.fp == label.fp_).select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint STRING of 16 hex digits, component_id BIGINT), one row for each row of ``docs``.

    Defined cases: a NULL or word-less text has fingerprint 0 and is linked like any other;
    fewer than ``words`` words form one shingle; repeated rows and copies share a
    fingerprint and so a component; component_id is the smallest non-NULL doc_id of the
    group (NULL if it has none); an empty table gives no rows; other columns are ignored.
    """
    return grouped(docs, words, radius, id_col, text_col).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` without near copies: of each group one row stays, one with the smallest doc_id.

    Texts move once, hashed by doc_id against the table of the ids that stay. Where ids repeat
    or are NULL, rows are told apart by fingerprint as well and one of each group is taken.
    """
    i, f, r = (free_name(docs.columns, x) for x in ("stay_id", "stay_fp", "stay_root"))
    stay = pin(grouped(docs, words, radius).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
               .groupBy(F.col("doc_id").alias(i), F.col("fp").alias(f), F.col("root").alias(r))
               .agg(F.count("*").alias("n")), "simhash-stay")
    same_id = stay.groupBy(i).agg(F.sum("n").alias("rows")).where(f"rows > 1 OR `{i}` IS NULL")
    if same_id.isEmpty() and _unique(docs):
        return docs.join(stay.select(i).hint("shuffle_hash"), F.col("doc_id") == F.col(i), "left_semi")
    own = free_name(docs.columns, "own_fp")
    right = stay.select(i, f, r).hint("shuffle_hash")
    both = docs.withColumn(own, fingerprint_column(F.col("text"), words))
    both = both.join(right, F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(own) == F.col(f)))
    return both.dropDuplicates([r]).select(*docs.columns)


def _unique(docs: DataFrame) -> bool:
    return docs.select("doc_id").groupBy("doc_id").count().where("count > 1").isEmpty()
