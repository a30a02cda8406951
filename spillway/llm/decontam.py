"""Benchmark decontamination: pigeonhole edit matching.

A test item of m normalised bytes has an error budget of k = floor(error_rate * m) edits and
is split into k + 1 pieces. A passage within k edits leaves at least one piece untouched, so
exact piece hits (one Aho-Corasick pass over the text) find every candidate; Myers' bit-parallel
algorithm then measures the edit distance in the window that the hit allows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, table

ERROR_RATE = 0.08
MIN_CHARS = 25  # shorter items have no budget: only whole, exact occurrences at word ends count
BLOCK_BYTES = 4 << 20  # benchmark text held by one task at once; larger benchmarks take several passes

# ASCII letters in lower case, other ASCII but digits as space, further UTF-8 bytes as they are
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))
_SIGN = re.compile(r"[^\x00-\x7f\w]")


def _sign(found: re.Match) -> str:
    """Outside ASCII: combining marks stay, invisible format characters (soft hyphen, zero width) go, all else is a space."""
    kind = unicodedata.category(found[0])
    return found[0] if kind[0] == "M" else "" if kind == "Cf" else " "


def normalise(text: str | None) -> str:
    """Case-folded words of the text (compatibility forms made one, NFKC), one space between them: its UTF-8
    bytes, as one character a byte. Any code point but letters, marks and digits separates words."""
    t = text or ""
    if not t.isascii():
        t = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", t).casefold())
        t = unicodedata.normalize("NFKC", _SIGN.sub(_sign, t))
    return b" ".join(t.encode("utf-8", "surrogatepass").translate(_FOLD).split()).decode("latin-1")


def budget(length: int, rate: float = ERROR_RATE) -> int:
    return int(length * rate) if length >= MIN_CHARS else 0


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): ``errors`` + 1 pieces that cover the item without overlap."""
    cuts = [j * len(item) // (errors + 1) for j in range(errors + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def pattern_bits(pattern: str) -> dict[str, int]:
    bits: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        bits[c] |= 1 << i
    return dict(bits)


def myers(bits: dict[str, int], m: int, text: str, anchored: bool = False) -> tuple[int, int]:
    """(smallest distance, end): of the pattern to a part of ``text`` that ends at ``end`` (the first such).

    ``anchored``: the part starts at the text's start.
    """
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for pos, c in enumerate(text, 1):
        eq = bits.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = ((ph << 1) | anchored) & full
        mh = (mh << 1) & full
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, pos
    return best, end


class Matcher:
    """Finds the items of one benchmark block in texts."""

    def __init__(self, items: list[tuple[int, str]], rate: float = ERROR_RATE):
        import ahocorasick

        self.items = [(i, t) for i, t in ((i, normalise(t)) for i, t in items) if t]
        self.errors = [budget(len(t), rate) for _, t in self.items]
        self.bits = [pattern_bits(t) for _, t in self.items]
        self.back = [pattern_bits(t[::-1]) for _, t in self.items]
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, t) in enumerate(self.items):
            for at, piece in pieces(t, self.errors[n]):
                where[piece].append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in where.items():
            self.automaton.add_word(piece, (len(piece), owners))
        self.automaton.make_automaton()
        self.memo: dict[tuple[int, str], tuple[int, int]] = {}

    def find(self, text: str | None) -> dict[int, tuple[int, int, int]]:
        """item number -> (distance, start, end) of its best passage in the normalised text."""
        t = normalise(text)
        found: dict[int, tuple[int, int, int]] = {}
        if not t or not self.items:
            return found
        seen = set()
        for last, (size, owners) in self.automaton.iter(t):
            for n, at in owners:
                k, m = self.errors[n], len(self.items[n][1])
                begin = last + 1 - size - at  # where the item would start without inserts and deletes
                if (n, begin) in seen or found.get(n, (1,))[0] == 0:
                    continue
                seen.add((n, begin))
                low = max(0, begin - k)
                window = t[low:begin + m + k]
                if len(window) < m - k:
                    continue
                if k == 0:
                    # exact items match whole words only
                    if window == self.items[n][1] and t[low - 1:low] in ("", " ") and t[low + m:low + m + 1] in ("", " "):
                        found[n] = (0, low, low + m)
                    continue
                key = (n, window)
                hit = self.memo.get(key)
                if hit is None:
                    if len(self.memo) > 20_000:
                        self.memo.clear()
                    hit = self.memo[key] = myers(self.bits[n], m, window)
                if hit[0] <= k and hit[0] < found.get(n, (k + 1,))[0]:
                    # the same distance is reached from the end backwards: that gives the start
                    back = myers(self.back[n], m, window[:hit[1]][::-1], anchored=True)
                    found[n] = (hit[0], low + hit[1] - back[1], low + hit[1])
        return found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> list[list[tuple[int, str]]]:
    """The benchmark in blocks of a checked size, dealt by hash; only one block's rows are fetched at a time."""
    items = benchmark.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    count = -(-total // BLOCK_BYTES)
    for b in range(count):
        yield [(r.i, r.t) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == b).collect()]


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, id_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, distance, errors, start, end): each item's best passage in each row of ``docs``.

    Positions are bytes of the normalised text. One pass over the texts for each benchmark block, without a shuffle.

    Defined cases: NULL and empty texts and items match nothing; repeated rows of ``docs`` each
    give their rows; repeated items count once; of passages with the same distance the
    first counts; an empty table on either side gives no rows; other columns are ignored. Long
    texts are searched whole.
    """
    spark = docs.sparkSession
    schema = "doc_id bigint, item_id bigint, distance bigint, errors bigint, start bigint, end bigint"
    rows = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t"))
    out = None
    for block in _blocks(benchmark, item_col, item_text_col):
        held = spark.sparkContext.broadcast(block)  # at most BLOCK_BYTES of text, by the sum above

        def search(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            matcher = Matcher(held.value, rate)
            for batch in batches:
                found = [(i, matcher.items[n][0], d, matcher.errors[n], a, z)
                         for i, t in zip(batch["i"], batch["t"]) for n, (d, a, z) in matcher.find(t).items()]
                frame = pd.DataFrame(found, columns=["doc_id", "item_id", "distance", "errors", "start", "end"])
                yield frame.astype({"doc_id": "Int64", "item_id": "Int64"})

        part = rows.mapInPandas(search, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def keep_unleaked(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """``docs`` without the rows that hold a passage of the benchmark; all other rows stay as they are."""
    kept = docs
    for block in _blocks(benchmark, "item_id", "text"):
        name = free_name(kept.columns, "leaked")
        leaked = _leaked(docs.sparkSession.sparkContext.broadcast(block), rate)
        kept = kept.withColumn(name, leaked(F.col("text"))).where(~F.col(name)).drop(name)
    return kept


def _leaked(held, rate: float):
    @F.pandas_udf("boolean")
    def leaked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(held.value, rate)
        for batch in batches:
            yield pd.Series([bool(matcher.find(t)) for t in batch], dtype=bool)

    return leaked


def benchmark_of(docs: DataFrame, sf_dir: str) -> DataFrame:
    return table(docs.sparkSession, sf_dir, "benchmark")
