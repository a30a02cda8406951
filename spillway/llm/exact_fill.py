"""Best-fit packing with exact complements.

How full sequences get depends on lengths alone, and a length is at most the sequence length. So the
plan is made on a histogram (at most ``limit`` rows, whatever the corpus): for the longest length that is
left, the gap beside it is looked up in an index of single lengths, of pair sums and of triple sums, in this
order; a combination that fills the gap exactly is consumed as often as all of its lengths are still
available. Where nothing fills the gap, the longest length that fits is added and the smaller gap is looked
up. What no combination completes is packed best-fit: longest first, into the sequence with the least room.

The plan is a list of patterns (lengths side by side, and how many sequences look like this). A pattern's slots take
pieces of one length by their number among all pieces of that length, so a piece finds its sequence and offset by
one binary search. Texts never move: the task that reads a document tokenizes it, and only lengths and
numbers are shuffled. Pieces of one length are numbered by (block, number in the block), where a block is what one
task wrote, so a length that holds a third of all pieces is spread over its blocks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin
from .packing import tokenizer

SEQUENCE = 4096
END_ID = 1
TEXTS = 512  # texts tokenized at once
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, block bigint, nth bigint"

Pattern = tuple[tuple[int, ...], int]  # lengths side by side, number of sequences


# --- plan ----------------------------------------------------------------------------------

class SumIndex:
    """Which available lengths add up to a sum: alone, as a pair or as a triple.

    An answer is remembered by its sum and looked for again only once its lengths have run out; a sum that
    had no answer has none later, for lengths are only ever used up.
    """

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64)
        self.limit = len(counts) - 1
        self.memory: dict[tuple[int, int], tuple[int, ...] | None] = {}

    def has(self, lengths: tuple[int, ...]) -> bool:
        return all(self.left[x] >= n for x, n in Counter(lengths).items())

    def _pair(self, total: int) -> tuple[int, ...] | None:
        small = np.arange(max(1, total - self.limit), total // 2 + 1)
        open_ = (self.left[small] > 0) & (self.left[total - small] > (small * 2 == total))
        at = np.flatnonzero(open_)
        return (total - int(small[at[0]]), int(small[at[0]])) if at.size else None  # the longest length it can use

    def _triple(self, total: int) -> tuple[int, ...] | None:
        for longest in np.flatnonzero(self.left[:total]).tolist()[::-1]:
            if longest * 3 < total:
                return None
            self.left[longest] -= 1
            rest = self._pair(total - longest) if total - longest <= 2 * longest else None
            self.left[longest] += 1
            if rest is not None:
                return (longest, *rest)
        return None

    def fill(self, gap: int) -> tuple[int, ...] | None:
        """Up to three available lengths that add up to ``gap``."""
        if gap == 0:
            return ()
        for size, look in enumerate((lambda g: (g,) if self.left[g] else None, self._pair, self._triple), start=1):
            known = self.memory.get((size, gap), ())
            if known == () or known is not None and not self.has(known):
                known = self.memory[size, gap] = look(gap)
            if known is not None:
                return known
        return None


def plan(counts: np.ndarray) -> list[Pattern]:
    """Patterns that use every length ``x`` exactly ``counts[x]`` times; ``len(counts) - 1`` is the sequence length."""
    index = SumIndex(counts)
    left, limit = index.left, index.limit
    out: list[Pattern] = []
    rest: Counter[int] = Counter()
    longest = limit
    while True:
        while longest and not left[longest]:
            longest -= 1
        if not longest:
            break
        lengths, gap, filled = [longest], limit - longest, False
        left[longest] -= 1
        while True:  # until the gap is filled exactly, or nothing fits
            found = index.fill(gap)
            if found is not None:
                lengths += found
                filled = True
                break
            fits = np.flatnonzero(left[:gap + 1])
            if not fits.size:
                break
            lengths.append(int(fits[-1]))
            left[fits[-1]] -= 1
            gap -= int(fits[-1])
        left[longest] += 1
        for x in lengths[1:len(lengths) - (len(found) if found else 0)]:
            left[x] += 1
        if filled:
            uses = Counter(lengths)
            times = min(int(left[x]) // n for x, n in uses.items())
            for x, n in uses.items():
                left[x] -= n * times
            out.append((tuple(lengths), times))
        else:  # no exact completion of this length is left: best fit
            rest[longest] += int(left[longest])
            left[longest] = 0
    return out + best_fit(rest, limit)


def best_fit(counts: Counter[int], limit: int) -> list[Pattern]:
    """Longest first into the sequence with the least room that holds it, on counts: equal sequences are one pattern."""
    open_: defaultdict[tuple[int, ...], int] = defaultdict(int)
    rooms: list[tuple[int, tuple[int, ...]]] = []  # (room, lengths) of the keys of open_, sorted

    def put(lengths: tuple[int, ...], times: int) -> None:
        if times:
            if lengths not in open_:
                insort(rooms, (limit - sum(lengths), lengths))
            open_[lengths] += times

    for x in sorted(counts, reverse=True):
        n = counts[x]
        while n:
            at = bisect_left(rooms, (x, ()))
            if at == len(rooms):  # none has room: new ones, each with as many as it holds
                each = limit // x
                put((x,) * each, n // each)
                if n % each:
                    put((x,) * (n % each), 1)
                n = 0
                continue
            room, lengths = rooms[at]
            each = min(room // x, n)
            times = min(open_[lengths], n // each)
            open_[lengths] -= times
            if not open_[lengths]:
                del open_[lengths], rooms[at]
            put(lengths + (x,) * each, times)
            n -= each * times
    return list(open_.items())


def slots(patterns: list[Pattern]) -> np.ndarray:
    """(length, first, sequence, offset) rows, sorted: pieces ``first``, ``first + 1``, … of a length, up to the next
    row's, lie at ``offset`` of ``sequence``, ``sequence + 1``, …"""
    used: Counter[int] = Counter()
    rows, sequence = [], 0
    for lengths, times in patterns:
        offset = 0
        for x in lengths:
            rows.append((x, used[x], sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


# --- operator ------------------------------------------------------------------------------

def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = SEQUENCE,
           end_id: int = END_ID) -> DataFrame:
    """PIECES of each row of ``docs``, in the task that reads it; ``nth`` counts a length within the task's block."""
    columns = [c.split()[0] for c in PIECES.split(", ")]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = tokenizer(path)
        block = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        end = np.array([end_id], "<u4")
        for batch in batches:
            out: list[tuple] = []
            for at in range(0, len(batch), TEXTS):
                part = batch[at:at + TEXTS]
                for doc_id, ids in zip(part["i"], words.encode(part["t"].tolist())):
                    ids = np.concatenate([ids.astype("<u4"), end])
                    for k, start in enumerate(range(0, len(ids), limit)):
                        own = ids[start:start + limit]
                        n = len(own)
                        out.append((doc_id, k, start, n, zlib.crc32(own.tobytes()), block, seen[n]))
                        seen[n] += 1
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    rows = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t"))
    return rows.mapInPandas(cut, PIECES)


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = SEQUENCE,
         end_id: int = END_ID) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only a document of more than ``limit`` tokens is cut. Token counts are written to the shared folder once (with the
    block numbers, which a rerun task would deal anew); the driver sees their histogram, at most ``limit`` rows.

    Defined cases: a NULL text counts as empty and gives one piece, the end id alone; repeated rows and ids are
    packed row by row; a NULL doc_id is kept; an empty table gives no rows; other columns are ignored.
    """
    cut = pin(pieces(docs, path, id_col, text_col, limit, end_id), "fill-pieces")
    sizes = pin(cut.groupBy("block", "length").agg(F.count(F.lit(1)).alias("n")), "fill-blocks")
    counts = np.zeros(limit + 1, np.int64)
    for row in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``limit`` rows
        counts[row["length"]] = row["n"]
    table = slots(plan(counts))
    blocks = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("block", "length", F.coalesce(F.sum("n").over(blocks), F.lit(0)).alias("base"))
    numbered = cut.join(bases.hint("merge"), ["block", "length"])  # grows with the blocks: never broadcast
    numbered = numbered.withColumn("nth", F.col("base") + F.col("nth"))
    key = table[:, 0] << 48 | table[:, 1]

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, nth: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(key, length.to_numpy() << 48 | nth.to_numpy(), side="right") - 1
        return pd.DataFrame({"sequence_id": table[at, 2] + nth.to_numpy() - table[at, 1], "offset": table[at, 3]})

    placed = numbered.withColumn("at", place("length", "nth"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
