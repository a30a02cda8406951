"""Periodic runs of words, from maximal pairs.

A pair of positions (i, j) with the same words from each on, as long as ``l`` words, is maximal
if the words before and after differ. If its distance ``p = j - i`` is at most ``l / 3``, then
the stretch of ``p + l`` words from i has period p, holds it four times or more, and no neighbouring word
keeps it: a maximal pair within these length constraints *is* a run, and nothing has to be extended.
Pairs at a multiple of the smallest period give the same stretch; the smallest distance stays.

Suffixes are ordered by prefix doubling over a whole batch of texts at once (numpy), and only where
four words repeat in a text. The LCP intervals are then visited bottom-up. Every interval
keeps the positions below it in text order, whole and as one list for each word to the left
(its class). Where two subtrees meet at LCP ``l``, each position of the smaller looks into the larger
for positions of other classes at a distance of at most ``l / 3``. Such positions lie in arithmetic
progressions with one left word for all but the first, so the lists' counts tell whether there are any,
and those stand at the end of the window: no same-class stretch is walked through.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS, LEAST_EXPONENT = 6, 4
LEAST_LCP = 5  # p + l >= 6 and l >= 3 p leave no pair below
BATCH_WORDS = 200_000  # words ordered at once; a longer text is ordered alone
RUNS = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"

Rewrite = Callable[["int | None", list[bytes]], list[bytes]]


def split_words(text: bytes | None) -> list[bytes]:
    """Words between space and \\t \\n \\v \\f \\r, as UTF-8 bytes (bytes.split cuts at just these six)."""
    return (text or b"").split()


# --- suffix order --------------------------------------------------------------------------

def word_ids(texts: list[list[bytes]]) -> np.ndarray:
    """Word numbers of all texts in a row. Texts share no number, so nothing matches across them."""
    ids: list[int] = []
    base = 0
    for words in texts:
        seen: dict[bytes, int] = {}
        ids += [seen.setdefault(w, base + len(seen)) for w in words]
        base += len(seen)
    return np.array(ids, np.int64)


def suffix_order(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, lcp): suffixes whose first four words repeat in their text, in suffix order, and the number of
    words that each shares with the one before it (0 for the first). ``ends``: end of each position's text."""
    n = len(ids)
    none = np.zeros(0, np.int64)
    if n == 0:
        return none, none
    counts = np.bincount(ids)
    rank = (np.cumsum(counts) - counts)[ids]  # a group's rank: where it starts in suffix order
    live = np.flatnonzero(counts[ids] > 1)
    live = live[np.argsort(rank[live], kind="stable")]
    levels, width, kept = [rank.astype(np.int32)], 1, live
    while live.size:
        after = live + width
        inside = after < ends[live]
        following = np.where(inside, rank[np.where(inside, after, 0)] + 1, 0)
        old = rank[live]
        key = old * (n + 1) + following
        order = np.argsort(key, kind="stable")
        live, key, old = live[order], key[order], old[order]
        at = np.arange(len(live))
        new_group = np.concatenate([[True], old[1:] != old[:-1]])
        new_part = np.concatenate([[True], key[1:] != key[:-1]])
        first = np.maximum.accumulate(np.where(new_group, at, 0))
        part = np.maximum.accumulate(np.where(new_part, at, 0))
        rank[live] = old + part - first
        levels.append(rank.astype(np.int32))
        width *= 2
        alone = new_part & np.concatenate([new_part[1:], [True]])
        live = live[~alone]
        if width == 4:
            kept = live
    if width < 4:
        return none, none
    kept = kept[np.argsort(rank[kept], kind="stable")]
    lcp = np.zeros(len(kept), np.int64)
    a, b = kept[:-1].copy(), kept[1:].copy()
    shared = np.zeros(max(0, len(kept) - 1), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        held, step = levels[level], 1 << level
        inside = (a < n) & (b < n)
        same = inside & (held[np.where(inside, a, 0)] == held[np.where(inside, b, 0)])
        shared += same * step
        a += same * step
        b += same * step
    lcp[1:] = shared
    return kept, lcp


# --- maximal pairs -------------------------------------------------------------------------

class _Node:
    """Positions below an LCP interval: in text order, and by the word to their left."""

    __slots__ = ("all", "classes")

    def __init__(self, position: int, left: int):
        self.all, self.classes = [position], {left: [position]}


def _join(one: _Node, two: _Node, lcp: int, left: list[int], runs: dict[tuple[int, int], int]) -> _Node:
    """Pairs between two subtrees that meet at ``lcp``, then one node of both."""
    small, large = (one, two) if len(one.all) < len(two.all) else (two, one)
    near, every, classes = lcp // 3, large.all, large.classes
    for x in small.all:
        lo, hi = bisect_left(every, x - near), bisect_right(every, x + near)
        if lo == hi:
            continue
        own = classes.get(left[x])
        others = hi - lo - (bisect_right(own, x + near) - bisect_left(own, x - near) if own else 0)
        at = lo
        while others:  # the others come first in the window
            y = every[at]
            at += 1
            if left[y] != left[x]:
                others -= 1
                start, period = (x, y - x) if x < y else (y, x - y)
                key = (start, start + period + lcp)
                if period < runs.get(key, period + 1):
                    runs[key] = period
    if len(small.all) * 8 < len(every):
        for x in small.all:
            insort(every, x)
    else:
        every += small.all
        every.sort()
    for word, positions in small.classes.items():
        own = classes.get(word)
        if own is None:
            classes[word] = positions
        elif len(positions) * 8 < len(own):
            for x in positions:
                insort(own, x)
        else:
            own += positions
            own.sort()
    return large


def _periodic(positions: np.ndarray, lcp: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which groups hold two positions at most a third of the group's longest LCP apart; others have no run."""
    groups = int(group[-1]) + 1
    longest = np.zeros(groups, np.int64)
    np.maximum.at(longest, group, lcp)
    order = np.lexsort((positions, group))
    p, g = positions[order], group[order]
    gaps, same = np.diff(p), g[1:] == g[:-1]
    near = same & (gaps <= longest[g[1:]] // 3)
    found = np.zeros(groups, bool)
    found[g[1:][near]] = True
    return found


def maximal_runs(ids: np.ndarray, ends: np.ndarray, starts: np.ndarray) -> dict[tuple[int, int], int]:
    """(start, end) -> smallest period, over all texts of the batch (positions count through the batch)."""
    runs: dict[tuple[int, int], int] = {}
    positions, lcp = suffix_order(ids, ends)
    if positions.size < 2:
        return runs
    joined = lcp >= LEAST_LCP
    group = np.cumsum(~joined) - 1
    wanted = _periodic(positions, np.where(joined, lcp, 0), group)[group]
    if not wanted.any():
        return runs
    before = np.where(np.arange(len(ids)) > starts, np.concatenate([[-1], ids[:-1]]), -1).tolist()
    positions, lcp, joined = positions[wanted].tolist(), lcp[wanted].tolist(), joined[wanted].tolist()
    stack: list[tuple[int, _Node]] = []
    node = None
    for x, shared, inside in zip(positions, lcp, joined):
        if node is not None:
            floor = shared if inside else 0
            while stack and stack[-1][0] >= max(floor, 1):
                level, other = stack.pop()
                node = _join(other, node, level, before, runs)
            if inside:
                stack.append((shared, node))
        node = _Node(x, before[x])
    while stack:
        level, other = stack.pop()
        node = _join(other, node, level, before, runs)
    return runs


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of each text's runs, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    stops = np.cumsum(sizes)
    begins = stops - sizes
    runs = maximal_runs(word_ids(texts), np.repeat(stops, sizes), np.repeat(begins, sizes))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    owner = np.searchsorted(stops, [start for start, _ in runs], side="right").tolist()
    for ((start, end), period), text in zip(runs.items(), owner):
        out[text].append((start - int(begins[text]), end - start, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


# --- operator ------------------------------------------------------------------------------

def _table(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
    runs = runs_of(texts)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
    flat = np.array([r for found in runs for r in found], np.int64).reshape(-1, 3)
    struct = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], ["start", "length", "period"])
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), struct),
         pa.array([b" ".join(collapse(t, r)) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string())],
        ["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, rewrite: Rewrite | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of ``docs``: its runs and its text without their repeats.

    ``rewrite(doc_id, words)``, where given, gives the words to search in place of the text's own. Every text is
    searched whole in the task that reads it; nothing moves.

    Defined cases: a NULL or empty text has no words, no run and collapses to the empty string; a text
    of any length is ordered in memory proportional to it; repeated rows and ids are judged row by row; a NULL
    doc_id is kept; an empty table gives no rows; other columns are ignored.
    """
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, held, size = [], [], batch.column(1), 0
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                words = split_words(held[i].as_py())
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                ids.append(doc_id)
                texts.append(words)
                size += len(words)
                if size >= BATCH_WORDS:
                    yield _table(ids, texts)
                    ids, texts, size = [], [], 0
            if ids:
                yield _table(ids, texts)

    rows = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).cast("binary").alias("t"))
    return rows.mapInArrow(search, RUNS)


def plant_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by id, repeats a stretch of its words from some word on to the end."""
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    stretch = words[a:a + p]
    return words[:a] + (stretch * (-(-(n - a) // p)))[:n - a]


def report(found: DataFrame) -> DataFrame:
    """One row a document: number of runs, its longest run (ties: smallest start, then period), digests."""
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    held = found.withColumn("best", best)
    period = -F.col("best.p")
    return held.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.s")).alias("start"), "best.length",
                       period.alias("period"), F.floor(F.expr("1000 * best.length div -best.p")).cast("bigint").alias("exponent_milli"),
                       F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
