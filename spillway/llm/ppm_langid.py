"""Language ID by prediction by partial matching.

Each language gets a variable-order context tree over the bytes of its lower-cased training
texts, with contexts of up to ORDER bytes. A symbol seen n times in a context with N symbols, D
of them distinct, costs -log2(n / (N + D)) bits there; a new symbol costs the escape,
-log2(D / (N + D)), and is coded in the next shorter context, down to 8 bits for any byte
(method C, no exclusions, so that costs are a table). The statistics are frozen after training;
a text's exact code length under each language decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import held_out

ORDER = 3
MAX_CODES = 1 << 17  # four-byte codes a language's model keeps at most: its most frequent ones, down to a power of two
HELD_CODES = 1 << 21  # codes that a counting task holds before it hands them on
CHUNK = 1 << 18  # bytes counted or scored at once
PAD = b"\0" * ORDER


class Index:
    """Positions of uint32 keys in a fixed key set, by open addressing; -1 for absent keys."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.key = np.zeros(1 << self.bits, np.uint32)
        place, rest = self._hash(keys), np.arange(len(keys), dtype=np.int32)
        while len(rest):
            free = self.slot[place] < 0
            self.slot[place[free]] = rest[free]  # of several keys for a slot, the last stays
            won = self.slot[place] == rest
            self.key[place[won]] = keys[rest[won]]
            place, rest = (place[~won] + 1) & ((1 << self.bits) - 1), rest[~won]

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        place = self._hash(keys)
        out = self.slot[place]
        todo = np.flatnonzero((out >= 0) & (self.key[place] != keys))
        place = place[todo]
        while len(todo):
            place = (place + 1) & ((1 << self.bits) - 1)
            got = self.slot[place]
            done = (got < 0) | (self.key[place] == keys[todo])
            out[todo[done]] = got[done]
            todo, place = todo[~done], place[~done]
        return out


def text_bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def _codes(raw: np.ndarray) -> np.ndarray:
    """The last four bytes at each position from the fourth on, as uint32."""
    b = raw.astype(np.uint32)
    return (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of all parts, each code once and in order."""
    if not parts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.zeros(len(keys), np.int64)
    np.add.at(counts, inverse, np.concatenate([c for _, c in parts]))
    return keys, counts


def count_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct four-byte codes (context and symbol) of the whole texts and their counts, in chunks of bounded size."""
    parts = [PAD + text_bytes(t) for t in texts]
    flat = np.frombuffer(b"".join(parts), np.uint8)
    symbol = np.ones(len(flat), bool)
    starts = np.cumsum([0] + [len(p) for p in parts[:-1]]) if parts else np.zeros(0, np.int64)
    for i in range(len(PAD)):
        symbol[starts + i] = False
    got = []
    for a in range(0, len(flat) - 3, CHUNK):
        z = min(a + CHUNK, len(flat) - 3)
        got.append(np.unique(_codes(flat[a:z + 3])[symbol[a + 3:z + 3]], return_counts=True))
    return _merged(got)


class Model:
    """Frozen cost tables of all languages. ``counts``: for each language the result of count_codes()."""

    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.languages = languages
        n = len(languages)
        orders = []  # for each order: the keys seen in any language, and counts (keys, languages)
        for order in range(ORDER + 1):
            mask = np.uint32((1 << (8 * (order + 1))) - 1)
            keys = np.unique(np.concatenate([k & mask for k, _ in counts] + [np.zeros(0, np.uint32)]))
            table = np.zeros((len(keys), n))
            for lang, (k, c) in enumerate(counts):
                np.add.at(table[:, lang], np.searchsorted(keys, k & mask), c)
            orders.append((keys, table))
        self.index, self.cost, self.escape, self.context = [], [], [], []
        for order, (keys, table) in enumerate(orders):
            above = keys >> np.uint32(8)  # the context alone
            contexts, of = np.unique(above, return_inverse=True)
            total, kinds = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
            np.add.at(total, of, table)
            np.add.at(kinds, of, table > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0)
                hit = -np.log2(table / (total + kinds)[of])
            lower = self._lower(order, keys, n)
            cost = np.where(table > 0, hit, escape[of] + lower) if len(keys) else np.zeros((0, n))
            self.index.append(Index(keys))
            self.cost.append(cost.astype(np.float32))
            self.context.append(Index(contexts))
            # the last row: a context never seen costs nothing to leave
            self.escape.append(np.vstack([escape, np.zeros((1, n))]).astype(np.float32))

    def _lower(self, order: int, keys: np.ndarray, n: int) -> np.ndarray:
        """Costs of the keys' symbols one order down."""
        if order == 0:
            return np.full((len(keys), n), 8.0)
        return self._at(order - 1, keys & np.uint32((1 << (8 * order)) - 1))

    def _at(self, order: int, keys: np.ndarray) -> np.ndarray:
        """Bits for each key's symbol in its context of ``order`` bytes, for every language."""
        row = self.index[order].find(keys)
        out = self.cost[order][row] if len(self.cost[order]) else np.zeros((len(keys), len(self.languages)), np.float32)
        miss = np.flatnonzero(row < 0)
        if len(miss):
            k = keys[miss]
            out[miss] = self.escape[order][self.context[order].find(k >> np.uint32(8))] + self._lower(order, k, out.shape[1])
        return out

    def lengths(self, texts: list[str | None]) -> np.ndarray:
        """(texts, languages): exact code lengths in bits. Whole texts, in chunks of bounded size."""
        parts = [PAD + text_bytes(t or "") for t in texts]
        sizes = np.array([len(p) for p in parts])
        owner_end = np.cumsum(sizes)
        flat = np.frombuffer(b"".join(parts), np.uint8)
        total = np.zeros((len(texts), len(self.languages)))
        for a in range(0, len(flat) - 3, CHUNK):
            z = min(a + CHUNK, len(flat) - 3)
            at = np.arange(a + 3, z + 3)  # the symbol's position
            owner = np.searchsorted(owner_end, at, "right")
            real = at - (owner_end[owner] - sizes[owner]) >= len(PAD)
            if not real.any():
                continue
            cost = self._at(ORDER, _codes(flat[a:z + 3])[real]).astype(np.float64)
            owner = owner[real]
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            total[owner[first]] += np.add.reduceat(cost, first, axis=0)
        return total


def _count_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(l, k, c): the codes of a task's texts by language, handed on whenever HELD_CODES are held."""
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def out() -> Iterator[pd.DataFrame]:
        for lang, parts in held.items():
            keys, counts = _merged(parts)
            for a in range(0, len(keys), CHUNK):
                yield pd.DataFrame({"l": lang, "k": keys[a:a + CHUNK].astype(np.int64), "c": counts[a:a + CHUNK]})
        held.clear()

    for pdf in batches:
        for lang, own in pdf.groupby("l", sort=False):
            held[lang] = [_merged([*held.get(lang, []), count_codes(own["t"].tolist())])]
        if sum(len(parts[0][0]) for parts in held.values()) > HELD_CODES:
            yield from out()
    yield from out()


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          fold: tuple[int, int] = (3, 1), max_codes: int = MAX_CODES) -> Model:
    """Model of all labelled documents outside the held-out fold, their texts whole.

    Every task counts the four-byte codes of its texts by language, and the counts are summed by (language, code). A
    model is broadcast, so a language keeps at most ``max_codes`` codes: those seen at least as often as the
    smallest power of two that so many reach (of one power with more, a share by hash). A language without a single byte of text is not learned."""
    part, out = fold
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & (F.length(text_col) > 0)
                      & ~held_out(F.col(id_col), part, out))
    rows = rows.select(F.col(lang_col).alias("l"), F.col(text_col).alias("t"))
    counted = rows.mapInPandas(_count_task, "l string, k bigint, c bigint").groupBy("l", "k").agg(F.sum("c").alias("c"))
    counted = pin(counted, "language-codes")
    bits = counted.groupBy("l", F.length(F.bin("c")).alias("b")).count().orderBy("l", F.desc("b")).collect()  # 63 rows a language at most
    least: dict[str, tuple[int, int]] = {}
    total: dict[str, int] = {}
    for row in bits:
        total[row["l"]] = total.get(row["l"], 0) + row["count"]
        if total[row["l"]] <= max_codes or row["l"] not in least:  # the highest power alone may have too many: then a share of it
            least[row["l"]] = (1 << (row["b"] - 1), -(-total[row["l"]] // max_codes))
    if not least:
        return Model([], [])
    bounds = docs.sparkSession.createDataFrame([(lang, *bound) for lang, bound in least.items()], "l string, least bigint, every bigint")
    kept = counted.join(F.broadcast(bounds), "l")  # one row a language
    kept = kept.where((F.col("c") >= F.col("least")) & (F.pmod(F.xxhash64("k"), F.col("every")) == 0))
    table = kept.select("l", "k", "c").toArrow().to_pandas().sort_values(["l", "k"])
    parts = [(str(lang), own["k"].to_numpy(np.uint32), own["c"].to_numpy(np.int64)) for lang, own in table.groupby("l")]
    return Model([lang for lang, _, _ in parts], [(k, c) for _, k, c in parts])


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
            fold: tuple[int, int] = (3, 1)) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_byte) for each row of ``docs``.

    score: the winner's share of 2^-length over all languages. Defined cases: a NULL text, one without
    a letter and any text under a model without languages give ``und`` with score 0; of equal lengths
    the alphabetically first language wins; repeated rows score alike; an empty table gives no
    rows; further columns are ignored; long texts are read whole.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, bits double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m: Model = held.value
        for batch in batches:
            texts = batch.tolist()
            if not m.languages or not texts:
                yield pd.DataFrame({"lang": ["und"] * len(texts), "score": 0.0, "bits": 0.0})
                continue
            bits = m.lengths(texts)
            best = bits.argmin(1)
            gap = np.minimum(bits - bits[np.arange(len(best)), best][:, None], 1000)
            share = 1 / np.exp2(-gap).sum(1)
            letter = np.array([t is not None and any(map(str.isalpha, t)) for t in texts], bool)
            size = np.array([len(text_bytes(t or "")) for t in texts])
            yield pd.DataFrame({"lang": np.where(letter, np.array(m.languages, object)[best], "und"),
                                "score": np.where(letter, share, 0.0), "bits": bits.min(1) / np.maximum(size, 1)})

    out: Column = score(F.col(text_col))
    return (docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col), *fold).alias("held_out"), out.alias("p"))
            .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), "p.score", F.col("p.bits").alias("bits_per_byte")))
