"""Sequence packing along a space-filling curve.

Each document's words are hashed to random signs and summed: a sparse random projection to
``DIMS`` axes. The projected point, on a grid of 2^BITS steps an axis, has a Hilbert key.
Documents are range-sorted by that key (ties by hashed id, so a hot key splits), and
every range packs its documents along the curve, one after another without gaps. The last
tokens of a range fill sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import width

SEQUENCE = 4096
END_ID = 2
DIMS, BITS = 4, 8
MEMO = 400_000  # words whose ids a worker remembers
SEQUENCES_A_RANGE = 1 << 33
HASH_BITS = 30  # of the hashed id, beside the curve key, when ranges are cut
WEIGHT = 2048  # bytes of text for which a key counts once more when ranges are cut
RANGE_BYTES = 64 << 20  # text of a range, above which more ranges are cut
PIECE = 1 << 20  # bytes projected, or new words merged, at once
TEXTS = 512  # texts tokenized at once
PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, hilbert bigint")


# --- the curve -----------------------------------------------------------------------------

def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer points (n, dims) on a grid of 2^bits steps: axes to transposed key, then bits interleaved."""
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(dims):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(on, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[dims - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


_MIX = np.uint64(0x9E3779B97F4A7C15)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * _MIX) ^ (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(17))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_MIX ** i and its inverse modulo 2^64, for i < n at least."""
    size = 1 << max(n, PIECE).bit_length()
    if size not in _POWERS:
        _POWERS.clear()
        inverse = np.uint64(pow(int(_MIX), -1, 1 << 64))
        _POWERS[size] = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, x)]), dtype=np.uint64) for x in (_MIX, inverse))
    return _POWERS[size]


def project(texts: list[str | None]) -> np.ndarray:
    """(n, DIMS) grid points: hashed signs of the words, summed, scaled by the root of their count.

    A text without words lies in the middle. Texts are taken in groups of bounded size, or alone.
    """
    parts, held, size = [], [], 0
    for text in texts:
        held.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size > PIECE // 2:
            parts.append(_project(held))
            held, size = [], 0
    parts.append(_project(held))
    return np.concatenate(parts)


def _hash_words(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Polynomial hash of each word, from running sums over the bytes: every byte counts, and its place in the word.

    Sums are taken over about PIECE bytes at once (a longer word alone), so a long text needs no table of its length.
    """
    h = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + PIECE)))
        begin, end = starts[low], stops[high - 1]
        power, inverse = _powers(int(end - begin))
        running = np.zeros(int(end - begin) + 1, np.uint64)
        np.cumsum(_BYTE[raw[begin:end]] * power[:end - begin], out=running[1:])
        h[low:high] = (running[stops[low:high] - begin] - running[starts[low:high] - begin]) * inverse[starts[low:high] - begin]
        low = high
    return h


def _project(texts: list[bytes]) -> np.ndarray:
    if not texts:
        return np.zeros((0, DIMS), np.int64)
    raw = np.frombuffer(b"".join(b"\n" + t for t in texts) + b"\n", np.uint8)
    space = _SPACE[raw]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    stops = np.flatnonzero(~space[:-1] & space[1:]) + 1
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(starts, begin)
    count = np.diff(first)
    h = _hash_words(raw, starts, stops)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= _MIX
    z = np.empty((len(texts), DIMS))
    for d in range(DIMS):
        ones = np.concatenate([[0], np.cumsum(((h >> np.uint64(63 - d)) & np.uint64(1)).astype(np.int64))])
        z[:, d] = 2 * (ones[first[1:]] - ones[first[:-1]]) - count
    z /= np.sqrt(np.maximum(count, 1))[:, None]  # about normal, whatever the length
    return np.clip((z + 8) * (1 << BITS) / 16, 0, (1 << BITS) - 1).astype(np.int64)


def curve_key(text: Column, mix: Column, bounds: np.ndarray) -> Column:
    """(k, r): the text's Hilbert key with HASH_BITS of ``mix`` below it, and how many of the sorted ``bounds`` are at or below k."""
    @F.pandas_udf("k bigint, r int")
    def keys(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, low in batches:
            k = hilbert(project(texts.tolist())) << HASH_BITS | low.to_numpy()
            yield pd.DataFrame({"k": k, "r": np.searchsorted(bounds, k, side="right").astype(np.int32)})

    return keys(text, mix)


# --- the tokenizer -------------------------------------------------------------------------

class WordTokenizer:
    """Ids of the tokenizer file, word by word.

    The file's pre-tokenizer never crosses white space, so a text's ids are its words' ids in a row, and
    words may be remembered. New words of ASCII and Latin-1 letters and marks are merged by
    the file's own merge ranks through tiktoken, all of a batch in one call; any other word, and any
    that may hold a special token, goes through the tokenizer file itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        symbol = _byte_alphabet()
        # The end-of-word mark is byte 0, which these words lack; it joins its letter before any other merge.
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 0]): 256 + b for b in range(256)}

        def raw(token: str) -> bytes:
            word = token.removesuffix("</w>")
            return bytes(symbol[c] for c in word) + b"\0" * (word != token)

        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            ranks.setdefault(raw(a + b), len(ranks))
        self.ids = np.zeros(len(ranks), np.uint16)
        self.last = np.zeros(len(ranks), bool)
        for token, i in model["vocab"].items():
            if not token.startswith("<|") and (key := raw(token)) in ranks:
                self.ids[ranks[key]] = i
                self.last[ranks[key]] = key.endswith(b"\0")
        self.merge = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.other = re.compile(r"[^\x21-\x7e\xa1-\xff]|<\|").search
        self.memo: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        """Puts the ids of new words into the memo."""
        parts: list[str] = []
        counts: list[int] = []
        plain: list[str] = []
        for w in new:
            if self.other(w):
                self.memo[w] = np.array(self.whole.encode(w, add_special_tokens=False).ids, np.uint16).tobytes()
                continue
            plain.append(w)
            if w.isalpha():
                parts.append(w.lower())
                counts.append(1)
            elif w[-1] in ".," and w[:-1].isalpha():
                parts += (w[:-1].lower(), w[-1])
                counts.append(2)
            else:
                own = self.split(w.lower())
                parts += own
                counts.append(len(own))
        if not plain:
            return
        ranks = self.merge.encode_to_numpy("\0".join(parts) + "\0", disallowed_special=())
        ends = np.flatnonzero(self.last[ranks]) + 1  # after each part
        stops = (2 * ends[np.cumsum(counts) - 1]).tolist()
        ids = self.ids[ranks].tobytes()
        self.memo.update(zip(plain, [ids[a:b] for a, b in zip([0, *stops], stops)]))

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of whole texts (uint16)."""
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        # str.split() also cuts at \x1c to \x1f, which the tokenizer does not take for space
        words = [_WORDS(t) if _ODD(t) else t.split() for t in (t or "" for t in texts)]
        new = list({w for text in words for w in text if w not in memo})
        for at in range(0, len(new), PIECE):
            self._learn(new[at:at + PIECE])
        return [np.frombuffer(b"".join(map(memo.__getitem__, text)), np.uint16) for text in words]


_WORDS = re.compile(r"[^ \t\n\x0b\x0c\r]+").findall
_ODD = re.compile(r"[\x1c-\x1f]").search


def _byte_alphabet() -> dict[str, int]:
    """Character -> byte of the byte-level alphabet: printable bytes as they are, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]


# --- packing -------------------------------------------------------------------------------

def tail_lengths(tokens: int, limit: int = SEQUENCE) -> list[int]:
    """Lengths of the last sequences of a range: the powers of two that add up to ``tokens``, largest first."""
    return [1 << b for b in range(limit.bit_length() - 1, -1, -1) if tokens >> b & 1]


class Packer:
    """Fills sequences with a range's documents in their order; yields rows of PIECES."""

    def __init__(self, first_id: int, limit: int = SEQUENCE):
        self.limit, self.sequence, self.used = limit, first_id, 0
        self.held: list[tuple] = []  # pieces of the open sequence: under ``limit`` tokens

    def add(self, doc_id, ids: np.ndarray, key: int) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            take = min(self.limit - self.used, len(ids) - start)
            self.held.append((doc_id, start, ids[start:start + take], len(ids), key))
            self.used += take
            start += take
            if self.used == self.limit:
                yield from self._close([self.limit])

    def close(self) -> Iterator[tuple]:
        if self.used:
            yield from self._close(tail_lengths(self.used, self.limit))

    def _close(self, lengths: list[int]) -> Iterator[tuple]:
        at, room, held = 0, iter(lengths), self.held
        size = next(room)
        for doc_id, start, ids, total, key in held:
            done = 0
            while done < len(ids):
                if at == size:
                    at, size, self.sequence = 0, next(room), self.sequence + 1
                take = min(size - at, len(ids) - done)
                crc = zlib.crc32(ids[done:done + take].astype("<u4").tobytes())
                yield doc_id, start + done, take, crc, total, self.sequence, at, key
                at, done = at + take, done + take
        self.sequence, self.used, self.held = self.sequence + 1, 0, []


def pack(docs: DataFrame, path: str, ranges: int | None = None, id_col: str = "doc_id", text_col: str = "text",
         limit: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row for each piece of each row of ``docs``: see PIECES. ``path``: the tokenizer file, on every machine.

    Texts move once, sorted by (Hilbert key, hashed id) in ranges cut at quantiles of the keys; every range is packed by one
    task that holds one batch of texts and one open sequence. The range's number is a column of its rows, and
    sequence_id is that number * 2^33 + the sequence's number in the range: unique however Spark joins or
    splits the tasks later, not consecutive. There are as many ranges as the session's shuffle width, and more
    where a range would hold over RANGE_BYTES of text.

    Defined cases: a NULL text counts as empty and gives one piece, the end id alone; a text of
    any length is cut over as many sequences as it needs; repeated rows and ids are packed
    row by row; a NULL doc_id is kept; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t"))
    if ranges is None:
        size = rows.agg(F.sum(F.octet_length("t")).alias("b")).first()["b"] or 0
        ranges = max(width(spark), -(-size // RANGE_BYTES))
    ranged = _in_ranges(rows, ranges).repartitionById(ranges, "r").sortWithinPartitions("r", "k", "i")

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = tokenizer(path)
        packer, own = None, None
        end = np.array([end_id], np.uint16)
        columns = [c.split()[0] for c in PIECES.split(", ")]

        def frame(out: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

        for batch in batches:
            out: list[tuple] = []
            for at in range(0, len(batch), TEXTS):
                part = batch[at:at + TEXTS]
                for i, ids, k, r in zip(part["i"], words.encode(part["t"].tolist()), part["k"], part["r"]):
                    if r != own:
                        out += packer.close() if packer else ()
                        packer, own = Packer(int(r) * SEQUENCES_A_RANGE, limit), r
                    out += packer.add(None if pd.isna(i) else int(i), np.concatenate([ids, end]), k >> HASH_BITS)
                if len(out) > 20_000:
                    yield frame(out)
                    out = []
            yield frame(out)
        if packer:
            yield frame(list(packer.close()))

    return ranged.mapInPandas(fill, PIECES)


def _in_ranges(rows: DataFrame, ranges: int) -> DataFrame:
    """``rows`` (i, t) with the key ``k`` and the range ``r``, a number below ``ranges``.

    Ranges are cut at quantiles of all keys from a sketch (bounded memory in every task and at the driver), taken
    once, so every job and retry agrees. A key counts once for every WEIGHT bytes of its text, so that ranges
    hold about as many bytes: long texts lie together at the rim of the grid.
    """
    mix = F.shiftrightunsigned(F.xxhash64("i"), 64 - HASH_BITS)
    bounds = np.zeros(0, np.int64)
    if ranges > 1:
        cuts = [n / ranges for n in range(1, ranges)]
        weight = (F.coalesce(F.octet_length("t"), F.lit(0)) / WEIGHT).cast("int") + 1
        keys = rows.select(curve_key(F.col("t"), mix, bounds).alias("at"), weight.alias("n")).select(F.explode(F.array_repeat("at.k", F.col("n"))).alias("k"))
        bounds = np.unique(np.array(keys.agg(F.percentile_approx("k", cuts, 20 * ranges).alias("q")).first()["q"] or [], np.int64))
    return rows.withColumn("at", curve_key(F.col("t"), mix, bounds)).select("i", "t", "at.k", "at.r")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


