"""Cross-tokenizer alignment over exact-text duplicates.

Documents are shuffled by their full text, and each distinct text is tokenized by both tokenizers and aligned
once, however many documents hold it. Token ends are byte offsets; where both tokenizers end a token, a
group closes. An A and a B token whose byte ranges overlap are linked. A text keeps its distinct id pairs with their
number; corpus-wide counts are sums of these, weighted by how many documents hold the text.

The counts then come back to the texts in two ways. Pairs with at least a ``FREQUENT``-th of all links are at
most ``FREQUENT`` pairs whatever the corpus: they are sent to the tasks as sorted arrays and looked up in place. Links of
any rarer pair are joined with the table of counts by a shuffle, where no pair is hot, for none has more than that share.
In the same way the measures of texts held by more than a ``COPIED``-th of the documents (fewer than ``COPIED``
texts) are broadcast to the documents, and all others are joined by digest.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin

FREQUENT = 1 << 18
COPIED = 1 << 10
PAIR_BITS = 31  # id pairs fit: 50,257 * 32,000 < 2^31
BATCH_BYTES = 1 << 20  # text bytes aligned at once; a longer text is aligned alone
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = ("text_key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
           "pairs array<bigint>")
LOOKED_UP = ("text_key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
             "best bigint, total bigint, rare array<bigint>")


# --- the two tokenizers --------------------------------------------------------------------

class Tokenizers:
    """A (byte-level ranks) and B (pieces with byte fallback): ids, and the bytes of each id."""

    def __init__(self, ranks_path: str, pattern: str, pieces_path: str):
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.a = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.n_a, self.n_b = max(ranks.values()) + 1, self.b.get_piece_size()
        self.a_bytes = [b""] * self.n_a
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b_bytes = [self._piece(i) for i in range(self.n_b)]
        self.a_size = np.array([len(t) for t in self.a_bytes])
        self.b_size = np.array([len(t) for t in self.b_bytes])
        self.a_text = np.array([f"{i}{end}" for end in ",|" for i in range(self.n_a)], object)
        self.b_text = np.array([f"{i}{end}" for end in ",;" for i in range(self.n_b)], object)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(A ids, B ids) of each text; both empty where the tokens do not spell a space and the text."""
        out = []
        none = np.zeros(0, np.int64)
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            a = self.a.encode_ordinary(" " + text) if text else []
            spelled = b" " + text.encode()
            same = text and b"".join(map(self.a_bytes.__getitem__, a)) == spelled == b"".join(map(self.b_bytes.__getitem__, b))
            out.append((np.array(a, np.int64), np.array(b, np.int64)) if same else (none, none))
        return out


_LOADED: dict[tuple[str, str, str], Tokenizers] = {}


def load(paths: tuple[str, str, str]) -> Tokenizers:
    if paths not in _LOADED:
        _LOADED[paths] = Tokenizers(*paths)
    return _LOADED[paths]


def default_tokenizers() -> tuple[str, str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")


# --- alignment of a batch ------------------------------------------------------------------

def align(tokenizers: Tokenizers, texts: list[str]) -> dict[str, list]:
    """Per text: MEASURES, the groups as ``a1,a2|b1;…`` and the distinct pairs as ``times << PAIR_BITS | pair``.

    All texts are aligned in one row of bytes: both tokenizers end a token at the end of each text, so no
    group and no link crosses it.
    """
    ids = tokenizers.encode(texts)
    cut_a = np.cumsum([0, *(len(a) for a, _ in ids)])
    cut_b = np.cumsum([0, *(len(b) for _, b in ids)])
    a, b = np.concatenate([x for x, _ in ids]), np.concatenate([x for _, x in ids])
    end_a, end_b = np.cumsum(tokenizers.a_size[a]), np.cumsum(tokenizers.b_size[b])
    size = int(end_a[-1]) if len(a) else 0
    ends_a, ends_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
    ends_a[end_a] = True
    ends_b[end_b] = True
    close_a, close_b = ends_b[end_a], ends_a[end_b]  # tokens that close a group
    group_a, group_b = np.cumsum(close_a) - close_a, np.cumsum(close_b) - close_b

    passed = np.cumsum(ends_b)  # B tokens that end at or before a byte
    first = passed[end_a - tokenizers.a_size[a]]
    count = passed[end_a - 1] + 1 - first
    links = np.concatenate([[0], np.cumsum(count)])
    partner = np.arange(links[-1]) + np.repeat(first - links[:-1], count)
    pair = np.repeat(a, count) * tokenizers.n_b + b[partner]
    text = np.repeat(np.arange(len(texts)), links[cut_a[1:]] - links[cut_a[:-1]])
    key = np.sort(text << PAIR_BITS | pair)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.concatenate([starts, [len(key)]]))
    packed = times << PAIR_BITS | key[starts] & ((1 << PAIR_BITS) - 1)
    cut_pairs = np.searchsorted(key[starts] >> PAIR_BITS, np.arange(len(texts) + 1))

    # the groups in order: a group's A ids, then its B ids, each with the mark that follows it
    b_before = np.concatenate([[0], np.flatnonzero(close_b) + 1])
    a_upto = np.flatnonzero(close_a) + 1
    words = np.empty(len(a) + len(b), object)
    words[np.arange(len(a)) + b_before[group_a]] = tokenizers.a_text[a + tokenizers.n_a * close_a]
    words[np.arange(len(b)) + a_upto[group_b]] = tokenizers.b_text[b + tokenizers.n_b * close_b]
    words = words.tolist()
    cut = (cut_a + cut_b).tolist()
    closed = np.concatenate([[0], np.cumsum(close_a)])
    return {"n_a": np.diff(cut_a), "n_b": np.diff(cut_b), "n_groups": closed[cut_a[1:]] - closed[cut_a[:-1]],
            "n_links": links[cut_a[1:]] - links[cut_a[:-1]],
            "groups": ["".join(words[s:e])[:-1] for s, e in zip(cut[:-1], cut[1:])],
            "pairs": (cut_pairs, packed)}


def _lists(cuts: np.ndarray, flat: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat.astype(np.int64)))


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def aligned_texts(docs: DataFrame, paths: tuple[str, str, str], text_col: str = "text", digest: bool = False) -> DataFrame:
    """ALIGNED: one row for each distinct text that is not NULL or empty; ``digest`` keeps of ``groups`` only the SHA-256 ('' of none)."""
    texts = docs.select(F.col(text_col).alias("t")).where(F.length("t") > 0).groupBy("t").agg(F.count(F.lit(1)).alias("copies"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = load(paths)

        def rows(held: list[tuple[bytes, int, str]]) -> pa.RecordBatch:
            keys, copies, own = zip(*held)
            got = align(both, list(own))
            groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in got["groups"]] if digest else got["groups"]
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(copies, pa.int64()), *(pa.array(got[m], pa.int64()) for m in MEASURES),
                 pa.array(groups, pa.string()), _lists(*got["pairs"])],
                ["text_key", "copies", *MEASURES, "groups", "pairs"])

        for batch in batches:
            held, size = [], 0
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py()
                held.append((batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), text))
                size += len(text)
                if size >= BATCH_BYTES:
                    yield rows(held)
                    held, size = [], 0
            if held:
                yield rows(held)

    return texts.select(text_key(F.col("t")).alias("k"), "copies", "t").mapInArrow(run, ALIGNED)


# --- corpus-wide counts --------------------------------------------------------------------

def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """(pair, n, best): links of each id pair over the corpus; ``best``: none with this B id has more."""
    each = aligned.select("copies", F.explode("pairs").alias("x"))
    counts = pin(each.groupBy(F.col("x").bitwiseAND(F.lit((1 << PAIR_BITS) - 1)).alias("pair"))
                 .agg(F.sum(F.shiftright("x", PAIR_BITS) * F.col("copies")).alias("n")), "pair-counts")
    b = F.col("pair") % n_b
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))  # at most one row for each id of B
    return counts.withColumn("b", b).join(F.broadcast(most), "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _look_up(aligned: DataFrame, frequent: DataFrame) -> DataFrame:
    """LOOKED_UP: sums over the links of frequent pairs, and the other links as they are."""
    held = frequent.orderBy("pair").toPandas()  # at most FREQUENT rows
    known, n = held["pair"].to_numpy(np.int64), held["n"].to_numpy(np.int64)
    best = held["best"].to_numpy(np.int64)
    known, n, best = np.append(known, 1 << PAIR_BITS), np.append(n, 0), np.append(best, 0)  # a last pair that no link has

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(7)
            cuts = column.offsets.to_numpy().astype(np.int64)
            packed = column.values.to_numpy()[cuts[0]:cuts[-1]]
            cuts = cuts - cuts[0]
            pair, times = packed & ((1 << PAIR_BITS) - 1), packed >> PAIR_BITS
            at = np.searchsorted(known, pair)
            hit = known[at] == pair

            def sums(values: np.ndarray) -> pa.Array:
                running = np.concatenate([[0], np.cumsum(values)])
                return pa.array(running[cuts[1:]] - running[cuts[:-1]], pa.int64())

            missed = np.concatenate([[0], np.cumsum(~hit)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:7], sums(times * best[at] * hit), sums(times * n[at] * hit), _lists(missed[cuts], packed[~hit])],
                [c.split()[0] for c in LOOKED_UP.split(", ")])

    return aligned.mapInArrow(run, LOOKED_UP)


def measures(aligned: DataFrame, n_b: int) -> DataFrame:
    """One row for each distinct text: text_key, copies, MEASURES, groups, n_best, count_sum. ``aligned``: a written table."""
    counts = pin(pair_counts(aligned, n_b), "pair-table")
    links = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    often = F.col("n") * FREQUENT >= links
    looked = pin(_look_up(aligned, counts.where(often)), "text-sums")
    rare = looked.select("text_key", F.explode("rare").alias("x")).select(
        "text_key", F.col("x").bitwiseAND(F.lit((1 << PAIR_BITS) - 1)).alias("pair"), F.shiftright("x", PAIR_BITS).alias("times"))
    rest = rare.join(counts.where(~often), "pair").groupBy("text_key").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more"))
    none = F.lit(0).cast("bigint")
    return looked.drop("rare").join(rest, "text_key", "left").select(
        "text_key", "copies", *MEASURES, "groups", (F.col("best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("total") + F.coalesce("more", none)).alias("count_sum"))


# --- operator ------------------------------------------------------------------------------

def align_documents(docs: DataFrame, paths: tuple[str, str, str], id_col: str = "doc_id", text_col: str = "text",
                    digest: bool = False) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    ``paths``: the ranks file and pattern of A and the model file of B (see Tokenizers). ``digest`` gives the SHA-256 of
    ``groups``, which is about three times the text, in its place.

    Defined cases: a NULL or empty text, and one whose tokens do not spell a space and the text (a text with
    U+2581, for one), has no tokens: zeros and an empty ``groups``; texts of any length are aligned whole; repeated
    rows and ids give a row each, and count as often; a NULL doc_id is kept; an empty table gives no rows; other
    columns are ignored.
    """
    aligned = pin(aligned_texts(docs, paths, text_col, digest), "aligned-texts")
    per_text = pin(measures(aligned, load(paths).n_b), "text-measures")
    keys = pin(docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                           F.when(F.length(text_col) > 0, text_key(F.col(text_col))).alias("text_key")), "document-keys")
    copied = F.col("copies") * COPIED > keys.count()
    columns = [*MEASURES, "n_best", "count_sum"]
    seen = keys.where(F.col("text_key").isNotNull()).join(F.broadcast(per_text.where(copied)), "text_key", "left")
    hot = seen.where(F.col("copies").isNotNull())
    cold = seen.where(F.col("copies").isNull()).select("doc_id", "text_key").join(per_text.where(~copied), "text_key")
    empty = keys.where(F.col("text_key").isNull()).select(
        "doc_id", *[F.lit(0).cast("bigint").alias(c) for c in columns], F.lit("").alias("groups"))
    out = ["doc_id", *columns, "groups"]
    return hot.select(*out).unionByName(cold.select(*out)).unionByName(empty)
