"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Words and their shapes (letter-case and mark patterns, and whether a word repeats the one before)
are terms, hashed to a fixed number of rows. Every term has a fixed sparse random index
vector; a term's context vector is the sum of the index vectors of its neighbours over the whole
corpus. Sums are whole numbers, so they do not depend on the order of rows or tasks. A
document is the mean of its words' and of its shapes' unit vectors; a two-layer numpy network trained on a
bounded sample of labelled rows scores it, and a temperature fitted on rows that training left out
calibrates the probability.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import held_out

SHAPES, ROWS, DIM, NONZERO = 64, 2048, 32, 4  # rows of shape terms, of all terms; vector length; entries of an index vector
MAX_ROWS = 8000  # labelled documents used to fit the network, by hash order
MEMO = 300_000
SPAN = 1 << 18  # terms held at once
BLOCK = 256  # documents pooled at once
UNIT = 1 << 20  # vectors are rounded to multiples of 1 / UNIT
THRESHOLD = 0.7

_RUNS = re.compile(r"(.)\1+")
_MARKS = re.compile(r"[^\w]")


def index_vectors() -> np.ndarray:
    """(ROWS, DIM) sparse vectors of NONZERO entries +1 or -1, from a fixed seed."""
    rng = np.random.default_rng(8)
    out = np.zeros((ROWS, DIM), np.int64)
    for row in out:
        row[rng.choice(DIM, NONZERO, replace=False)] = rng.choice([-1, 1], NONZERO)
    return out


def shape(word: str) -> str:
    """``Ul`` for Then, ``U!`` for THEN!!: upper, lower, digit and the marks themselves, runs as one."""
    kinds = "".join("U" if c.isupper() else "l" if c.isalpha() else "d" if c.isdigit() else c for c in word)
    return _RUNS.sub(r"\1", kinds)


class Terms(dict):
    """Term rows of texts; a dictionary of the words met so far and their codes."""

    def __missing__(self, word: str) -> int:
        core = _MARKS.sub("", word.lower()) or word
        w = SHAPES + zlib.crc32(core.encode("utf-8", "surrogatepass")) % (ROWS - SHAPES)
        s = 2 + zlib.crc32(shape(word).encode("utf-8", "surrogatepass")) % (SHAPES - 2)
        self[word] = code = w * SHAPES + s
        return code

    def rows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word rows, shape rows, words of each text); a word equal to the one before it has shape row 1."""
        if len(self) > MEMO:
            self.clear()
        words = [(t or "").split() for t in texts]
        size = np.array([len(w) for w in words], np.int64)
        codes = np.fromiter(map(self.__getitem__, chain.from_iterable(words)), np.int64, int(size.sum()))
        w, s = codes // SHAPES, codes % SHAPES
        begin = np.cumsum(size) - size
        again = np.zeros(len(codes), bool)
        again[1:] = codes[1:] == codes[:-1]
        again[begin[(size > 0)]] = False
        return w, np.where(again, 1, s), size


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of bounded length; a longer text alone."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "") // 4
        if size > SPAN:
            yield held
            held, size = [], 0
    if held:
        yield held


def count_pairs(texts: list[str], terms: Terms, beside: np.ndarray, shaped: np.ndarray) -> None:
    """Counts, flat over (term, term): in ``beside`` each word with the word before it and each shape
    with the shape before it, in ``shaped`` each word with its shape."""
    for group in _groups(texts):
        w, s, size = terms.rows(group)
        if not len(w):
            continue
        inside = np.ones(len(w), bool)
        inside[(np.cumsum(size) - size)[size > 0]] = False
        i = np.flatnonzero(inside)
        np.add.at(beside, w[i] * ROWS + w[i - 1], 1)
        np.add.at(beside, s[i] * ROWS + s[i - 1], 1)
        np.add.at(shaped, w * SHAPES + s, 1)


def context_sums(beside: np.ndarray, shaped: np.ndarray, index: np.ndarray) -> np.ndarray:
    """(ROWS, DIM): for each term the sum of its neighbours' index vectors: a word's are the words on both sides and its shape, a shape's the shapes on both sides."""
    near = beside.reshape(ROWS, ROWS).astype(np.float64)
    index = index.astype(np.float64)  # whole numbers, exact below 2^53
    return (near @ index + near.T @ index + shaped.reshape(ROWS, SHAPES).astype(np.float64) @ index[:SHAPES]).astype(np.int64)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """(ROWS, DIM) unit context vectors over all of ``docs``: fixed in size, whatever the corpus."""
    names = [f"v{d}" for d in range(DIM)]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # pairs are counted over the whole partition, in tables of fixed size; vectors come once, at its end
        terms, beside, shaped = Terms(), np.zeros(ROWS * ROWS, np.int64), np.zeros(ROWS * SHAPES, np.int64)
        for batch in batches:
            count_pairs(batch["t"].tolist(), terms, beside, shaped)
        total = context_sums(beside, shaped, index_vectors())
        used = np.flatnonzero(total.any(axis=1))
        yield pd.DataFrame(total[used], columns=names).assign(term=used)

    part = docs.select(F.col(text_col).alias("t")).where("t <> ''").mapInPandas(sums, ", ".join(f"{n} bigint" for n in names) + ", term int")
    rows = part.groupBy("term").agg(*[F.sum(n).alias(n) for n in names]).collect()
    vectors = np.zeros((ROWS, DIM))
    for r in rows:
        vectors[r.term] = [r[n] for n in names]
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1)
    return np.round(vectors * UNIT) / UNIT


FEATURES = 2 * DIM + 3


def pooled(texts: list[str], terms: Terms, vectors: np.ndarray) -> np.ndarray:
    """(texts, FEATURES): mean word vector, mean shape vector, share of repeating words, log length, 1 for a text with words."""
    out = []
    for group in _groups(texts):
        w, s, size = terms.rows(group)
        got = np.zeros((len(group), FEATURES), np.float32)
        end = np.cumsum(size)
        for a in range(0, len(group), BLOCK):
            n = size[a:a + BLOCK]
            part = slice(end[a] - size[a], end[a + len(n) - 1])
            owner = np.repeat(np.arange(len(n)), n)
            words = np.bincount(owner * ROWS + w[part], minlength=len(n) * ROWS).reshape(len(n), ROWS)
            shapes = np.bincount(owner * SHAPES + s[part], minlength=len(n) * SHAPES).reshape(len(n), SHAPES)
            least = np.maximum(n, 1)[:, None]
            # vectors are whole multiples of 1 / UNIT: these sums are exact in any order
            here = got[a:a + BLOCK]
            here[:, :DIM] = words.astype(np.float64) @ vectors / least
            here[:, DIM:2 * DIM] = shapes.astype(np.float64) @ vectors[:SHAPES] / least
            here[:, -3] = shapes[:, 1] / least[:, 0]
            here[:, -2] = np.log1p(n) / 10
            here[:, -1] = n > 0
        out.append(got)
    return np.concatenate(out) if out else np.zeros((0, FEATURES), np.float32)


class Network:
    """inputs -> HIDDEN tanh units -> 1 logit, divided by a temperature."""

    HIDDEN, STEPS, RATE, DECAY = 24, 400, 0.02, 1e-4

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 8):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        self.temperature = 1.0
        n, d = x.shape
        rest = np.arange(n) % 5 == 4  # left out of training, for the temperature
        z = (x - self.mean) / self.scale
        self.p = [rng.normal(0, 1 / np.sqrt(d), (d, self.HIDDEN)), np.zeros(self.HIDDEN), rng.normal(0, 0.2, self.HIDDEN), np.zeros(1)]
        m, v = [np.zeros_like(a) for a in self.p], [np.zeros_like(a) for a in self.p]
        tx, ty = z[~rest], y[~rest]
        for t in range(1, self.STEPS + 1):
            h = np.tanh(tx @ self.p[0] + self.p[1])
            err = (_sigmoid(h @ self.p[2] + self.p[3]) - ty) / max(1, len(ty))
            back = np.outer(err, self.p[2]) * (1 - h * h)
            grads = [tx.T @ back + self.DECAY * self.p[0], back.sum(0), h.T @ err + self.DECAY * self.p[2], np.array([err.sum()])]
            for i, g in enumerate(grads):  # Adam
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                self.p[i] = self.p[i] - self.RATE * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
        if rest.any():
            logit, target = self.logit(x[rest]), y[rest]
            grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
            loss = [np.logaddexp(0, np.where(target > 0, -1, 1) * logit / g).mean() for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.p[0] + self.p[1]) @ self.p[2] + self.p[3]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x) / self.temperature)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


class Constant:
    """For labels of one kind, or none: a fixed probability."""

    def __init__(self, value: float):
        self.value = value

    def probability(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, parts: int, part: int, max_rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(i, y, t): whole texts of at most ``max_rows`` labelled rows outside the held-out fold, by hash order of the id.

    An id with labels of both kinds takes the smaller one.
    """
    y = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col), parts, part))
    y = y.groupBy(F.col(id_col).alias("i")).agg(F.min(label).cast("int").alias("y"))
    y = pin(y.orderBy(F.xxhash64("i"), "i").limit(max_rows), "labels")  # max_rows rows
    rows = docs.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    return rows.join(F.broadcast(y), "i")


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, label: str = "quality", fold: tuple[int, int] = (4, 2),
        max_rows: int = MAX_ROWS):
    held = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = Terms()
        for batch in batches:
            x = pooled(batch["t"].tolist(), terms, held.value)
            yield pd.DataFrame({"i": batch["i"], "y": batch["y"], "x": list(x)})

    sample = labelled_sample(docs, labels, label, *fold, max_rows)
    got = sample.mapInPandas(features, "i bigint, y int, x array<float>").toPandas()  # max_rows rows of FEATURES numbers
    got = got.sort_values("i", kind="stable").drop_duplicates("i")
    y = got["y"].to_numpy(float)
    if len(set(y)) < 2:
        return Constant(float(y.mean()) if len(y) else 0.5)
    order = np.random.default_rng(8).permutation(len(y))
    return Network(np.array(got["x"].tolist())[order], y[order])


def score(docs: DataFrame, vectors: np.ndarray, network, id_col: str = "doc_id", text_col: str = "text",
          fold: tuple[int, int] = (4, 2), threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Defined cases: NULL and empty texts score like a text without words; without labels of both
    kinds every score is the labels' mean (0.5 without any); repeated rows score alike; an empty
    table gives no rows; other columns are ignored; long texts are pooled whole.
    """
    held = docs.sparkSession.sparkContext.broadcast((vectors, network))

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = Terms()
        v, net = held.value
        for batch in batches:
            yield pd.Series(net.probability(pooled([t or "" for t in batch], terms, v)).astype(float))

    return (docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col), *fold).alias("held_out"), probability(F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    vectors = word_vectors(docs)
    return score(docs, vectors, fit(docs, labels, vectors))
