"""Toxicity: a subsequence string-kernel support vector machine with Nyström landmarks.

The kernel compares two tokens by their common letter triples, gaps allowed: a triple that spans
b + 1 letters weighs LAMBDA^(b+1), up to GAP letters, divided by a norm of the token's length. So inserted
and dropped letters lower a match instead of losing it; marks and spaces inside a word are
dropped before (``i.d-i o t``). Landmark tokens give the Nyström map K(x, L) K(L, L)^-1/2, on which
a linear machine with squared hinge loss is trained. As the kernel is a sum over triples, the machine folds
back into one weight a triple, which scores any token exactly as the landmarks would.

Training uses labelled sentences as bags (a toxic document holds at least one toxic token, a
clean one none): tokens of toxic bags that clean bags lack start as positive, then each round takes
the highest-scoring tokens of each toxic bag. A document's score is a calibrated function of its
highest token score.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out
from .ri_quality import Constant, _sigmoid, labelled_sample

LAMBDA, GAP = 0.75, 5  # weight of a letter of span; letters that a triple spans at most, less one
LETTERS = 27  # padding, a to z: their triples have a weight each; triples with other letters are listed as they are met
WINDOW, STEP = 24, 12  # longer tokens are read in overlapping windows
LANDMARKS, POSITIVES, NEGATIVES, ROUNDS = 256, 1200, 6000, 3
MAX_DOCS = 6000  # labelled documents of each kind used for training, by hash order
MAX_TOKENS = 2_000_000  # and distinct tokens of these documents, added up
MEMO = 300_000
THRESHOLD = 0.5

_PAIRS = [(a, b) for b in range(2, GAP + 1) for a in range(1, b)]
_OTHER = re.compile(r"[^a-z]").search


def _sign(c: str) -> bool:
    """TRUE for a vowel sign that is written as a mark beside its letter (Indic scripts, Thai), no accent."""
    return "\u0900" <= c < "\u2000" and unicodedata.category(c)[0] == "M" and not unicodedata.combining(c)


def letters(word: str) -> str:
    """Letters of a token, of any script, in lower case and without accents."""
    word = word.lower()
    if _OTHER(word):
        word = "".join(c for c in unicodedata.normalize("NFD", word) if c.isalpha() or _sign(c))
    return word


def tokens(text: str) -> list[str]:
    """Tokens by white space; runs of three or more single letters become one token."""
    out, run = [], []
    for w in text.split():
        if len(w) <= 2 and len(letters(w)) == 1:
            run.append(w)
            continue
        if run:
            out += ["".join(run)] if len(run) > 2 else run
            run = []
        out.append(w)
    if run:
        out += ["".join(run)] if len(run) > 2 else run
    return out


def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, WINDOW) letter codes and the word of each row. Words are folded by letters() already.

    Codes: 0 padding, 1 to 26 a to z, above that one for each other letter (its code point less 96).
    """
    rows, owner = [], []
    for n, w in enumerate(words):
        for a in range(0, max(1, len(w) - STEP), STEP) if len(w) > WINDOW else (0,):
            rows.append(w[a:a + WINDOW])
            owner.append(n)
    flat = "".join(r.ljust(WINDOW, "`") for r in rows).encode("utf-32-le")
    return np.frombuffer(flat, "<i4").reshape(-1, WINDOW) - np.int32(96), np.array(owner, np.int64)


def _norms() -> np.ndarray:
    """Root of the sum of squared triple weights of a token of n letters (n up to WINDOW); 1 without triples."""
    out = np.ones(WINDOW + 1)
    for n in range(3, WINDOW + 1):
        out[n] = np.sqrt(sum((n - b) * LAMBDA ** (2 * (b + 1)) for _, b in _PAIRS if n > b))
    return out


NORMS = _norms()


NONE = np.zeros(0, np.int64)


def _keys(codes: np.ndarray, a: int, b: int) -> np.ndarray:
    """A number for each triple of one gap pattern, exact for letters of all scripts (21 bits a letter)."""
    wide = codes.astype(np.int64)
    return (wide[:, :-b] << 42) | (wide[:, a:codes.shape[1] - b + a] << 21) | wide[:, b:]


def triples(codes: np.ndarray, others: np.ndarray = NONE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(triple numbers, weights) of each gap pattern, for all rows; absent triples weigh 0.

    Triples of a to z have numbers under LETTERS^3; one with another letter is numbered after them by its place
    in ``others`` (sorted keys) and weighs 0 where it is not listed.
    """
    latin = codes.max(initial=0) < LETTERS
    for a, b in _PAIRS:
        if b >= codes.shape[1]:
            continue
        first, middle, last = codes[:, :-b], codes[:, a:codes.shape[1] - b + a], codes[:, b:]
        weight = np.where(last > 0, LAMBDA ** (b + 1), 0.0)
        if latin:
            yield (first * LETTERS + middle) * LETTERS + last, weight
            continue
        plain = np.maximum(np.maximum(first, middle), last) < LETTERS
        number = np.where(plain, (first * LETTERS + middle) * LETTERS + last, 0)
        if len(others):
            keys = _keys(codes, a, b)
            place = np.minimum(np.searchsorted(others, keys), len(others) - 1)
            listed = ~plain & (others[place] == keys)
            number = np.where(listed, LETTERS ** 3 + place, number)
            plain = plain | listed
        yield number, np.where(plain, weight, 0.0)


def other_triples(codes: np.ndarray) -> np.ndarray:
    """Sorted keys of the rows' triples with a letter outside a to z."""
    rows = codes[codes.max(1, initial=0) >= LETTERS]
    got = [NONE]
    for a, b in _PAIRS:
        first, middle, last = rows[:, :-b], rows[:, a:rows.shape[1] - b + a], rows[:, b:]
        got.append(_keys(rows, a, b)[(last > 0) & (np.maximum(np.maximum(first, middle), last) >= LETTERS)])
    return np.unique(np.concatenate(got))


def features(codes: np.ndarray, others: np.ndarray = NONE) -> np.ndarray:
    """(rows, LETTERS^3 + others): the explicit kernel map, normed. For landmarks and training samples only."""
    out = np.zeros((len(codes), LETTERS ** 3 + len(others)), np.float32)
    row = np.arange(len(codes))[:, None]
    for number, weight in triples(codes, others):
        np.add.at(out, (np.broadcast_to(row, number.shape), number), weight)
    out /= NORMS[(codes > 0).sum(1)][:, None]
    return out


class Machine:
    """Triple weights (of a to z, then of the ``others`` listed), bias and calibration."""

    def __init__(self, weights: np.ndarray, bias: float, scale: tuple[float, float] = (4.0, 0.0), others: np.ndarray = NONE):
        self.weights, self.bias, self.scale, self.others = weights.astype(np.float32), bias, scale, others

    def token_scores(self, words: list[str]) -> np.ndarray:
        """Margin of each folded token; a longer one has its best window's."""
        if not words:
            return np.zeros(0)
        size = np.array([len(w) for w in words])
        latin = np.array([w.isascii() for w in words])
        out = np.zeros(len(words))
        # short tokens in narrow tables; those with other letters apart, as they need a search for each triple
        for low, high, own in ((low, high, own) for low, high in ((0, 8), (8, 12), (12, 1 << 60)) for own in (latin, ~latin)):
            pick = np.flatnonzero(own & ((size > low) & (size <= high) | (size == 0) * (low == 0)))
            for at in range(0, len(pick), 1 << 14):
                part = pick[at:at + (1 << 14)]
                codes, owner = encode([words[i] for i in part])
                codes = codes[:, :min(WINDOW, high)]
                total = np.zeros(len(codes))
                for number, weight in triples(codes, self.others):
                    total += (self.weights[number] * weight).sum(1)
                total /= NORMS[(codes > 0).sum(1)]
                best = np.full(len(part), -np.inf)
                np.maximum.at(best, owner, total)
                out[part] = best
        return out + self.bias

    def probability(self, best: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale[0] * best + self.scale[1])


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 20.0, steps: int = 300) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by accelerated gradient steps."""
    z = np.hstack([x, np.ones((len(x), 1))])
    keep = np.ones(z.shape[1])
    keep[-1] = 1e-3
    step = 1 / (1 + 2 * c * np.linalg.eigvalsh(z.T @ (z * weight[:, None]))[-1])  # largest eigenvalue of the Gram matrix
    w = prev = np.zeros(z.shape[1])
    for t in range(steps):
        look = w + t / (t + 3) * (w - prev)
        slack = np.maximum(0, 1 - y * (z @ look))
        prev, w = w, look - step * (keep * look - 2 * c * z.T @ (weight * y * slack))
    return w[:-1], float(w[-1])


def variants(word: str) -> list[str]:
    """A positive token as it may be disguised: a letter put in at two places, one left out (fixed by the word)."""
    rng = np.random.default_rng(list(word.encode()))
    out = []
    for letter in rng.choice(list("xzqjkv"), 2):
        at = int(rng.integers(1, len(word)))
        out.append(word[:at] + str(letter) + word[at:])
    if len(word) >= 6:
        at = int(rng.integers(1, len(word) - 1))
        out.append(word[:at] + word[at + 1:])
    return out


def _witnesses(ranked: list[int], toxic: list[np.ndarray], size: int) -> list[int]:
    """Of the tokens in their order, those that some toxic bag needs (it holds none that came before) or a tenth of them holds."""
    wanted = np.zeros(size, bool)
    wanted[ranked] = True
    flat = np.concatenate(toxic)
    owner = np.repeat(np.arange(len(toxic)), [len(b) for b in toxic])[wanted[flat]]
    flat = flat[wanted[flat]]
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    explained, out = np.zeros(len(toxic), bool), []
    for w, low, high in zip(ranked, np.searchsorted(flat, ranked), np.searchsorted(flat, ranked, side="right")):
        own = owner[low:high]
        if len(own) * 10 >= max(50, len(toxic)) or not explained[own].all():
            explained[own] = True
            out.append(w)
    return out


def numbered(bags: Iterable[tuple[int, Iterable[str]]]) -> tuple[list[str], list[tuple[int, np.ndarray]], np.ndarray]:
    """(vocabulary, distinct bags as sorted token numbers, labels of all bags). Bags are taken one at a time, so no more
    than one bag is held as strings; copies count once, and a label that differs between copies stays."""
    index: dict[str, int] = {}
    labels, distinct = [], set()
    for label, words in bags:
        labels.append(label)
        distinct.add((label, np.array(sorted({index.setdefault(w, len(index)) for w in sorted(set(words)) if len(w) >= 3}), np.int32).tobytes()))
    return list(index), [(y, np.frombuffer(b, np.int32)) for y, b in sorted(distinct)], np.array(labels)


def train(bags: Iterable[tuple[int, Iterable[str]]], seed: int = 9):
    """Machine from bags (label, folded tokens of a document's sentences)."""
    words, bags, labels = numbered(bags)
    if len(set(labels.tolist())) < 2:
        return Constant(float(labels.mean()) if len(labels) else 0.5)
    index = {w: n for n, w in enumerate(words)}
    labels = np.array([y for y, _ in bags])
    toxic = [b for y, b in bags if y]
    in_toxic = np.bincount(np.concatenate(toxic), minlength=len(words))
    in_clean = np.bincount(np.concatenate([b for y, b in bags if not y]), minlength=len(words))
    share = labels.sum() / max(1, len(labels) - labels.sum())
    rng = np.random.default_rng(seed)
    by_word = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)  # ties go by the word

    def top(pick: np.ndarray, value: np.ndarray, most: int) -> list[int]:
        """Tokens that ``pick`` marks, by falling value, then word."""
        own = by_word[pick[by_word]]
        return own[np.argsort(-value[own], kind="stable")][:most].tolist()

    clean = by_word[in_clean[by_word] > 0]
    negative = {*clean[rng.permutation(len(clean))[:NEGATIVES]].tolist(), *top(in_clean > 0, in_clean, NEGATIVES // 4)}
    odds = in_toxic * np.log((in_toxic + 0.5) / (share * in_clean + 0.5))
    ranked = top((in_toxic >= 2) & (in_clean == 0), odds, len(words))
    positive = _witnesses(ranked, toxic, len(words))[:POSITIVES] or top(in_toxic > 0, odds, 10)
    half = LANDMARKS // 2
    marks, spread = positive[:half], sorted(negative, key=words.__getitem__)
    marks = marks + [w for w in spread[::max(1, len(spread) // (LANDMARKS - half))][:LANDMARKS - half] if w not in set(marks)]
    mark_codes = np.concatenate([encode([words[w][:WINDOW]])[0] for w in marks])
    others = other_triples(mark_codes)  # a triple that no landmark holds adds nothing to the kernel
    phi = features(mark_codes, others)
    values, vectors = np.linalg.eigh((phi @ phi.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])  # K(L, L)^-1/2, without its null space

    def mapped(own: list[str]) -> np.ndarray:
        out = []
        for at in range(0, len(own), 100):
            codes = np.concatenate([encode([w[:WINDOW]])[0] for w in own[at:at + 100]])
            out.append(features(codes, others) @ phi.T)
        return np.concatenate(out).astype(np.float64) @ whiten if out else np.zeros((0, whiten.shape[1]))

    flat = np.concatenate([b for _, b in bags])
    cuts = np.cumsum([0, *(len(b) for _, b in bags)])
    filled = np.flatnonzero(np.diff(cuts))
    owner = np.repeat(np.arange(len(bags)), np.diff(cuts))
    in_toxic_bag = labels[owner] == 1
    machine, hard = None, set()
    for _ in range(ROUNDS):
        negatives = [words[w] for w in sorted({*negative, *hard} - set(positive), key=words.__getitem__)]
        shown = [(v, in_toxic[w]) for w in positive for v in (words[w], *variants(words[w]))
                 if v == words[w] or v not in index or not in_clean[index[v]]]
        n = len(shown)
        x = np.vstack([mapped([v for v, _ in shown]), mapped(negatives)])
        y = np.array([1.0] * n + [-1.0] * len(negatives))
        support = np.array([c for _, c in shown] + [1.0] * len(negatives), float)
        support[:n] *= 0.5 / max(1, support[:n].sum())
        support[n:] = 0.5 / max(1, len(negatives))
        w, bias = svm(x, y, support * len(y) / 10)
        machine = Machine((whiten @ w) @ phi, bias, others=others)
        margin = machine.token_scores(words)
        tops = np.full(len(bags), -1.0)
        tops[filled] = np.maximum.reduceat(margin[flat], cuts[filled]) if filled.size else -1.0
        # the next round's positives: of each toxic bag its best token and all that clear the margin
        clears = in_toxic_bag & (margin[flat] >= np.maximum(np.minimum(tops, 0.5), 0.0)[owner]) & (in_clean <= 0.02 * in_toxic)[flat]
        chosen = np.bincount(flat[clears], minlength=len(words))
        positive = top(chosen > 0, chosen, POSITIVES) or positive
        hard |= set(top((in_clean > 0) & (margin > -0.5), margin, NEGATIVES // 4))
    best = np.clip(tops, -3, 3)
    machine.scale = _platt(best, labels)
    return machine


def _platt(best: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability, by Newton steps with a small ridge."""
    weight = np.ones(len(labels))
    x = np.stack([best, np.ones(len(best))], 1)
    w = np.array([2.0, 0.0])
    for _ in range(50):
        p = _sigmoid(x @ w)
        grad = x.T @ (weight * (p - labels)) + 0.01 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        w = w - move * min(1, 2 / (np.abs(move).max() + 1e-9))
    return float(max(w[0], 0.1)), float(w[1])


class Scorer:
    """Highest token margin of texts; remembers tokens."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.memo: dict[str, float] = {}

    def best(self, texts: list[str]) -> np.ndarray:
        if len(self.memo) > MEMO:
            self.memo.clear()
        memo = self.memo
        out = []
        for at in range(0, len(texts), 512):
            words = [tokens(t) for t in texts[at:at + 512]]
            new = list({w for text in words for w in text if w not in memo})
            memo.update(zip(new, self.machine.token_scores([letters(w) for w in new]).tolist()))
            out += [max(map(memo.__getitem__, text), default=-3.0) for text in words]
        return np.clip(np.array(out), -3, 3)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fold: tuple[int, int] = (5, 0), max_docs: int = MAX_DOCS,
        max_tokens: int = MAX_TOKENS):
    """Trains on at most ``max_docs`` labelled documents of each kind; tasks send the folded tokens of each.

    Documents are taken by hash order while their distinct tokens add up to at most ``max_tokens`` (those with over a
    hundredth of it come last), so what the driver holds is bounded in bytes and not only in rows.
    """

    def bag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [sorted({letters(w) for w in tokens(t)}) for t in batch["t"]]
            yield pd.DataFrame({"i": batch["i"], "y": batch["y"], "n": [len(b) for b in own], "w": [" ".join(b) for b in own]})

    got = []
    for kind in (1, 0):
        rows = labelled_sample(docs, labels.where(F.col(label) == kind), label, *fold, max_docs).mapInPandas(bag, "i bigint, y int, n bigint, w string")
        order = Window.orderBy(F.col("n") * 100 > max_tokens, F.xxhash64("i"), "i", "w").rowsBetween(Window.unboundedPreceding, 0)
        got.append(rows.withColumn("upto", F.sum("n").over(order)).where(F.col("upto") <= max_tokens).select("i", "y", "w").toPandas())
    frame = pd.concat(got).sort_values(["i", "y", "w"], kind="stable").drop_duplicates(["i", "y"])
    return train((int(y), w.split()) for y, w in zip(frame["y"], frame["w"]))


def score(docs: DataFrame, machine, id_col: str = "doc_id", text_col: str = "text", fold: tuple[int, int] = (5, 0),
          threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Defined cases: NULL and empty texts, and texts without a token, have the lowest margin; without labels
    of both kinds every score is the labels' mean (0.5 without any); repeated rows score
    alike; an empty table gives no rows; other columns are ignored; long texts are read whole.
    """
    held = docs.sparkSession.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = held.value
        scorer = Scorer(m) if isinstance(m, Machine) else None
        for batch in batches:
            texts = [t or "" for t in batch]
            yield pd.Series(m.probability(scorer.best(texts) if scorer else np.zeros(len(texts))).astype(float))

    return (docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col), *fold).alias("held_out"), probability(F.col(text_col)).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
