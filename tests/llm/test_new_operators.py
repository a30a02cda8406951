"""Tokenizer alignment, exact-complement packing and periodic runs, against brute force written here."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spillway.llm import exact_fill, packing, queries, token_align, word_runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.01"
NASTY = [None, "", " \n\t", "one", "one two", "Ünï cödé 𝒳 words\x0bhere", "x" * 5000, "no. " * 3000, "a▁b", "<s> </s> <|endoftext|>",
         "ﬁ\x00é a\x1cb", "to be or not " * 7 + "to be", "  lead and trail  ", "\n\n"]


def with_clashes(docs):
    """Columns whose names the operators use inside."""
    clash = ["i", "t", "k", "copies", "text_key", "piece", "length", "runs", "block", "nth"]
    return docs.select("*", *[F.lit("x").alias(c) for c in clash])


# --- 11: alignment -------------------------------------------------------------------------

def brute_tokens(both, library, text):
    """(A ids, A ends, B ids, B ends) by the tokenizer file itself, or None."""
    if not text:
        return None
    whole = (" " + text).encode()
    a, b = library.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    ends = []
    for ids, table in ((a, both.a_bytes), (b, both.b_bytes)):
        at, own = 0, []
        for i in ids:
            at += len(table[i])
            own.append(at)
        if b"".join(table[i] for i in ids) != whole:
            return None
        ends.append(own)
    return a, ends[0], b, ends[1]


def brute_alignment(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    both = token_align.load(token_align.default_tokenizers())
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    rows, counts = [], Counter()
    for text in texts:
        got = brute_tokens(both, library, text)
        if got is None:
            rows.append(None)
            continue
        a, ea, b, eb = got
        links, j = [], 0
        for i, end in enumerate(ea):
            start = ea[i - 1] if i else 0
            while eb[j] <= start:
                j += 1
            k = j
            while k < len(b) and (eb[k - 1] if k else 0) < end:
                links.append((a[i], b[k]))
                k += 1
        groups, i, j = [], 0, 0
        for cut in sorted(set(ea) & set(eb)):
            ga, gb = [], []
            while i < len(a) and ea[i] <= cut:
                ga.append(str(a[i]))
                i += 1
            while j < len(b) and eb[j] <= cut:
                gb.append(str(b[j]))
                j += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        counts.update(links)
        rows.append((len(a), len(b), groups, links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for row in rows:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = row
        out.append((n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.mark.parametrize("frequent", [1 << 18, 8])  # 8: nearly all pairs take the way of the rare ones
def test_alignment_matches_brute_force(spark, documents, monkeypatch, frequent):
    monkeypatch.setattr(token_align, "FREQUENT", frequent)
    monkeypatch.setattr(token_align, "COPIED", 4)
    texts = NASTY + ["the same text, many times"] * 40 + ["to be"] * 3 + [None]
    docs = with_clashes(documents(list(enumerate(texts)) + [(3, "one"), (None, "one two")]))
    out = token_align.align_documents(docs, token_align.default_tokenizers(), digest=True).collect()
    want = brute_alignment([*texts, "one", "one two"])
    expected = Counter(zip([*range(len(texts)), 3, None], want))
    assert Counter((r.doc_id, tuple(r[c] for c in COLUMNS)) for r in out) == expected


def test_alignment_of_a_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], brute_alignment([r.text for r in rows])))
    out = queries.tokenizer_alignment(spark, SF).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: (*(r[c] for c in COLUMNS[:-1]), r.groups_sha256) for r in out} == want


def test_alignment_tokenizes_each_text_once(spark, documents):
    docs = documents([(i, "a copied text") for i in range(50)] + [(99, "another")])
    aligned = token_align.aligned_texts(docs, token_align.default_tokenizers()).collect()
    assert sorted(r.copies for r in aligned) == [1, 50]
    assert all(g.count("|") == r.n_groups for r in aligned for g in [r.groups])


def test_alignment_of_an_empty_table(spark, documents):
    for docs in (documents([]), documents([(1, None), (2, "")])):
        out = token_align.align_documents(docs, token_align.default_tokenizers()).collect()
        assert [tuple(r[c] for c in COLUMNS) for r in out] == [(0, 0, 0, 0, 0, 0, "")] * docs.count()


# --- 12: best-fit packing ------------------------------------------------------------------

def counts_of(lengths, limit):
    return np.bincount(np.array(lengths, np.int64), minlength=limit + 1)


@given(st.integers(1, 40).flatmap(lambda limit: st.tuples(st.just(limit), st.lists(st.integers(1, limit), max_size=60))))
@settings(max_examples=300, deadline=None)
def test_plan_uses_every_length_once(case):
    limit, lengths = case
    patterns = exact_fill.plan(counts_of(lengths, limit))
    assert all(sum(p) <= limit and n > 0 for p, n in patterns)
    assert sum((Counter({x: p.count(x) * n for x in set(p)}) for p, n in patterns), Counter()) == Counter(lengths)
    decreasing = []  # no more sequences than first-fit decreasing opens, and a half at most
    for x in sorted(lengths, reverse=True):
        at = next((k for k, used in enumerate(decreasing) if used + x <= limit), None)
        if at is None:
            decreasing.append(x)
        else:
            decreasing[at] += x
    assert sum(n for _, n in patterns) <= len(decreasing) * 4 // 3 + 1


@given(st.lists(st.integers(1, 12), max_size=14), st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_index_finds_a_complement_exactly_when_there_is_one(lengths, gap):
    found = exact_fill.SumIndex(counts_of(lengths, 40)).fill(gap)
    have = Counter(lengths)
    sums = {s for a in have for s in [a]} | {a + b for a in have for b in (have - Counter([a]))}
    sums |= {a + b + c for a in have for b in (have - Counter([a])) for c in (have - Counter([a, b]))}
    assert (found is not None) == (gap in sums)
    if found is not None:
        assert sum(found) == gap and not Counter(found) - have


def test_exact_complements_fill_whole_sequences():
    lengths = [3000] * 10 + [1096] * 10 + [2500] * 6 + [1000] * 6 + [596] * 6 + [2000] * 4 + [1100] * 4 + [700] * 4 + [296] * 4
    patterns = exact_fill.plan(counts_of(lengths, 4096))
    assert all(sum(p) == 4096 for p, _ in patterns)
    assert sum(n for _, n in patterns) * 4096 == sum(lengths)


def brute_pieces(tokenizer, doc_id, text, limit=4096):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
    return [(doc_id, k, s, len(ids[s:s + limit]), zlib.crc32(np.array(ids[s:s + limit], "<u4").tobytes()))
            for k, s in enumerate(range(0, len(ids), limit))]


def assert_packed(out, limit=4096):
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= limit
    return len(sequences)


def test_fill_packs_every_token_once(spark, documents):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    texts = [*NASTY, *NASTY, "word " * 9000]
    ids = [*range(len(NASTY)), *range(len(NASTY)), None]
    docs = with_clashes(documents(list(zip(ids, texts)))).repartition(5)
    out = exact_fill.pack(docs, packing.default_tokenizer()).collect()
    want = Counter(p for i, t in zip(ids, texts) for p in brute_pieces(tokenizer, i, t))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    assert_packed(out)


def test_fill_of_a_whole_table(spark):
    out = queries.best_fit_packing(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert {r.doc_id for r in out} == {r.doc_id for r in docs}
    sequences = assert_packed(out)
    assert sequences <= -(-sum(r.length for r in out) // 4096) * 1.02 + 1


def test_fill_of_an_empty_table(spark, documents):
    assert exact_fill.pack(documents([]), packing.default_tokenizer()).collect() == []


# --- 13: periodic runs ---------------------------------------------------------------------

def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_report(doc_id, text, plant=True):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        original = list(words)
        for i in range(a, n):
            words[i] = original[a + (i - a) % p]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    digests = tuple(hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept))
    return (len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, *digests)


REPORT = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
letters = st.integers(1, 4).flatmap(lambda k: st.lists(st.integers(0, k), max_size=50))
periodic = st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 12), letters, letters).map(
    lambda x: x[2] + x[0] * x[1] + x[0][:len(x[0]) // 2] + x[3])


@given(st.lists(st.one_of(letters, periodic), min_size=1, max_size=5))
@settings(max_examples=400, deadline=None)
def test_runs_are_the_maximal_pairs_in_reach(texts):
    words = [[str(x).encode() for x in t] for t in texts]
    assert word_runs.runs_of(words) == [brute_runs(t) for t in words]


def test_runs_report_with_planted_periods(spark, documents):
    rnd = random.Random(3)
    texts = NASTY + [" ".join(rnd.choice("abc") for _ in range(rnd.randrange(200))) for _ in range(80)] + ["w " * 4000, "x y " * 3000 + "z"]
    rows = list(enumerate(texts)) + [(3, NASTY[7]), (None, NASTY[7])]
    found = word_runs.find_runs(with_clashes(documents(rows)), word_runs.plant_period)
    out = word_runs.report(found).collect()
    expected = Counter((i, brute_report(i, t)) for i, t in rows)
    assert Counter((r.doc_id, tuple(r[c] for c in REPORT)) for r in out) == expected


def test_runs_of_a_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(F.length("text") < 20_000).select("doc_id", "text").collect()
    out = {r.doc_id: tuple(r[c] for c in REPORT) for r in queries.periodic_runs(spark, SF).collect()}
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(out[r.doc_id] == brute_report(r.doc_id, r.text) for r in docs)
    assert sum(n > 0 for n, *_ in out.values()) > len(out) // 20


def test_runs_of_an_empty_table(spark, documents):
    assert word_runs.find_runs(documents([])).collect() == []
    row = word_runs.find_runs(documents([(1, "a b " * 5 + "c")])).first()
    assert [tuple(r) for r in row.runs] == [(0, 10, 2)] and row.collapsed == "a b c" and row.n_words == 11


def test_runs_of_a_long_text_stay_near_linear():
    line = [f"l{i}".encode() for i in range(12)]
    words = [w for i in range(3000) for w in [f"u{i}".encode(), *line]] + [b"x"] * 40_000 + [b"a", b"b", b"c"] * 10_000
    assert word_runs.runs_of([words])[0] == [(39_000, 40_000, 1), (79_000, 30_000, 3)]
