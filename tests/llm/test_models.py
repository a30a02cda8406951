"""Trained operators: exact small cases and held-out accuracy on the given tables; the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from spillway.llm import ppm_langid, ri_quality, ssk_toxicity
from spillway.llm.common import fold

SMALL = "/root/testdata/sf0.01"
NASTY = [None, "", " \n", "1234 !!", "one", "x" * 60_000, "word " * 20_000]


def brute_bits(text, training):
    """Code length of ``text`` in a context tree of the training texts, one symbol at a time."""
    pad = b"\0" * 3
    seen = {}
    for t in training:
        raw = pad + t.encode()
        for i in range(3, len(raw)):
            for k in range(4):
                node = seen.setdefault(raw[i - k:i], {})
                node[raw[i]] = node.get(raw[i], 0) + 1
    raw, bits = pad + text.encode(), 0.0
    for i in range(3, len(raw)):
        for k in (3, 2, 1, 0):
            node = seen.get(raw[i - k:i])
            if node is None:
                continue
            n, d = sum(node.values()), len(node)
            if raw[i] in node:
                bits -= np.log2(node[raw[i]] / (n + d))
                break
            bits -= np.log2(d / (n + d))
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact():
    rng = random.Random(1)
    make = lambda alphabet, n: "".join(rng.choice(alphabet) for _ in range(n))
    training = [[make("abcd ", 200), make("abé ", 50)], [make("bcxyz ", 300)]]
    model = ppm_langid.Model(["l0", "l1"], [ppm_langid.count_codes(t) for t in training])
    texts = [make("abcdexyzé ", rng.randint(0, 80)) for _ in range(30)] + ["", "a"]
    got = model.lengths(texts)
    for t, row in zip(texts, got):
        assert row == pytest.approx([brute_bits(t, tr) for tr in training], abs=0.01)


def test_language_id(spark, documents):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = ppm_langid.train(docs)
    out = ppm_langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (out["lang_pred"] == out["lang"]).mean() > 0.97
    odd = {r.doc_id: r for r in ppm_langid.predict(documents(list(enumerate(NASTY)) + [(None, "the and")]), model).collect()}
    assert [odd[i].lang_pred == "und" for i in range(4)] == [True] * 4 and odd[0].score == 0
    assert all(0 <= r.score <= 1 for r in odd.values()) and odd[None].held_out is False
    empty = documents([])
    assert ppm_langid.predict(empty, ppm_langid.train(empty)).count() == 0
    assert ppm_langid.predict(documents([(1, "abc")]), ppm_langid.train(empty)).first().lang_pred == "und"


def test_language_model_counts_all_training_texts_whole(spark):
    rng = random.Random(5)
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1]
    out = [i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1]
    text = {i: "".join(rng.choice("abc ") for _ in range(50)) for i in ids}
    text[ids[0]] = "z" * ppm_langid.CHUNK + "q" * 3500  # longer than a chunk: no other text suffers, its end counts too
    other = {i + 1000: "".join(rng.choice("bcdé ") for _ in range(50)) for i in range(60) if zlib.crc32(str(i + 1000).encode()) % 3 != 1}
    rows = [(i, t, "a") for i, t in text.items()] + [(i, t, "b") for i, t in other.items()] + [(i, "unseen", "a") for i in out]
    rows += [(None, "nul", "a"), (ids[1] + 2000, None, "a"), (ids[2], "none", None), (ids[3], "", "c")]
    model = ppm_langid.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5))
    want = ppm_langid.Model(["a", "b"], [ppm_langid.count_codes(list(text.values())), ppm_langid.count_codes(list(other.values()))])
    probes = ["abc cab", "zzzz", "qqqq", "bcd dcb", "unseen", "é", *list(text.values())[1:]]
    assert model.languages == ["a", "b"] and model.lengths(probes) == pytest.approx(want.lengths(probes))
    assert model.lengths(["abc cab a bca"]).argmin() == 0


def test_counted_codes_equal_a_plain_count():
    texts = ["", "a", "abcabcabc", "x" * (ppm_langid.CHUNK + 7), "éa\0b"]
    plain = {}
    for t in texts:
        raw = ppm_langid.PAD + ppm_langid.text_bytes(t)
        for i in range(3, len(raw)):
            code = int.from_bytes(raw[i - 3:i + 1], "big")
            plain[code] = plain.get(code, 0) + 1
    keys, counts = ppm_langid.count_codes(texts)
    assert dict(zip(keys.tolist(), counts.tolist())) == plain
    assert len(ppm_langid.count_codes([])[0]) == 0


def test_language_model_keeps_the_most_frequent_codes(spark):
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 3 != 1]
    rng = random.Random(6)
    rare = "".join(chr(rng.randint(97, 122)) for _ in range(3000))
    docs = spark.createDataFrame([(ids[0], "abab" * 500, "a"), (ids[1], rare, "a"), (ids[2], rare, "b")], "doc_id bigint, text string, lang string")
    codes = lambda t: dict(zip(*(x.tolist() for x in ppm_langid.count_codes(t))))
    keep = {k: c for k, c in codes(["abab" * 500, rare]).items() if c >= 512}
    model = ppm_langid.train(docs, max_codes=100)
    assert 2 <= len(keep) <= 100
    table = model.cost[ppm_langid.ORDER]
    assert model.languages == ["a", "b"] and len(table) < 400  # b: one power holds more than 100, so a share of it stays
    found = model.index[ppm_langid.ORDER].find(np.array(list(keep), np.uint32))
    assert (found >= 0).all() and model.lengths(["abababab"])[0].argmin() == 0


def test_quality_classifier(spark, documents):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    vectors = ri_quality.word_vectors(docs)
    network = ri_quality.fit(docs, labels, vectors)
    out = ri_quality.score(docs, vectors, network).join(labels, "doc_id").where("held_out").toPandas()
    assert (out["predicted"] == out["quality"]).mean() > 0.93
    odd = ri_quality.score(documents(list(enumerate(NASTY)) + [(1, "")]), vectors, network).collect()
    assert len(odd) == len(NASTY) + 1 and all(0 <= r.score <= 1 for r in odd)
    none = ri_quality.fit(docs, labels.limit(0), vectors)
    assert {r.score for r in ri_quality.score(documents([(1, "a"), (2, None)]), vectors, none).collect()} == {0.5}
    assert ri_quality.classify(documents([]), labels).count() == 0


def test_toxicity(spark, documents):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    machine = ssk_toxicity.fit(docs, labels)
    out = ssk_toxicity.score(docs, machine).join(labels, "doc_id").toPandas()
    clean = out[(out["toxic"] == 0) & out["held_out"]]
    assert (clean["predicted"] == 0).mean() > 0.8 and (out[out["toxic"] == 1]["predicted"] == 1).mean() > 0.8
    odd = ssk_toxicity.score(documents(list(enumerate(NASTY)) + [(1, "")]), machine).collect()
    assert len(odd) == len(NASTY) + 1 and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in ssk_toxicity.score(documents([(1, "a")]), ssk_toxicity.fit(docs, labels.limit(0))).collect()} == {0.5}
    assert ssk_toxicity.score(documents([]), machine).count() == 0


def test_gapped_insults_score_like_plain_ones():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["th", "er", "an", "on", "re", "ly", "es"]) for _ in range(rng.randint(1, 4)))
    bags = [(0, [word() for _ in range(60)]) for _ in range(200)]
    bags += [(1, [word() for _ in range(60)] + [rng.choice(["idiot", "moron", "pathetic"])]) for _ in range(60)]
    scorer = ssk_toxicity.Scorer(ssk_toxicity.train(bags))
    texts = ["the idiot there", "the i.d.i.o.t there", "the i d i o t there", "the idxiot there", "THE PATHETIC,", "pat-hetic"]
    assert (scorer.best(texts) > 0).all()
    assert (scorer.best(["the there only", "", "an on es"]) < 0).all()


@pytest.mark.parametrize("parts, insults", [
    (["то", "на", "ре", "ко", "ли", "ен", "ва", "но"], ["дурак", "идиот", "ублюдок"]),
    (["τα", "και", "νο", "ρε", "στη", "μα", "πο"], ["ηλίθιος", "βλάκας", "μαλάκας"]),
    (["ال", "من", "في", "ون", "ات", "ها", "لم"], ["أحمق", "غبي", "حقير"]),
    (["का", "में", "ने", "से", "रा", "हो", "ली"], ["बेवकूफ", "कमीना", "मूर्ख"]),
])
def test_insults_of_other_scripts_are_learned(parts, insults):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))
    raw = [(0, [word() for _ in range(60)]) for _ in range(200)]
    raw += [(1, [word() for _ in range(60)] + [rng.choice(insults)]) for _ in range(60)]
    bags = [(y, [ssk_toxicity.letters(w) for w in b]) for y, b in raw]
    scorer = ssk_toxicity.Scorer(ssk_toxicity.train(bags))
    clean = [" ".join(word() for _ in range(30)) for _ in range(40)]
    assert (scorer.best([f"{c} {w}, {c}" for c, w in zip(clean, insults)]) > 0).all()
    assert (scorer.best([f"{clean[0]} {w[:1]}.{w[1:]}" for w in insults]) > 0).all()
    assert (scorer.best(clean) > 0).mean() < 0.1


def test_letters_of_all_scripts_stay_distinct():
    words = ["дурак", "добро", "βλάκας", "ζώδιον", "中文字符", "日本語文"]
    folded = [ssk_toxicity.letters(w) for w in words]
    assert len(set(folded)) == len(words)
    codes, _ = ssk_toxicity.encode(folded)
    phi = ssk_toxicity.features(codes, ssk_toxicity.other_triples(codes))
    for i, x in enumerate(folded):
        for j, y in enumerate(folded):
            want = 0.0
            for a, b in ssk_toxicity._PAIRS:
                for p, q in ssk_toxicity._PAIRS:
                    want += sum(ssk_toxicity.LAMBDA ** (b + q + 2) for s in range(len(x) - b) for t in range(len(y) - q)
                                if (x[s], x[s + a], x[s + b]) == (y[t], y[t + p], y[t + q]))
            assert phi[i] @ phi[j] == pytest.approx(want / (ssk_toxicity.NORMS[len(x)] * ssk_toxicity.NORMS[len(y)]), rel=1e-4, abs=1e-6)


def test_folded_weights_equal_the_landmark_kernel():
    words = ["idiot", "idxiot", "there", "an", "a", "disgusting"]
    codes, _ = ssk_toxicity.encode(words)
    phi = ssk_toxicity.features(codes)
    for i, x in enumerate(words):
        for j, y in enumerate(words):
            want = 0.0
            for a, b in ssk_toxicity._PAIRS:
                for p, q in ssk_toxicity._PAIRS:
                    want += sum(ssk_toxicity.LAMBDA ** (b + q + 2) for s in range(len(x) - b) for t in range(len(y) - q)
                                if (x[s], x[s + a], x[s + b]) == (y[t], y[t + p], y[t + q]))
            want /= ssk_toxicity.NORMS[len(x)] * ssk_toxicity.NORMS[len(y)]
            assert phi[i] @ phi[j] == pytest.approx(want, rel=1e-4, abs=1e-6)
    machine = ssk_toxicity.Machine(phi[0], 0.25)
    assert machine.token_scores(words) == pytest.approx(phi @ phi[0] + 0.25, rel=1e-4)


def test_folds(spark):
    rows = spark.range(50).select("id", fold(F.col("id"), 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in rows)


def test_pipeline_keeps_clean_documents_and_drops_the_rest(spark):
    import corpus_pipeline as pipeline
    from spillway.llm import decontam, line_rules, simhash
    from spillway.session import pin

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    columns, d = docs.columns, "/root/testdata/sf0.001"
    stages = dict(pipeline.STAGES)
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "simhash_dedup", "decontamination", "secret_scan", "packing"]
    one = pin(stages["quality_rules"](spark, docs, d), "t")
    kept = {r.i for r in line_rules.judge(docs).where("kept").selectExpr("doc.doc_id AS i").collect()}
    assert one.columns == columns and {r.doc_id for r in one.collect()} == kept
    two = pin(stages["simhash_dedup"](spark, one, d), "t")
    assert two.columns == columns
    assert {r.doc_id for r in two.collect()} == {r.component_id for r in simhash.near_duplicates(one).collect()}
    three = pin(stages["decontamination"](spark, two, d), "t")
    leaked = {r.doc_id for r in decontam.matches(two, decontam.benchmark_of(two, d)).collect()}
    assert leaked and {r.doc_id for r in three.collect()} == {r.doc_id for r in two.collect()} - leaked
    four = pin(stages["secret_scan"](spark, three, d), "t")
    assert four.columns == columns and four.count() == three.count()
    five = stages["packing"](spark, four, d)
    assert {r.doc_id for r in five.collect()} == {r.doc_id for r in four.collect()}
    assert pipeline.run(spark, d).count() == five.count()


def test_toxicity_on_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    out = ssk_toxicity.classify(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    toxic, clean = (out[out["toxic"] == y]["predicted"] for y in (1, 0))
    assert len(toxic) > 20 and (toxic == 1).mean() >= 0.6 and (clean == 0).mean() >= 0.98  # 352 toxic documents to learn from


def test_training_bags_are_bounded_in_tokens(spark, documents):
    docs = documents([(i, f"w{i} " + " ".join(f"t{k}" for k in range(i * 10))) for i in range(1, 60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, toxic int")
    seen = []
    real = ssk_toxicity.train
    ssk_toxicity.train = lambda bags: seen.extend((y, list(w)) for y, w in bags) or real([])
    try:
        ssk_toxicity.fit(docs, labels, max_tokens=3000)
    finally:
        ssk_toxicity.train = real
    for kind in (0, 1):
        sizes = [len(w) for y, w in seen if y == kind]
        assert sizes and sum(sizes) <= 3000
