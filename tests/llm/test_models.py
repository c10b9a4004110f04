"""The classifier and language identification."""

import random
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from headwater.llm import classifier, language, queries
from headwater.llm import words as W
from headwater.llm.frames import fold, labelled_sample
from tests.llm.conftest import WORDS, words_of


def made(spark, seed=5):
    """Good and bad documents, and the words of two languages."""
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(400):
        good = k % 4 != 0
        words = [rng.choice(WORDS) for _ in range(rng.randint(5, 60))]
        if k % 2:
            words = [w + rng.choice(["ung", "heit", "sch"]) for w in words]
        text = " ".join(w if good else w.upper() + "!!" for w in words)
        rows.append((k, text, "de" if k % 2 else "xx"))
        labels.append((k, int(good)))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string"), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_held_out_quality(spark):
    docs, labels = made(spark)
    held_out = fold("doc_id", 5) == 0
    weights = classifier.fit(docs, labels, ~held_out)
    found = classifier.score(docs, weights, held_out.alias("held_out")).join(labels, "doc_id").where("held_out").collect()
    assert len(found) > 50
    assert np.mean([(r.score >= classifier.THRESHOLD) == (r.quality == 1) for r in found]) > 0.95


def test_reruns_agree(spark):
    docs, labels = made(spark)
    train = fold("doc_id", 5) != 0
    again = classifier.fit(docs.repartition(7), labels.repartition(3), train)
    assert np.array_equal(classifier.fit(docs, labels, train), again)


def test_the_update_follows_the_leader():
    """Two steps by hand: z collects gradients minus sigma times weight, n their squares."""
    ftrl = classifier.Ftrl(alpha=0.5, beta=1.0, l1=0.1, l2=0.2)
    learner = classifier.Learner(ftrl)
    at, x = np.array([3, 1 << classifier.BITS]), np.array([2.0, 1.0])
    z, n = np.zeros(2), np.zeros(2)
    for label in (1, 1, 0):
        w = np.where(np.abs(z) <= 0.1, 0, -(z - np.sign(z) * 0.1) / ((1 + np.sqrt(n)) / 0.5 + 0.2))
        g = (1 / (1 + np.exp(-(w @ x))) - label) * x
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / 0.5
        z, n = z + g - sigma * w, n + g * g
        learner.learn(at, x, label)
    assert np.allclose(learner.z[at], z) and np.allclose(learner.n[at], n)


def test_features_of_a_text():
    data = np.frombuffer(b"Ab ab ab x1!", np.uint8)
    keys, text = classifier.features(data, np.array([0, 0, len(data)]))
    assert len(keys) == 4 + 3 + 4 + 3 and set(text) == {1}
    assert keys[1] == keys[2] and keys[0] != keys[1]


def test_classifier_on_edges(docs, no_docs, labels, no_labels, edge_rows):
    weights = classifier.fit(docs, labels, F.lit(True))
    found = classifier.score(docs, weights).collect()
    assert len(found) == len(edge_rows) and all(0 <= r.score <= 1 for r in found)
    bias = 1 / (1 + np.exp(-weights[-1]))
    assert [r.score for r in found if r.doc_id in (100, 101, 102)] == [pytest.approx(bias)] * 3
    nothing = classifier.fit(docs, no_labels, F.lit(True))
    assert not nothing.any() and not classifier.fit(no_docs, labels, F.lit(True)).any()
    assert classifier.score(no_docs, weights).collect() == []


def test_labelled_sample(docs, labels):
    found = {r.doc_id: r["label"] for r in labelled_sample(docs, labels, "quality", 1000).collect()}
    assert found[4] == 0 and found[3] == 1 and None not in found
    assert labelled_sample(docs, labels, "quality", 10).count() == 10


def test_one_id_on_very_many_rows_is_one_row_of_the_sample(spark):
    rows = [(1, f"text {k % 50}") for k in range(5000)] + [(k, "other") for k in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)] + [(1, 0)] * 100, "doc_id bigint, quality int")
    found = labelled_sample(docs, labels, "quality", 10).collect()
    assert len(found) <= 10
    every = labelled_sample(docs, labels, "quality", 1000).collect()
    assert len(every) == len({r.doc_id for r in every}) == 29
    again = labelled_sample(docs.repartition(3), labels, "quality", 1000).collect()
    assert sorted(every) == sorted(again) and [r.label for r in every if r.doc_id == 1] == [0]


def test_few_labels_are_not_diluted(spark):
    """With four labels most parts learn nothing, and count for nothing."""
    rows = [(0, "good calm words here " * 5), (1, "BAD!! LOUD!! " * 9), (2, "more calm words here " * 5), (3, "LOUD!! BAD!! " * 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(k % 2 == 0)) for k in range(4)], "doc_id bigint, quality int")
    weights = classifier.fit(docs, labels, F.lit(True))
    parts = {r[0] for r in docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(classifier.PARTS))).collect()}
    assert np.allclose(weights, brute_weights(spark, rows, {k: int(k % 2 == 0) for k in range(4)})) and len(parts) < classifier.PARTS


def brute_features(text):
    """Features of a text one by one: words, pairs, forms and pairs of forms."""
    out, one = [], lambda x: int(W.mix(np.array([x % 2**64], np.uint64))[0])
    words = words_of(text)
    found = []
    for word in words:
        data = np.frombuffer(word, np.uint8)
        whole = W.Words(np.array([0]), np.array([len(word)]), np.array([0]), np.array([0, 1]))
        bits = 0
        for byte in word:
            bits |= int(classifier._KIND[byte])
        found.append((int(W.hash_words(data, whole)[0]), one(bits + 7)))
    base = int(W._BASE)
    for i, (h, k) in enumerate(found):
        out += [h, k]
        if i + 1 < len(found):
            h2, k2 = found[i + 1]
            out += [one(one(h) * base + h2), one(k * 3 + k2 + (h == h2))]
    return [x >> 64 - classifier.BITS for x in out]


def brute_weights(spark, rows, labels, ftrl=classifier.Ftrl()):
    """The learner row by row with dictionaries."""
    keys = {r.doc_id: r.h for r in spark.createDataFrame(rows, "doc_id bigint, text string").select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    bias, learned = 1 << classifier.BITS, []
    for part in range(classifier.PARTS):
        own = sorted((keys[k], text, labels[k]) for k, text in rows if k in labels and keys[k] % classifier.PARTS == part)
        z, n = {}, {}

        def weight(i):
            shrunk = max(abs(z.get(i, 0.0)) - ftrl.l1, 0.0) * np.sign(z.get(i, 0.0))
            return -shrunk / ((ftrl.beta + n.get(i, 0.0) ** 0.5) / ftrl.alpha + ftrl.l2)

        for _ in range(ftrl.epochs):
            for _, text, label in own:
                found = brute_features(text)
                x = {i: np.float32(found.count(i) / len(found)) * ftrl.scale for i in set(found)} | {bias: 1.0}
                w = {i: weight(i) for i in x}
                error = 1 / (1 + np.exp(-sum(w[i] * x[i] for i in x))) - label
                for i in x:
                    g, old = error * x[i], n.get(i, 0.0)
                    z[i] = z.get(i, 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / ftrl.alpha * w[i]
                    n[i] = old + g * g
        if own:
            learned.append({i: weight(i) for i in z})
    out = np.zeros(bias + 1)
    for found in learned:
        for i, w in found.items():
            out[i] += w / len(learned)
    out[:-1] *= ftrl.scale
    return out


def test_the_whole_query_against_a_plain_learner(spark, tmp_path):
    docs, labels = made(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect() if crc32(str(r.doc_id).encode()) % 5}
    weights = brute_weights(spark, rows, known)
    found = {r.doc_id: r for r in queries.QUERIES["op4_quality_classifier"](spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        own = brute_features(text)
        score = 1 / (1 + np.exp(-(np.mean([weights[i] for i in own]) + weights[-1])))
        assert found[doc_id].score == pytest.approx(score, abs=1e-5)
        assert found[doc_id].predicted == int(found[doc_id].score >= 0.3) and found[doc_id].held_out == (doc_id not in known)


def test_long_words_are_hashed_in_pieces(monkeypatch):
    text = b"ab " + b"xY" * 5000 + b" c " + b"q" * 300 + b" " + b"zz" * 1000
    data = np.frombuffer(text, np.uint8)
    words = W.find_words(data, np.array([0, len(text)]))
    whole = [W.hash_words(data, words, lower) for lower in (False, True)]
    monkeypatch.setattr(W, "LONG_WORD", 256)
    assert all((W.hash_words(data, words, lower) == h).all() for lower, h in zip((False, True), whole))


def brute_profile(texts, size=language.PROFILE):
    count = {}
    for text in texts:
        word_chars = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        for w in word_chars:
            padded = f" {w} "
            grams = list(w) + [padded[i : i + 2] for i in range(len(padded) - 1)]
            grams += [padded[i : i + 3] for i in range(len(padded) - 2) if padded[i + 1] != " "]
            for g in grams:
                count[g] = count.get(g, 0) + 1

    def order(gram):
        number = 0
        for c in gram:
            number = number << 21 | (0 if c == " " else ord(c))
        return number | (1 << 63 if len(gram) == 2 else 0)

    return sorted(count, key=lambda g: (-count[g], order(g)))[:size]


def test_languages_equal_brute_force(docs, edge_rows):
    train = fold("doc_id", 4) != 2
    profiles = language.fit(docs, train)
    from zlib import crc32

    learned = [r for r in edge_rows if r[2] and crc32(b"" if r[0] is None else str(r[0]).encode()) % 4 != 2]
    lists = {lang: brute_profile([r[1] or "" for r in learned if r[2] == lang]) for lang in ("a", "b")}
    ranks = {lang: {g: i for i, g in enumerate(found)} for lang, found in lists.items()}
    assert {lang: len(p) for lang, p in profiles.items()} == {lang: len(p) for lang, p in lists.items()}

    def predict(text):
        own = brute_profile([text or ""])
        if not own:
            return "und", 0.0
        far = {lang: sum(abs(r.get(g, i + 300) - i) if g in r else 300 for i, g in enumerate(own)) for lang, r in ranks.items()}
        best = min(far, key=lambda lang: (far[lang], lang))
        return best, 1 - far[best] / (300 * len(own))

    found = language.identify(docs, profiles).collect()
    want = sorted((str(r[0]), *predict(r[1])) for r in edge_rows)
    assert sorted((str(r.doc_id), r.lang_pred, r.score) for r in found) == [(a, b, pytest.approx(c)) for a, b, c in want]


def test_language_held_out(spark):
    docs, _ = made(spark)
    held_out = fold("doc_id", 4) == 2
    found = language.identify(docs, language.fit(docs, ~held_out), "lang", held_out.alias("held_out")).where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.95


def test_nothing_to_learn_languages_from(docs, no_docs):
    assert {(r.lang_pred, r.score) for r in language.identify(docs, language.fit(no_docs, F.lit(True))).collect()} == {("und", 0.0)}
    assert language.identify(no_docs, {}).collect() == []
