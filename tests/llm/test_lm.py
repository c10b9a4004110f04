import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from headwater.llm import lm
from headwater.llm.frames import fold
from headwater.llm.trie import EliasFano, Trie, quantise, restore
from tests.llm.conftest import words_of


def held(doc_id):
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 1


def expected(rows):
    count, pairs, total, kinds = Counter(), Counter(), Counter(), Counter()
    texts = [(r[0], [*words_of(r[1], lower=True), None]) for r in rows]
    for doc_id, words in texts:
        if not held(doc_id):
            count.update(words)
            for a, b in zip([0, *words[:-1]], words):
                pairs[a, b] += 1
                total[a] += 1
    for a, _ in pairs:
        kinds[a] += 1
    n = sum(count.values())
    whole = n + 0.5 * (len(count) + 1)
    out = []
    for doc_id, words in texts:
        score = 0.0
        for a, b in zip([0, *words[:-1]], words):
            p = (count[b] + 0.5) / whole
            left = lm.DISCOUNT * kinds[a] / total[a] if total[a] else 1.0
            own = max(pairs[a, b] - lm.DISCOUNT, 0) / total[a] if pairs[a, b] else 0.0
            score += math.log10(own + left * p)
        base = sum(math.log10((count[w] + 0.5) / whole) for w in words)
        known = sum(count[w] > 0 for w in words)
        out.append((doc_id, held(doc_id), len(words), known, n, base, score))
    return sorted(out, key=str)


def close(found, want, step):
    found = sorted((tuple(r) for r in found), key=lambda r: (str(r[:5]), r[5]))
    want = sorted(want, key=lambda r: (str(r[:5]), r[5]))
    assert [r[:5] for r in found] == [r[:5] for r in want]
    for f, w in zip(found, want):
        assert f[5] == pytest.approx(w[5], abs=1e-6)
        assert abs(f[6] - w[6]) <= step * f[2] + 1e-4 * abs(w[6])


def test_scores_equal_the_formula(docs, edge_rows, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_BYTES", 20_000)
    close(lm.score(docs, fold("doc_id", 5) == 1).collect(), expected(edge_rows), 2e-4)


def test_rare_words_are_asked_for(docs, edge_rows, monkeypatch):
    """With few frequent words and small batches, all kinds of messages occur."""
    monkeypatch.setattr(lm, "FREQUENT", 16)
    monkeypatch.setattr(lm, "BATCH_TOKENS", 500)
    close(lm.score(docs, fold("doc_id", 5) == 1).collect(), expected(edge_rows), 2e-4)


def test_a_split_context_counts_as_a_whole():
    """A frequent context over four shards: each knows the count and the kinds of the whole."""
    rng = np.random.default_rng(5)
    words = rng.integers(1 << 20, 2**63, 4000, dtype=np.uint64) * np.uint64(2)
    hot, n = np.array([7], np.uint64), np.array([4000])
    unigrams = lm.Unigrams(4000, 4001, 4, hot, n, hot, n)
    assert unigrams.splits(np.array([7, 9], np.uint64)).tolist() == [4, 1]
    part = np.sort(words[:1000])
    shard = lm.Shard(np.full(1000, 7, np.uint64), part, np.ones(1000, np.int64), unigrams)
    assert shard.total.tolist() == [4000] and shard.log_left[0] == pytest.approx(math.log10(lm.DISCOUNT))


def test_no_documents_and_nothing_to_learn(docs, no_docs):
    from pyspark.sql import functions as F

    assert lm.score(no_docs, fold("doc_id", 5) == 1).collect() == []
    rows = lm.score(docs, F.lit(True)).collect()
    assert {(r.train_tokens, r.n_known, round(r.base_score, 6) + 0.0, r.score) for r in rows} == {(0, 0, 0.0, 0.0)}


@pytest.mark.parametrize("n, universe", [(0, 1 << 64), (1, 1 << 64), (5, 10), (900, 1 << 20), (900, 900), (3000, 1 << 64), (700, 700 << 40)])
def test_elias_fano_finds_what_it_holds(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe - 1, n, dtype=np.uint64, endpoint=True))
    sequence = EliasFano(values, universe)
    assert (sequence.get(np.arange(n)) == values).all()
    asked = np.concatenate([values, rng.integers(0, universe - 1, 500, dtype=np.uint64, endpoint=True)])
    assert (sequence.successor(asked) == np.searchsorted(values, asked)).all()
    found, there = sequence.find(asked), np.isin(asked, values)
    assert (found[there] >= 0).all() and (values[found[there]] == asked[there]).all() and (found[~there] == -1).all()


def test_elias_fano_is_small():
    """Two bits and log2(universe / numbers) for each number, and little more."""
    values = np.sort(np.random.default_rng(3).integers(0, 1 << 40, 100_000, dtype=np.uint64))
    sequence = EliasFano(values, 1 << 40)
    assert sequence.nbytes * 8 / len(values) < 2 + math.log2((1 << 40) / len(values)) + 1


@pytest.mark.parametrize("level", ["contexts", "successors", "pointers"])
def test_look_ups_read_the_packed_bits(level):
    """Damage to the unary part of a level shows in its answers."""
    rng = np.random.default_rng(4)
    contexts = np.unique(rng.integers(0, 2**63, 2000, dtype=np.uint64) * np.uint64(2))
    degrees = np.full(len(contexts), 5)
    successors = np.concatenate([np.sort(rng.integers(0, 2**63, 5, dtype=np.uint64)) for _ in contexts])
    trie = Trie(contexts, degrees, successors, -rng.random(len(successors)) * 9)
    ask = {
        "contexts": lambda: trie.context(contexts) == np.arange(len(contexts)),
        "successors": lambda: ~np.isnan(trie.log(np.repeat(np.arange(len(contexts)), 5), successors)),
        "pointers": lambda: trie.degree(np.arange(len(contexts))) == 5,
    }[level]
    assert ask().all()
    getattr(trie, level).high[:] = 0
    assert ask().mean() < 0.2


def test_trie_lookups():
    rng = np.random.default_rng(1)
    contexts = np.unique(rng.integers(0, 2**63, 300, dtype=np.uint64) * np.uint64(2))
    degrees = rng.integers(0, 6, len(contexts))
    successors = np.concatenate([np.sort(rng.integers(0, 2**63, d, dtype=np.uint64)) for d in degrees])
    logs = -rng.random(len(successors)) * 9
    trie = Trie(contexts, degrees, successors, logs)
    place = trie.context(contexts)
    assert place.tolist() == list(range(len(contexts)))
    assert (trie.context(contexts + np.uint64(1)) == -1).all()
    found = trie.log(np.repeat(place, degrees), successors)
    assert np.allclose(found, logs, atol=16 / 65535)
    assert np.isnan(trie.log(np.repeat(place, degrees), successors ^ np.uint64(1 << 40))).all()
    assert np.isnan(trie.log(np.array([-1]), successors[:1])).all()
    assert Trie(contexts[:0], degrees[:0], successors[:0], logs[:0]).context(contexts[:2]).tolist() == [-1, -1]
    assert restore(quantise(np.array([0.0, -8.0, -99.0]))).round(3).tolist() == [0.0, -8.0, -16.0]


def test_frequent_words_change_no_probability(docs, edge_rows, monkeypatch):
    """Seen pairs with a rare second word have their whole lower-order share."""
    monkeypatch.setattr(lm, "FREQUENT", 16)
    monkeypatch.setattr(lm, "BATCH_TOKENS", 500)
    close(lm.score(docs, fold("doc_id", 5) == 1).collect(), expected(edge_rows), 2e-4)


def test_a_split_context_counts_its_kinds_exactly(spark):
    """A word with a third of all tokens and few successors is split; no shard guesses n(h) from its own kinds."""
    rows = [(k, f"hot a{k % 3} hot b{k % 2}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    close(lm.score(docs, fold("doc_id", 5) == 1).collect(), expected(rows), 2e-4)
    train = docs.selectExpr("doc_id", "text", "doc_id >= 0 as train")
    _, unigrams = lm.count_words(train, 40)
    unigrams = lm.count_kinds(train, unigrams)
    hot = next(w for w in unigrams.split if w > lm.END and unigrams.find(np.array([w]))[0] == 120)
    assert unigrams.splits(np.array([hot]))[0] > 10
    one = lm.Shard(np.array([hot]), np.array([12345], np.uint64), np.array([1]), unigrams)
    assert one.log_left[0] == pytest.approx(math.log10(lm.DISCOUNT * 5 / 120))


def test_a_shard_names_the_batches_that_ask_and_no_others():
    rng = np.random.default_rng(3)
    unigrams = lm.Unigrams(100, 50, 1000, np.empty(0, np.uint64), np.empty(0, np.int64))
    rows = []
    for name in range(20):
        words = rng.integers(1 << 20, 2**63, 2, dtype=np.uint64)
        raw = words.astype("<u8").view(np.uint8).reshape(-1, 8)
        own, next_one = lm._coded(words[:1], np.array([-1]), [0, 1], raw[:1]), lm._coded(words[1:], np.array([-1]), [0, 1], lm._pack(words[1:]))
        ones, zeros = lm.narrow(np.ones(1, np.int64)), lm.narrow(np.zeros(1, np.int64))
        rows.append((0, name, 1, own[0], ones, next_one[0], ones, zeros, *[None] * 6))
    names = [x.split()[0] for x in lm._PAIR_ROWS.split(", ")]
    table = pa.table({name: pa.array([row[k] for row in rows], pa.int64() if k < 3 else pa.binary()) for k, name in enumerate(names)})
    asked = [row for row in lm._score_shard(unigrams)(table).to_pylist() if row["kind"] == lm.ASKED]
    assert sorted(name for row in asked for name in np.frombuffer(row["f"], np.int64).tolist()) == list(range(20))


def test_words_of_messages_are_what_they_were():
    rng = np.random.default_rng(4)
    frequent = np.sort(np.append(rng.integers(3, 2**64, 70_000, dtype=np.uint64), lm.END))
    words = np.concatenate([rng.choice(frequent, 500), rng.integers(3, 2**64, 300, dtype=np.uint64), [lm.END]])
    rng.shuffle(words)
    unigrams = lm.Unigrams(1, 1, 1, frequent, np.ones(len(frequent), np.int64))
    places, ends = unigrams.places(words), np.array([0, 1, 400, len(words)])
    raw = words.astype("<u8").view(np.uint8).reshape(-1, 8)
    for short, hashes, wanted in ((False, raw, words), (True, lm._pack(words), lm._short(words) << np.uint64(16))):
        found = [lm._decoded(x, b - a, frequent, short) for x, a, b in zip(lm._coded(words, places, ends, hashes), ends, ends[1:])]
        assert np.concatenate([x for x, _ in found]).tolist() == wanted.tolist()
        assert np.concatenate([x for _, x in found]).tolist() == (places >= 0).tolist()
