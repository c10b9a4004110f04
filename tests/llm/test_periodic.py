"""Periodic runs against brute force over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from headwater.llm import periodic as P
from headwater.llm import queries
from headwater.llm import words as W


def brute(words):
    """All runs, straight from their definition."""
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        begin = None
        for x in range(n - q + 1):
            equal = x < n - q and words[x] == words[x + q]
            if equal and begin is None:
                begin = x
            if not equal and begin is not None:
                size = x - begin + q
                own = words[begin : begin + size]
                smallest = all(any(own[i] != own[i + p] for i in range(size - p)) for p in range(1, q))
                if size >= max(24, 3 * q) and smallest:
                    out.append((begin, size, q))
                begin = None
    return sorted(out, key=lambda r: (r[0], r[2]))


def found(texts):
    numbers = {word: k for k, word in enumerate(sorted({w for words in texts for w in words}))}
    hashes = W.mix(np.array([numbers[w] + 1 for words in texts for w in words], np.uint64))
    first = np.concatenate([[0], np.cumsum([len(words) for words in texts])]).astype(np.int64)
    runs = P.find_runs(hashes, first)
    return list(zip(runs.start.tolist(), runs.length.tolist(), runs.period.tolist())), first


def expected(texts, first):
    return [(a + int(first[k]), size, q) for k, words in enumerate(texts) for a, size, q in brute(words)]


@pytest.mark.parametrize("seed", range(40))
def test_random_texts_with_periods(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(rng.randint(1, 5)):
        kinds, n = rng.choice([1, 2, 3, 10, 1000]), rng.choice([0, 1, 5, 23, 24, 25, 60, 150, 400])
        words = [rng.randrange(kinds) for _ in range(n)]
        for _ in range(rng.randint(0, 3) if n > 5 else 0):
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(3, 9) if rng.random() < 0.7 else rng.randint(1, 12)
            for i in range(a, rng.choice([n, rng.randint(a, n)])):
                words[i] = words[a + (i - a) % p]
        texts.append(words)
    runs, first = found(texts)
    assert runs == expected(texts, first)


@settings(max_examples=60, deadline=None)
@given(st.integers(9, 70), st.integers(3, 5), st.integers(0, 40), st.integers(0, 40), st.integers(1, 3), st.randoms())
def test_a_planted_run_between_other_words(period, times, before, after, kinds, rng):
    root = [rng.randrange(kinds * 4) for _ in range(period)]
    words = [rng.randrange(5) for _ in range(before)] + root * times + [rng.randrange(5) for _ in range(after)]
    runs, first = found([words, words[::-1]])
    assert runs == expected([words, words[::-1]], first)


def test_periods_inside_periods():
    inner = ["a", "b"] * 20 + ["c"]
    texts = [inner * 4, (inner * 3 + ["d"]) * 3, ["x"] * 500, ["x", "y"] * 13 + ["z"] * 24]
    runs, first = found(texts)
    assert runs == expected(texts, first)
    assert (0, 164, 41) in runs


def test_long_text_with_a_long_period():
    rng = random.Random(1)
    root = [rng.randrange(10**6) for _ in range(5003)]
    words = [-1] * 3 + root * 4 + root[:100] + [-2]
    runs, _ = found([words])
    assert runs == [(3, 20_112, 5003)]


def digests(doc_id, text):
    """What the query returns, by brute force."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id if doc_id is not None else "").encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    dropped = {i for a, size, q in runs for i in range(a + q, a + size)}
    listed = "".join(f"{a},{size},{q}\n" for a, size, q in runs)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, collapsed)]
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], *sha)


def test_query_against_brute_force(spark, tmp_path, rows):
    rng = random.Random(3)
    docs = [(None, None), (None, "a " * 30), (7, ""), (8, " \n\t "), (9, "x y " * 40 + "ünïcode " * 30), (9, "x y " * 40 + "ünïcode " * 30)]
    for k in range(10, 200):
        docs.append((k, " ".join(rng.choice(["la", "na", "été", "w%d" % rng.randrange(50)]) for _ in range(rng.randrange(0, 140)))))
    spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr(
        "*", "'x' as row", "1 as runs", "2 as n_words", "'c' as collapsed", "'d' as best"
    ).write.parquet(f"{tmp_path}/documents.parquet")
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    result = rows(queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path)), *names)
    assert result == sorted((digests(*d) for d in docs), key=repr)
    assert sum(r[1] > 0 for r in result) > 8


def test_empty_table_and_edges(docs, no_docs):
    assert P.periodic_runs(no_docs).count() == 0
    found = P.periodic_runs(docs).collect()
    assert len(found) == docs.count()
    for row in found:
        words = row.collapsed.split(" ") if row.collapsed else []
        assert len(words) <= row.n_words
