"""SuperMinHash near-duplicates against all pairs."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from headwater.llm import minhash as M
from headwater.llm import words as W


def by_definition(elements):
    """A signature element by element, each with its own order of places."""
    out = np.full(M.PLACES, M.PLACES << 32, np.uint64)
    for element in W.mix(elements):
        order = list(range(M.PLACES))
        for number in range(M.PLACES):
            taken, offer = M._offers(np.array([element], np.uint64), number)
            at = int(taken[0])
            order[number], order[at] = order[at], order[number]
            out[order[number]] = min(out[order[number]], offer[0])
    return out


@pytest.fixture(scope="module")
def sets():
    rng = np.random.default_rng(3)
    return [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (1, 2, 5, 40, 300, 700)]


def test_signatures_by_definition(sets):
    assert all((by_definition(s) == got).all() for s, got in zip(sets, M.superminhash(sets)))


def test_early_stopping_in_pieces(sets, monkeypatch):
    whole = M.superminhash(sets)
    monkeypatch.setattr(M, "HELD_ELEMENTS", 64)
    assert (M.superminhash(sets) == whole).all()
    assert len(M.superminhash([])) == 0


def test_estimates_scatter_less_than_independent_hashes():
    rng, share, off = np.random.default_rng(5), 370 / 430, []
    for _ in range(300):
        base = rng.integers(0, 2**63, 430, dtype=np.uint64)
        a, b = M.superminhash([np.unique(base[:400]), np.unique(base[30:])])
        off.append((a == b).mean() - share)
    assert abs(np.mean(off)) < 0.004
    assert np.std(off) < 0.9 * (share * (1 - share) / M.PLACES) ** 0.5


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, share=(85, 100)):
    sets = [shingle_set(text) for _, text in docs]
    group = list(range(len(docs)))
    for i, j in itertools.combinations(range(len(docs)), 2):
        both = len(sets[i] & sets[j])
        if both and share[1] * both >= share[0] * (len(sets[i]) + len(sets[j]) - both):
            old, new = group[j], group[i]
            group = [new if g == old else g for g in group]
    out = []
    for k, (doc_id, _) in enumerate(docs):
        ids = [docs[i][0] for i in range(len(docs)) if group[i] == group[k] and docs[i][0] is not None]
        least = min(ids, default=None) if sets[k] else doc_id
        out.append((doc_id, len(sets[k]), least, doc_id == least))
    return sorted(out, key=repr)


def near_texts(seed):
    """Groups of copies with edits, passages that many share, and short texts."""
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(3000)
    passage = [word() for _ in range(60)]
    out = []
    for _ in range(12):
        base = [word() for _ in range(rng.choice([3, 6, 30, 80, 200]))]
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(len(own))] = word()
            if rng.random() < 0.3:
                own = own[: rng.randrange(len(own) * 4 // 5, len(own)) + 1]
            if rng.random() < 0.3:
                own += passage
            out.append(" ".join(own).upper() if rng.random() < 0.2 else " ".join(own))
    out += [" ".join(passage + [word() for _ in range(20)]) for _ in range(15)]
    ids = list(range(len(out)))
    rng.shuffle(ids)
    return list(zip(ids, out))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_pairs(spark, rows, seed):
    docs = near_texts(seed) + [(None, "a b c d e f"), (5, "A b c d e f"), (None, None), (900, ""), (901, "x"), (901, "x")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows(M.near_duplicates(table)) == brute(docs)


def test_small_blocks_lose_no_link(spark, rows, monkeypatch):
    docs = near_texts(4)
    monkeypatch.setattr(M, "BLOCK_SETS", 3)
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert rows(M.near_duplicates(table)) == brute(docs)


def test_units_compare_every_fitting_pair():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64))
    sets = [np.sort(np.concatenate([base[k:], rng.integers(0, 2**63, k, dtype=np.uint64)])) for k in (0, 3, 8, 40, 60)]
    keys = M.band_keys(M.superminhash(sets)).view(np.int64)
    columns = {
        "node": pa.array(range(5), pa.int64()),
        "n": pa.array([len(s) for s in sets], pa.int64()),
        "keys": pa.array(list(keys)),
        "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
        "in_first": pa.array([True] * 5),
    }
    links = M.verify(pa.table(columns), M.Likeness()).to_pydict()
    assert {frozenset(x) for x in zip(links["node"], links["other"])} == {frozenset((0, 1)), frozenset((0, 2))}
    columns["in_first"] = pa.array([True, False, False, True, True])
    links = M.verify(pa.table(columns), M.Likeness()).to_pydict()
    assert {frozenset(x) for x in zip(links["node"], links["other"])} == {frozenset((0, 1)), frozenset((0, 2))}


def test_edges_and_empty_table(docs, no_docs, edge_rows, rows):
    assert rows(M.near_duplicates(docs)) == brute([row[:2] for row in edge_rows])
    assert M.near_duplicates(no_docs).count() == 0
