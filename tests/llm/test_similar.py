import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from headwater.llm import similar
from headwater.llm.graph import components
from tests.llm.conftest import WORDS, key, words_of


def set_of(text, n=3):
    words = words_of(text, lower=True)
    if len(words) < n:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def groups_of(sets, share=(9, 10)):
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and sets[j] and share[1] * both >= share[0] * (len(sets[i]) + len(sets[j]) - both):
            parent[find(j)] = find(i)
    return [find(i) for i in range(len(sets))]


def expected(rows, like=similar.Likeness()):
    sets = [set_of(r[1], like.words) for r in rows]
    roots = groups_of(sets, like.share)
    least = {}
    for r, root in zip(rows, roots):
        least[root] = min(x for x in (least.get(root), r[0], 1 << 60) if x is not None)
    return sorted(
        key((r[0], len(s), r[0] if not s else (None if least[root] == 1 << 60 else least[root])))
        for r, s, root in zip(rows, sets, roots)
    )


def test_edges_equal_all_pairs(docs, edge_rows):
    found = similar.similar(docs).collect()
    assert sorted(key(r) for r in found) == expected(edge_rows)


def near_copies(rng, n, size, edits):
    base = [rng.choice(WORDS) + rng.choice(WORDS) for _ in range(size)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(size)] = rng.choice(WORDS)
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("blocks, like", [(4_000, similar.Likeness()), (7, similar.Likeness()), (4_000, similar.NEAR), (4_000, similar.Likeness(5, (4, 5)))])
def test_many_near_copies_at_the_bound(spark, monkeypatch, blocks, like):
    """Chains of links around the bound, of several sizes; with small blocks, clusters are cut."""
    rng = random.Random(blocks)
    texts = []
    for size in (3, 5, 11, 12, 21, 40, 90, 200):
        texts += near_copies(rng, 14, size, 1 + size // 30)
    rows = [(k, text) for k, text in enumerate(texts)]
    monkeypatch.setattr(similar, "BLOCK_SETS", blocks)
    monkeypatch.setattr(similar, "HELD_SIGNATURES", 200)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert sorted(key(r) for r in similar.similar(docs, like).collect()) == expected(rows, like)


@pytest.mark.parametrize("like", [similar.Likeness(), similar.NEAR, similar.Likeness(5, (4, 5))])
def test_linked_sets_share_a_signature(like):
    rng = np.random.default_rng(8)
    for _ in range(400):
        n = int(rng.integers(9, 300))
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        for differing in range(1, n // 4 + 1, 1 + n // 60):
            gone = int(rng.integers(0, differing + 1))
            b = np.delete(a, rng.choice(len(a), min(gone, len(a) - 1), replace=False))
            b = np.unique(np.concatenate([b, rng.integers(0, 2**63, differing - gone, dtype=np.uint64)]))
            both = len(np.intersect1d(a, b))
            if like.share[1] * both >= like.share[0] * (len(a) + len(b) - both) and len(np.setxor1d(a, b)):
                assert len(np.intersect1d(similar.signatures(a, like), similar.signatures(b, like)))


def test_the_tree_finds_what_pairs_find():
    rng = random.Random(6)
    for _ in range(30):
        base = rng.sample(range(10**6), rng.randint(9, 60))
        sets = set()
        for _ in range(25):
            own = set(base)
            for _ in range(rng.randint(0, 3)):
                own.discard(rng.choice(base))
                own.add(rng.randrange(10**6))
            sets.add(frozenset(own))
        sets = [*sets, frozenset(rng.sample(range(10**6), 20))]
        split = rng.choice([len(sets), len(sets) // 2])
        table = pa.table(
            {
                "node": list(range(len(sets))),
                "shingles": [np.array(sorted(s), np.uint64).tobytes() for s in sets],
                "in_first": [i < split for i in range(len(sets))],
            }
        )
        found = similar.join_block(table).to_pylist()
        linked = groups_of(sets)
        by_links = list(range(len(sets)))

        def find(i):
            while by_links[i] != i:
                i = by_links[i]
            return i

        for r in found:
            a, b = sets[r["node"]], sets[r["other"]]
            assert 10 * len(a & b) >= 9 * len(a | b)
            by_links[find(r["node"])] = find(r["other"])
        if split == len(sets):
            assert Counter(Counter(map(find, range(len(sets)))).values()) == Counter(Counter(linked).values())
        else:
            for i, j in combinations(range(len(sets)), 2):
                if i < split <= j and 10 * len(sets[i] & sets[j]) >= 9 * len(sets[i] | sets[j]):
                    assert find(i) == find(j)


def test_one_of_each(docs, no_docs, edge_rows):
    kept = similar.one_of_each(docs)
    assert kept.schema == docs.schema
    ids = Counter(r.doc_id for r in kept.collect())
    groups = Counter(component for *_, component in expected(edge_rows))
    assert ids[4] == 0 and ids[3] == 1 and ids[7] == 3  # two texts, and an empty one
    assert ids[100] == ids[101] == ids[102] == 1
    assert len(groups) <= sum(ids.values())
    assert similar.one_of_each(no_docs).collect() == [] and similar.similar(no_docs).collect() == []


def test_components_of_a_path_a_star_and_none(spark):
    edges = [(k, k + 1) for k in range(100)] + [(1000, k) for k in range(1001, 1100)] + [(5000, 5000)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "x bigint, y bigint")).collect()}
    assert found == {**{k: 0 for k in range(101)}, **{k: 1000 for k in range(1000, 1100)}}
    assert components(spark.createDataFrame([], "x bigint, y bigint")).collect() == []


def test_the_pipeline_links_trimmed_copies_and_edits_that_stand_together(spark):
    """Five words and 0.8: a fifth of the text cut away, a quarter added, or a tenth edited in one place."""
    rng = random.Random(12)
    words = [f"{rng.choice(WORDS)}{k}" for k in range(204)]
    changed = [*words[:90], *[f"new{k}" for k in range(17)], *words[107:]]
    texts = [words, words[:165], [*words, *[f"tail{k}" for k in range(48)]], changed, words[:160], changed[::-1]]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in similar.similar(docs, similar.NEAR).collect()}
    assert found[1] == found[2] == found[3] == 0 and found[5] == 5
    assert sorted(key((r[0], r[1])) for r in found.items()) == sorted(
        key((r[0], r[2])) for r in similar.similar(docs, similar.Likeness(5, (4, 5))).collect()
    )


def test_a_common_passage_ties_fewer_unrelated_sets_by_pairs_of_parts():
    """Sets of 300 that share 30."""
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 2**63, 30, dtype=np.uint64) * np.uint64(2)
    sets = [np.unique(np.concatenate([passage, rng.integers(0, 2**63, 270, dtype=np.uint64) * np.uint64(2)])) for _ in range(60)]

    def ties(of_parts):
        like = similar.NEAR
        found = [
            {(k, x) for k in similar.levels(like, len(s)) for x in of_parts(s, like.differing(k), np.uint64(k)).tolist()} for s in sets
        ]
        return sum(bool(a & b) for a, b in combinations(found, 2))

    assert similar.NEAR.paired and 3 * ties(similar._pairs) < ties(similar._single)
