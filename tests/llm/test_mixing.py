import hashlib
from collections import Counter, defaultdict

import pytest

from headwater.llm import mixing
from headwater.llm.order import running_total
from tests.llm.conftest import key, words_of


def water(sizes, most=3):
    """Targets by raising the level round after round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, rest, left = {}, float(sum(sizes.values())), set(names)
    while left:
        level = rest / sum(weight[s] for s in left)
        full = {s for s in left if weight[s] * level > most * sizes[s]}
        for s in full or left:
            target[s] = most * sizes[s] if full else weight[s] * level
        rest -= sum(target[s] for s in full)
        left = left - full if full else set()
    return target


def brute(rows):
    sizes = [len(words_of(r[1])) for r in rows]
    total = Counter()
    for r, n in zip(rows, sizes):
        total[r[3]] += n
    target = water(total)
    queues = defaultdict(list)
    for i, r in enumerate(rows):
        name = "" if r[0] is None else str(r[0])
        queues[r[3]].append((hashlib.md5(name.encode()).hexdigest(), (r[0] is not None, r[0] or 0), i))
    copies = []
    for source, queue in queues.items():
        upto = 0
        for h, order, i in sorted(queue):
            upto += sizes[i]
            for copy in range(3):
                if target[source] > 0:
                    finish = (copy * total[source] + upto) / target[source]
                    copies.append((finish, source is None, source or "", h, order, copy, i))
    taken, sent = [0] * len(rows), 0
    for *_, i in sorted(copies):
        sent += sizes[i]
        if sent > sum(sizes):
            break
        taken[i] += sizes[i]
    return sizes, total, target, taken


def test_the_mix_equals_a_queue_simulation(docs, edge_rows):
    rows = [r for r in edge_rows if r[0] not in (7, None)]  # ties of an id may share differently
    found = mixing.mix_documents(docs.where("doc_id <> 7")).collect()
    sizes, total, target, taken = brute(rows)
    want = sorted((r[0], n, total[r[3]], t) for r, n, t in zip(rows, sizes, taken))
    assert sorted((r.doc_id, r["size"], r.source_size, r.taken) for r in found) == want
    by_id = {r[0]: target[r[3]] for r in rows}
    assert all(r.target == pytest.approx(by_id[r.doc_id]) for r in found)


def test_bounds_hold_with_ties_and_reruns_agree(docs, edge_rows):
    found = mixing.mix_documents(docs).collect()
    again = mixing.mix_documents(docs.repartition(2)).collect()
    assert sorted(map(key, found)) == sorted(map(key, again))
    assert len(found) == len(edge_rows)
    assert all(r.taken <= 3 * r["size"] for r in found)
    by_source = defaultdict(list)
    for r in found:
        by_source[r.source_size, r.target].append(r)
    for (_, target), rows in by_source.items():
        largest = max(r["size"] for r in rows)
        assert abs(sum(r.taken for r in rows) - target) <= 2 * largest


def test_rows_of_the_mix(docs, edge_rows):
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    taken = Counter()
    for r in mixing.mix_documents(docs).collect():
        taken[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.select("doc_id").collect()) == Counter({k: n for k, n in taken.items() if n})


def test_targets_stop_at_the_cap(spark):
    rows = [("a", 10), ("b", 1000), ("c", 5), (None, 0), ("é", 70), ("z", 3)]
    found = mixing.targets(spark.createDataFrame(rows, "source string, source_size bigint")).collect()
    want = water(dict(rows))
    assert {r.source: pytest.approx(r.target) for r in found} == want
    assert sum(r.target for r in found) == pytest.approx(1088)


def test_running_total_over_null_groups(spark):
    rows = [(None if k % 3 == 0 else k % 3, k, k) for k in range(50)]
    table = spark.createDataFrame(rows, "g int, k int, v bigint")
    found = running_total(table, ["g"], ["k"], "v", "upto").collect()
    for r in found:
        assert r.upto == sum(v for g, k, v in rows if g == r.g and k <= r.k)


def test_nothing_to_mix(docs, no_docs):
    assert mixing.mix_documents(no_docs).collect() == []
    assert mixing.mixed_rows(no_docs).collect() == []
    empty = mixing.mix_documents(docs.where("doc_id in (100, 101)")).collect()
    assert [(r["size"], r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 2
