from collections import Counter

import numpy as np
import pandas as pd
import pytest

from headwater.llm import queries, rules
from tests.llm.conftest import key, words_of


def brute(text):
    text = text or ""
    words = words_of(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered |= set(range(i, i + 5))
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if words_of(line):
            dup += line in seen
            seen.add(line)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_statistics_of_all_documents(docs, edge_rows, labels):
    found = rules.quality(docs, labels).collect()
    want = [(r[0], *brute(r[1])) for r in edge_rows]
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert sorted(key([r[n] for n in names]) for r in found) == sorted(map(key, want))
    for r in found:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and (not failed or not r.kept)


def test_lines_and_windows():
    data = "a b\na b\n\n \na b c d e f a b c d e|<"
    found = rules.count_block(np.frombuffer(data.encode(), np.uint8), np.array([0, len(data)]))
    assert {k: int(v[0]) for k, v in found.items() if k in ("n_words", "n_dup_lines", "n_repeat_words", "n_symbols")} == {
        "n_words": 15,
        "n_dup_lines": 1,
        "n_repeat_words": brute(data)[4],
        "n_symbols": 2,
    }


def sample(n=900, seed=1):
    rng = np.random.default_rng(seed)
    table = pd.DataFrame({name: rng.random(n) for name, _, _ in rules.RATIOS})
    return table, rng


def test_rules_find_planted_causes():
    table, rng = sample()
    bad = ((table["symbol_share"] > 0.8) & (table["upper_share"] < 0.5)) | (table["mark_share"] > 0.9)
    found = rules.learn_rules(table, bad.to_numpy())
    assert 2 <= len(found) <= 4
    covered = np.zeros(len(table), bool)
    for rule in found:
        covered |= rules._covers(rule, table)
    assert (covered == bad).mean() > 0.98
    assert "symbol_share >= 0.8" in " ".join(str(c) for rule in found for c in rule)


def test_noise_makes_no_rules():
    table, rng = sample()
    assert rules.learn_rules(table, rng.random(len(table)) < 0.2) == []
    assert rules.learn_rules(table, np.zeros(len(table), bool)) == []


def test_pruning_shortens():
    table, _ = sample()
    bad = (table["symbol_share"] > 0.7).to_numpy()
    cause = rules.Condition("symbol_share", True, 0.7)
    chance = rules.Condition("digit_share", True, 0.4)
    assert rules.prune_rule((cause, chance), table, bad) == (cause,)


def test_the_list_becomes_one_expression(spark):
    counted = spark.createDataFrame([(10, 5, 1), (10, 0, 9), (0, 0, 0)], "n_words bigint, n_marks bigint, n_distinct bigint")
    listed = [(rules.Condition("mark_share", True, 0.4),), (rules.Condition("distinct_share", True, 0.5), rules.Condition("words", True, 1.0))]
    assert [r[0] for r in counted.select(rules.decision(listed)).collect()] == [1, 2, None]
    assert [r[0] for r in counted.select(rules.decision([])).collect()] == [None] * 3


def test_whole_rows_and_empty_tables(docs, no_docs, labels, no_labels):
    kept = rules.kept_rows(docs, labels)
    assert kept.schema == docs.schema and kept.where("text is null").count() == 0
    whole = sorted(key(r) for r in docs.collect())
    assert all(key(r) in whole for r in kept.collect())
    assert rules.quality(no_docs, labels).collect() == [] and rules.kept_rows(no_docs, no_labels).collect() == []
    assert rules.fit(docs, no_labels) == []


def naive_rules(table, bad, precision=0.95, least=5, longest=4):
    """Sequential covering row by row and threshold by threshold."""
    rows = table.to_dict("records")

    def holds(condition, row):
        name, above, value = condition
        return row[name] >= value if above else row[name] <= value

    def covers(rule, row):
        return all(holds(condition, row) for condition in rule)

    def best(some):
        found, top = None, 0.0
        p0, n0 = sum(bad[i] for i in some), sum(not bad[i] for i in some)
        for name, _, _ in rules.RATIOS:
            values = sorted({rows[i][name] for i in some})
            for above in (False, True):
                for low, high in zip(values, values[1:]):
                    condition = (name, above, (low + high) / 2)
                    inside = [i for i in some if holds(condition, rows[i])]
                    p, n = sum(bad[i] for i in inside), sum(not bad[i] for i in inside)
                    gain = p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) if p else -np.inf
                    if gain > top:
                        found, top = condition, gain
        return found

    def worth(rule, some):
        inside = [i for i in some if covers(rule, rows[i])]
        p = sum(bad[i] for i in inside)
        return (2 * p - len(inside)) / len(inside) if inside else -1.0

    out, left = [], list(range(len(rows)))
    while True:
        grows, tests = [i for i in left if i % 3 != 2], [i for i in left if i % 3 == 2]
        if sum(bad[i] for i in grows) < least:
            return out
        rule, inside = [], grows
        while len(rule) < longest and any(bad[i] for i in inside) and not all(bad[i] for i in inside):
            condition = best(inside)
            if condition is None:
                break
            rule.append(condition)
            inside = [i for i in inside if holds(condition, rows[i])]
        if not rule:
            return out
        rule = rule[: max(range(1, len(rule) + 1), key=lambda k: (worth(rule[:k], tests), -k))]
        covered = [i for i in left if covers(rule, rows[i])]
        if len(covered) < least or np.mean([bad[i] for i in covered]) < precision:
            return out
        out.append(rule)
        left = [i for i in left if i not in set(covered)]


@pytest.mark.parametrize("seed", range(4))
def test_covering_against_the_plain_one(seed):
    table, rng = sample(150, seed)
    table = table.round(1) if seed % 2 else table  # with ties
    bad = ((table["symbol_share"] > 0.7) & (table["words"] < 0.8)) | (table["mark_share"] > 0.85) | (rng.random(150) < 0.02)
    found = [[(c.ratio, c.above, c.value) for c in rule] for rule in rules.learn_rules(table, bad.to_numpy())]
    assert found == [list(rule) for rule in naive_rules(table, bad.tolist())]


def test_the_whole_query_against_the_plain_covering(spark, tmp_path):
    rng = np.random.default_rng(6)
    docs, labels = [], []
    for k in range(240):
        words = [f"w{rng.integers(40)}x{rng.integers(9)}" for _ in range(rng.integers(12, 60))]
        if k % 3 == 0:
            words = [w.upper() + "!" if k % 2 else f"#{w}|" for w in words]
        docs.append((k, " ".join(words)))
        labels.append((k, int(k % 3 != 0)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    counts = rules.text_counts(frame.selectExpr("doc_id", "text", "xxhash64(doc_id) as at")).toPandas()
    for name, part, whole in rules.RATIOS:
        counts[name] = counts[part] / (np.maximum(counts[whole], 1) if whole else 1)
    counts = counts.sort_values("at", kind="stable").reset_index(drop=True)
    quality = dict(labels)
    plain = naive_rules(counts, [quality[d] == 0 for d in counts["doc_id"]])
    assert plain
    rejected = {
        row["doc_id"]: next((k for k, rule in enumerate(plain, 1) if all((row[n] >= v) if a else (row[n] <= v) for n, a, v in rule)), None)
        for row in counts.to_dict("records")
    }
    found = {r.doc_id: r for r in queries.QUERIES["op8_quality_rules"](spark, str(tmp_path)).collect()}
    assert {d: r.rejected_by for d, r in found.items()} == rejected
    assert all(r.kept == (not r.base_failed and r.rejected_by is None) for r in found.values())
