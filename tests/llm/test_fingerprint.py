import hashlib

import numpy as np

from headwater.llm import fingerprint as fp
from tests.llm.conftest import key


def test_versions_of_all_rows(docs, edge_rows):
    found = [r.asDict() for r in fp.versions(docs).collect()]
    assert len(found) == len(edge_rows)
    chain = sorted(((r[0], r[1] or "") for r in edge_rows), key=lambda r: key(r[:1]))
    by_id = {}
    for row in found:
        by_id.setdefault(row["doc_id"], []).append(row)
    for i, (doc_id, text) in enumerate(chain):
        if len(by_id[doc_id]) > 1:
            continue  # ties are ordered by a hash
        following = chain[(i + 1) % len(chain)]
        if len(by_id[following[0]]) > 1:
            continue
        row = by_id[doc_id][0]
        edited = fp.edit(text, following[1])
        assert row["edited"] == edited and row["n_chars"] == len(text)
        plain = fp.digest([text, edited, following[1]])
        for other, name in ((1, "near_edited"), (2, "near_next")):
            chars = sum(fp._plain_difference(plain, 0, other)[1])
            whole = int(plain.n_chars[0] + plain.n_chars[other])
            assert abs(row[name] - (1 - chars / whole if whole else 1.0)) < 1e-12
    same = {}
    for row, (_, text) in zip(sorted(found, key=lambda r: key((r["doc_id"],))), chain):
        if len(by_id[row["doc_id"]]) == 1:
            assert same.setdefault(text, row["fingerprint"]) == row["fingerprint"]
    assert len(set(same.values())) == len(same)


def test_peeling_tells_the_digests_or_says_that_it_cannot():
    rng = np.random.default_rng(3)
    for differing in (0, 1, 5, 40, 400):
        common = [f"line {x}\n" for x in rng.integers(0, 10**9, 300)]
        extra = [f"more {x}\n" for x in rng.integers(0, 10**9, differing)]
        digests = fp.digest(["".join(common), "".join(common + extra)])
        base = fp.sketch(digests)
        pair = np.array([0]), np.array([1])
        found, used = fp.differences(digests, base, *pair)
        assert found.only.tolist() == [[0, differing]] and used[0] >= fp.CELLS
        assert found.chars[0, 1] == sum(map(len, extra))
    assert not fp.peel(base.minus(*pair)).found[0], "24 cells cannot tell 400 digests"


def test_unresolvable_pairs_are_compared_plainly(monkeypatch):
    digests = fp.digest(["a. b. c.", "a. d."])
    monkeypatch.setattr(fp, "peel", lambda cells: fp.Difference(*[np.zeros((len(cells.count), 2), int)] * 2, np.zeros(len(cells.count), bool)))
    found, used = fp.differences(digests, fp.sketch(digests), np.array([0]), np.array([1]))
    assert found.only.tolist() == [[2, 1]] and used.tolist() == [0]


def test_one_document_and_none(spark, docs, no_docs):
    assert fp.versions(no_docs).collect() == []
    alone = fp.versions(docs.where("doc_id = 15")).first()
    assert (alone.edited, alone.near_edited, alone.near_next) == ("one", 1.0, 1.0)
    assert alone.fingerprint == alone.edited_fingerprint
    assert hashlib.sha256(b"one").hexdigest()
