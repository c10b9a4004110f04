"""Hard negatives against all scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from headwater.llm import negatives as N
from headwater.llm import queries

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(table, least=50, most=95, n_positives=5, n_negatives=3, every=50):
    usable = {
        (i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        for i, v, label in table
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    order = lambda row: (-row[1], row[0][0] is None, row[0][0] or 0, row[0])
    out = []
    for anchor in usable:
        if anchor[0] is None or anchor[0] % every:
            continue
        scored = sorted(
            ((r, sum(x * y for x, y in zip(anchor[2], r[2]))) for r in usable if r != anchor), key=order
        )
        for positive, p in [x for x in scored if x[0][1] == anchor[1]][:n_positives]:
            fitting = [x for x in scored if x[0][1] != anchor[1] and least * p <= 100 * x[1] <= most * p][:n_negatives]
            out += [(anchor[0], positive[0], k + 1, r[0], p, s) for k, (r, s) in enumerate(fitting)]
    return sorted(out, key=repr)


def clustered(n, dimension, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.12, (6, dimension))
    out = []
    for i in range(n):
        v = centres[rng.integers(6)] + rng.normal(0, 0.07, dimension)
        out.append((i, [float(np.float32(x)) for x in v], int(rng.integers(labels))))
    return out


@pytest.mark.parametrize("dimension", [3, 64, 100])
def test_intervals_hold_the_scores(dimension):
    rng = np.random.default_rng(dimension)
    vectors = np.floor(rng.normal(0, 40, (300, dimension)))
    vectors[0] = 0
    vectors[1] = 5
    bits = N.code_bits(dimension)
    queries_, codes = N.Queries(vectors[:50], bits), N.Codes.of(vectors, bits)
    low, high = queries_.intervals(np.arange(50), codes, np.arange(300))
    scores = vectors[:50] @ vectors.T
    assert ((low <= scores) & (scores <= high)).all()
    lengths = np.linalg.norm(vectors, axis=1)
    assert np.median((high - low) / (1 + lengths[:50, None] * lengths[None])) < 1.3  # Cauchy-Schwarz alone gives 2
    assert np.allclose(np.linalg.norm(N.rotate(vectors, bits), axis=1), lengths)


@pytest.mark.parametrize(("dimension", "seed"), [(64, 1), (16, 2), (3, 3)])
def test_against_all_scores(spark, rows, dimension, seed, monkeypatch):
    monkeypatch.setattr(N, "ROW_BLOCK", 150)
    monkeypatch.setattr(N, "ANCHOR_BLOCK", 7)
    monkeypatch.setattr(N, "TILE", (5, 64))
    table = clustered(700, dimension, seed)
    found = N.mine(spark.createDataFrame(table, SCHEMA), F.col("vec_id") % 50 == 0)
    assert rows(found) == brute(table)


def test_the_filter_leaves_pairs_out(monkeypatch):
    table = clustered(3000, 64, 9)
    vectors = np.floor(np.array([v for _, v, _ in table]) * 256).astype(np.int64)
    ids, labels = np.arange(3000), np.array([label for *_, label in table])
    none = np.zeros(3000, bool)
    side = N.Side(ids, ids, none, labels, vectors)
    some = np.arange(0, 3000, 50)
    anchors = N.Side(ids[some], ids[some], none[some], labels[some], vectors[some])
    scored = []
    real = N.exact
    monkeypatch.setattr(N, "exact", lambda a, r, x, y: scored.append(len(x)) or real(a, r, x, y))
    monkeypatch.setattr(N, "TILE", (64, 128))
    N.find_positives(anchors, side, N.Codes.of(vectors, 64), 64, N.Mining())
    assert sum(scored) < 0.8 * sum((labels == label).sum() for label in labels[some])


def test_ties_repeats_and_bad_rows(spark, rows):
    rng = random.Random(4)
    table = [(i, [rng.choice([0.0, 0.25, 0.5]) for _ in range(4)], rng.randrange(3)) for i in range(200)]
    table += table[:20] + [(50, [0.5] * 4, 1), (50, [0.25] * 4, 1), (None, [0.5] * 4, 0), (None, [0.5] * 4, 1)]
    table += [(300, None, 1), (301, [0.5] * 4, None), (302, [0.5, None, 0.5, 0.5], 0), (303, [0.5, float("nan"), 0.5, 0.5], 0)]
    table += [(350, [float("inf")] * 4, 0), (400, [], 0), (401, [0.5, 0.5], 1), (450, [-0.5] * 4, 2), (499, [0.5], 2)]
    frame = spark.createDataFrame(table, SCHEMA).selectExpr("*", "1 as key", "2 as score", "'x' as rank", "3 as nr")
    assert rows(N.mine(frame, F.col("vec_id") % 50 == 0)) == brute(table)


def test_very_many_equal_vectors(spark, rows):
    table = [(i, [0.25, 0.5, -0.25], i % 2) for i in range(400)] + [(i, [0.25, 0.4, -0.25], i % 2) for i in range(400, 460)]
    assert rows(N.mine(spark.createDataFrame(table, SCHEMA), F.col("vec_id") % 50 == 0)) == brute(table)


def test_tables_without_rows_or_partners(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert N.mine(empty, F.col("vec_id") % 50 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0], 1), (50, [1.0], 2)], SCHEMA)
    assert N.mine(alone, F.col("vec_id") % 50 == 0).count() == 0


def test_query_moves_labels(spark, rows, tmp_path):
    table = clustered(400, 8, 5, labels=10)
    spark.createDataFrame(table, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    moved = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in table]
    assert rows(queries.QUERIES["op12_hard_negatives"](spark, str(tmp_path))) == brute(moved)
