"""Quality classifier: logistic regression over hashed word n-grams, learned by follow-the-regularised-leader.

Features are the words and pairs of neighbouring words, as written, and the same of
their forms: the kinds of characters that a word has, and whether two neighbours are
equal. Each is hashed to one of 2**18 weights. A feature's value is its share of the
text's features, so a score is the bias plus the mean weight of all features: one
sparse dot product.

The learner sees a bounded sample of labelled documents. It is dealt into a fixed
number of parts by a hash of the id; each part is learned on its own, in an order
given by hashes, and the weights of the parts are averaged, so that the result
does not depend on the cluster.

NULL and empty texts have no features and get the bias. Repeated rows are scored
alike; a document with several labels counts with the smallest. Without labels all
weights are 0. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.frames import beside, labelled_sample, map_arrow, texts

BITS = 18
SAMPLE_ROWS = 20_000  # labelled documents that the weights are learned from, at most
PARTS = 8
THRESHOLD = 0.3
_LEARNED = -1  # marks a part that had rows, among the weights


@dataclass(frozen=True)
class Ftrl:
    """The learner's parameters."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.001
    epochs: int = 4
    scale: float = 8.0  # of the features, beside the bias


# A bit for each kind of character that makes up a word's form.
_KIND = np.zeros(256, np.uint64)
_KIND[97:123] = _KIND[128:256] = 1
_KIND[65:91] = 2
_KIND[48:58] = 4
for _k, _byte in enumerate(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"):
    _KIND[_byte] = 1 << (3 + _k)


def forms(data: np.ndarray, words: W.Words) -> np.ndarray:
    """The kinds of characters of each word, as bits."""
    if not len(words):
        return np.empty(0, np.uint64)
    edges = np.empty(2 * len(words), np.int64)
    edges[0::2], edges[1::2] = words.starts, words.ends
    kinds = np.append(_KIND[data], np.uint64(0))
    return np.bitwise_or.reduceat(kinds, edges)[0::2]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weight of each feature occurrence of a block of texts, and the text that it belongs to."""
    words = W.find_words(data, offsets)
    hashes = W.hash_words(data, words)
    kinds = W.mix(forms(data, words) + np.uint64(7))
    pairs, at = W.shingles(hashes, words, 2)
    equal = (hashes[at] == hashes[at + 1]).astype(np.uint64)
    form_pairs = W.mix(kinds[at] * np.uint64(3) + kinds[at + 1] + equal)
    keys = np.concatenate([hashes, pairs, kinds, form_pairs])
    text = np.concatenate([words.text, words.text[at], words.text, words.text[at]])
    return (keys >> np.uint64(64 - BITS)).astype(np.int64), text


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = W.column_bytes(batch.column("text"))
    for first, last in W.blocks(offsets):
        lo = offsets[first]
        keys, text = features(data[lo : offsets[last]], offsets[first : last + 1] - lo)
        yield first, last, keys, text


def _sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct features of each labelled text, with their shares."""
    names = ["part", "at", "label", "keys", "shares"]
    for batch in batches:
        for first, last, keys, text in _blocks(batch):
            order = np.argsort(text, kind="stable")
            ends = np.searchsorted(text[order], np.arange(last - first + 1))
            rows: list[list[bytes]] = [[], []]
            for a, b in zip(ends[:-1], ends[1:]):
                own, counts = np.unique(keys[order[a:b]], return_counts=True)
                rows[0].append(own.astype(np.int32).tobytes())
                rows[1].append((counts / max(b - a, 1)).astype(np.float32).tobytes())
            plain = [batch.column(name).slice(first, last - first) for name in names[:3]]
            yield pa.RecordBatch.from_arrays([*plain, *(pa.array(x, pa.binary()) for x in rows)], names)


class Learner:
    """Follow the regularised leader, one row at a time; weight 2**BITS is the bias."""

    def __init__(self, ftrl: Ftrl) -> None:
        self.ftrl = ftrl
        self.z = np.zeros((1 << BITS) + 1)
        self.n = np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        f, z, n = self.ftrl, self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - f.l1, 0)
        return -shrunk / ((f.beta + np.sqrt(n)) / f.alpha + f.l2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label
        g = error * x
        grown = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.ftrl.alpha * w
        self.n[at] = grown


def fit(
    docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality", most: int = SAMPLE_ROWS, ftrl: Ftrl = Ftrl()
) -> np.ndarray:
    """The weights, learned from documents with a label where ``train`` holds. The bias is last."""
    rows = labelled_sample(docs.where(train), labels.where(train), label, most).select(
        "text", (F.col("label") > 0).cast("int").alias("label"), F.xxhash64("doc_id").alias("at")
    )
    dealt = rows.withColumn("part", F.pmod("at", F.lit(PARTS)).cast("int"))
    schema = "part int, at bigint, label int, keys binary, shares binary"
    sparse = map_arrow(dealt, _sparse_rows, schema)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list] = {}  # a part holds a bounded share of a bounded sample
        for batch in batches:
            for row in batch.to_pylist():
                at = np.append(np.frombuffer(row["keys"], np.int32), 1 << BITS)
                x = np.append(np.frombuffer(row["shares"], np.float32) * ftrl.scale, 1.0)
                parts.setdefault(row["part"], []).append((row["at"], row["keys"], at, x, row["label"]))
        for part, found in parts.items():
            found.sort(key=lambda row: row[:2])
            learner = Learner(ftrl)
            for _ in range(ftrl.epochs):
                for _, _, at, x, y in found:
                    learner.learn(at, x, y)
            w = learner.weights()
            at = np.flatnonzero(w)
            at, w = np.append(at, _LEARNED), np.append(w[at], 1.0)
            columns = [pa.array(np.full(len(at), part, np.int32)), pa.array(at), pa.array(w)]
            yield pa.RecordBatch.from_arrays(columns, ["part", "at", "weight"])

    learned = map_arrow(sparse.repartition(PARTS, "part"), learn, "part int, at bigint, weight double")
    summed = learned.groupBy("at").agg(F.array_sort(F.collect_list("weight")).alias("weights"))  # at most PARTS each
    weights = np.zeros((1 << BITS) + 1)
    found = summed.select("at", F.aggregate("weights", F.lit(0.0), lambda a, b: a + b).alias("weight")).toPandas()
    at, total = found["at"].to_numpy(np.int64), found["weight"].to_numpy()
    # the mean over the parts that had rows to learn from
    weights[at[at >= 0]] = total[at >= 0] / max(float(total[at == _LEARNED].sum()), 1.0)
    weights[:-1] *= ftrl.scale
    return weights


def score(docs: DataFrame, weights: np.ndarray, *more: str | Column) -> DataFrame:
    """``doc_id``, further columns, and the ``score`` of each document, from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2**18 numbers, whatever the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            rest = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            for first, last, keys, text in _blocks(batch):
                n = last - first
                total = np.bincount(text, w[keys], minlength=n)
                mean = total / np.maximum(np.bincount(text, minlength=n), 1)
                found = 1 / (1 + np.exp(-np.clip(mean + w[-1], -35, 35)))
                columns = [batch.column(i).slice(first, n) for i in rest]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(found)], [batch.schema.names[i] for i in rest] + ["score"]
                )

    rows = texts(docs, *more)
    return map_arrow(rows, run, beside(rows, "score double", "text"))
