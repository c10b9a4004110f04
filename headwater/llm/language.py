"""Language identification by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams, of one to three characters, in order of
frequency. A document goes to the language whose profile is least out of place:
for each n-gram of the document's profile, the difference of its two ranks, or the
profile's length if the language's profile lacks it. Letters are lower-cased, and
runs of other characters separate words; an n-gram shows where a word begins or
ends but never reaches into the next.

The profiles of the languages count all training documents. Ties go to the n-gram,
or the language, that comes first by code point. Texts that are NULL, empty or
without letters are ``und`` with score 0, and so is any text if there was nothing
to learn from. Repeated rows count repeatedly. Columns other than those named are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headwater.llm.frames import beside, map_arrow, texts

PROFILE = 300
UNKNOWN = "und"
_BITS = np.uint64(21)  # of a code point
Profiles = dict[str, np.ndarray]


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str) -> np.ndarray:
    """A number for each n-gram occurrence of a text; word edges are character 0."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = _is_letter()[codes]
    edge = np.zeros(len(codes) + 2, np.uint64)
    edge[1:-1] = np.where(letters, codes, 0)
    keep = np.ones(len(edge), bool)
    keep[1:] = (edge[1:] != 0) | (edge[:-1] != 0)  # one edge between words
    c = edge[keep]
    one = c[c != 0]
    two = (c[:-1] << _BITS) | c[1:]
    three = (c[:-2] << (_BITS + _BITS)) | (c[1:-1] << _BITS) | c[2:] if len(c) > 2 else np.empty(0, np.uint64)
    whole = np.uint64(1) << np.uint64(63)  # tells the lengths apart where an edge leads
    return np.concatenate([one, two | whole, three[(c[1:-1] != 0)] if len(c) > 2 else three])


def counted(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(found, return_counts=True)


def profile(text: str, size: int = PROFILE) -> np.ndarray:
    """The n-grams of a text, the most frequent first."""
    keys, counts = counted(grams(text))
    return keys[np.lexsort((keys, -counts))[:size]]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-gram counts of each language of a batch."""
    for batch in batches:
        by_language: dict[str, list[np.ndarray]] = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            by_language.setdefault(lang, []).append(grams(text))
        for lang, parts in by_language.items():
            keys, counts = counted(np.concatenate(parts))
            columns = [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])


def fit(docs: DataFrame, train: Column, size: int = PROFILE) -> Profiles:
    """The profile of each language of the documents where ``train`` holds: ``size`` numbers a language."""
    rows = texts(docs.where(train & F.col("lang").isNotNull()), F.col("lang").cast("string").alias("lang"))
    counts = map_arrow(rows.select("text", "lang"), _gram_counts, "lang string, gram bigint, n bigint")
    totals = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # as unsigned numbers, the n-grams with the top bit come last
    first = Window.partitionBy("lang").orderBy(F.col("n").desc(), F.col("gram") < 0, "gram")
    top = totals.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= size)
    found: dict[str, list[int]] = {}
    for row in top.orderBy("lang", "rank").select("lang", "gram").collect():
        found.setdefault(row.lang, []).append(row.gram)
    return {lang: np.array(keys, np.int64).view(np.uint64) for lang, keys in found.items()}


class Ranks:
    """Language profiles, ready for comparison."""

    def __init__(self, profiles: Profiles, size: int = PROFILE) -> None:
        self.size = size
        self.languages = sorted(profiles)
        self.sorted = [np.sort(profiles[x]) for x in self.languages]
        self.rank = [np.argsort(profiles[x], kind="stable") for x in self.languages]

    def distances(self, document: np.ndarray) -> np.ndarray:
        """How far out of place a document's profile is in each language."""
        own = np.arange(len(document))
        out = np.empty(len(self.languages), np.int64)
        for k, (keys, rank) in enumerate(zip(self.sorted, self.rank)):
            at = np.minimum(np.searchsorted(keys, document), len(keys) - 1)
            out[k] = np.where(keys[at] == document, np.abs(rank[at] - own), self.size).sum()
        return out

    def predict(self, text: str) -> tuple[str, float]:
        """The nearest language, and how near it is, from 0 to 1."""
        document = profile(text, self.size)
        if not len(document) or not self.languages:
            return UNKNOWN, 0.0
        distances = self.distances(document)
        best = int(np.argmin(distances))
        return self.languages[best], 1.0 - float(distances[best]) / (self.size * len(document))


def identify(docs: DataFrame, profiles: Profiles, *more: str | Column, size: int = PROFILE) -> DataFrame:
    """``doc_id``, further columns, ``lang_pred`` and ``score`` of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(profiles, size)
        for batch in batches:
            found = [ranks.predict(text) for text in batch.column("text").to_pylist()]
            rest = [i for i, name in enumerate(batch.schema.names) if name != "text"]
            columns = [batch.column(i) for i in rest]
            columns += [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [batch.schema.names[i] for i in rest] + ["lang_pred", "score"])

    rows = texts(docs, *more)
    return map_arrow(rows, run, beside(rows, "lang_pred string, score double", "text"))
