"""Token counts of a unigram vocabulary by count-only Viterbi.

An Aho-Corasick automaton lists every piece that ends at each character of a word;
the best score and its number of pieces are all that the dynamic programme carries.
The tie rules are those of the unigram model of the tokenizers library: only a better score replaces a path,
and of the pieces that end at one character the longest comes first. A character
that is no piece by itself may be skipped for the least score of all pieces minus
10; it counts as many pieces as it has UTF-8 bytes.

Spaces become U+2581, and one stands before the text. A word is a run of them and
what follows, since no piece holds one after another character. NULL and empty texts have no pieces. Long texts are
counted whole, repeated rows alike. Columns other than ``doc_id`` and ``text`` are
ignored. The vocabulary is a public file, whose pieces and scores are used as they
are; nothing is trained.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from headwater.llm.frames import beside, map_arrow, texts

SPACE = "▁"
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
UNKNOWN_PENALTY = 10.0
KEPT_WORDS = 300_000  # counts that a Python worker keeps; beyond, it begins anew
KEPT_CHARS = 48


class UnigramCounter(dict):
    """Word -> (pieces, score)."""

    def __init__(self, pieces: Iterable[tuple[str, float]]) -> None:
        pieces = list(pieces)
        self.automaton = ahocorasick.Automaton()
        lowest = min(score for _, score in pieces)
        for piece, score in pieces:
            if SPACE in piece.lstrip(SPACE):
                raise ValueError(f"piece {piece!r} joins words")
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = lowest - UNKNOWN_PENALTY
        self.single = frozenset(piece for piece, _ in pieces if len(piece) == 1)

    def best(self, word: str) -> tuple[int, float]:
        """The number of pieces of the best path through a word, and its score."""
        n = len(word)
        score: list[float] = [0.0] + [float("-inf")] * n
        count = [0] * (n + 1)
        matches: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.automaton.iter(word):
            matches[end].append(match)
        for end in range(1, n + 1):
            best, pieces = float("-inf"), 0
            for length, piece_score in matches[end - 1]:
                found = score[end - length] + piece_score
                if found > best:
                    best, pieces = found, count[end - length] + 1
            char = word[end - 1]
            if char not in self.single:
                found = score[end - 1] + self.unknown
                if found > best:
                    best, pieces = found, count[end - 1] + len(char.encode())
            score[end], count[end] = best, pieces
        return count[n], score[n]

    def __missing__(self, word: str) -> tuple[int, float]:
        found = self.best(word)
        if len(word) <= KEPT_CHARS:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = found
        return found

    def count(self, text: str) -> tuple[int, float]:
        """The pieces of a text, and their score."""
        if not text:
            return 0, 0.0
        found = [self[word] for word in _WORD.findall(SPACE + text.replace(" ", SPACE))]
        return sum(x[0] for x in found), sum(x[1] for x in found)


def read_pieces(path: str) -> list[tuple[str, float]]:
    """The ordinary pieces of a vocabulary file, with their scores."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [
        t
        for t in range(model.get_piece_size())
        if not (model.is_byte(t) or model.is_control(t) or model.is_unknown(t) or model.is_unused(t))
    ]
    return [(model.id_to_piece(t), model.get_score(t)) for t in plain]


@lru_cache(maxsize=1)
def counter(path: str) -> UnigramCounter:
    """The counter of a file that is at ``path`` on every machine; built once in each Python worker."""
    return UnigramCounter(read_pieces(path))


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``best_score`` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            found = [own.count(text) for text in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array([x[0] for x in found], pa.int64())]
            columns.append(pa.array([float(x[1]) for x in found], pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "best_score"])

    rows = texts(docs)
    return map_arrow(rows, run, beside(rows, "n_tokens bigint, best_score double", "text"))
