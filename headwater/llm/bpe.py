"""Byte-level BPE as an automaton over tokens: encode by transitions, decode by arc labels.

The automaton has a state for each token, the one read last, and an arc from state
a labelled b where b may follow a in a BPE encoding. It starts with the states of
the single bytes and all arcs between them. Each merge u + v = w, in order of rank,
is one gadget:

* w's state gets the arcs that v's state has now, since w ends as v does;
* the arc from u to v goes, since that pair is always merged;
* each state with an arc u gets an arc w, since w begins as u does.

Copying 50,000 rows and columns would cost gigabytes, so an arc's history is followed
instead: it came from the gadget of the younger of its two tokens, which leads to an
older pair. Arcs that were asked for once are kept in a table. A merge whose two parts
no longer stand side by side at its rank yields a token that no text reaches, and
gets no state.

A word's encoding is the one path from its first byte to its last along the arcs.

NULL text is empty and has no ids. Any other text, however long, is encoded whole;
repeated rows alike. Columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from headwater.llm.frames import map_arrow, texts

# The split of byte-level BPE into words: a fixed value of the tokenizer's format.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# What a Python worker keeps of its work, so that its memory is bounded; beyond, it begins anew.
KEPT_TEXTS = 300_000
KEPT_CHARS = 48  # longer ones are encoded each time
KEPT_ARCS = 500_000
_WIDE_SPACE = re.compile(r" \s|\s ")


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves; the others take the characters from
    U+0100 on, in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    found = {chr(b): b for b in printable}
    rest = (b for b in range(256) if chr(b) not in found)
    return {**found, **{chr(0x100 + k): b for k, b in enumerate(rest)}}


class MergeAutomaton:
    """The automaton of a list of merges."""

    def __init__(self, labels: dict[int, bytes], merges: Sequence[tuple[int, int, int]]) -> None:
        """``labels``: the bytes of each token; ``merges``: left, right and merged token, by rank."""
        self.labels = labels
        self.merged = {(u, v): rank for rank, (u, v, _) in enumerate(merges)}
        self.born = {t: -1 for t in labels}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.arcs: dict[tuple[int, int], bool] = {}
        reached = {t for t, label in labels.items() if len(label) == 1}
        for rank, (u, v, w) in enumerate(merges):
            if w in self.left:
                raise ValueError(f"token {w} has two merges")
            self.born[w], self.left[w], self.right[w] = rank, u, v
            if u in reached and v in reached and self._arc_before(u, v, rank):
                reached.add(w)
        # for each byte the token that ends there, or None, and the table of the next byte
        self.trie: dict[int, list] = {}
        for t in sorted(reached):
            node, entry = self.trie, None
            for byte in labels[t]:
                entry = node.setdefault(byte, [None, {}])
                node = entry[1]
            entry[0] = t

    def _arc_before(self, a: int, b: int, rank: int) -> bool:
        """Whether the arc from a to b exists before the gadget of ``rank``."""
        born, merged = self.born, self.merged
        while True:
            gone = merged.get((a, b))
            if gone is not None and gone < rank:
                return False
            younger_a, younger_b = born[a], born[b]
            if younger_a < 0 and younger_b < 0:
                return True
            if younger_a > younger_b:  # a's arcs were copied before its gadget cut one
                a, rank = self.right[a], younger_a
            else:  # the arcs to b were copied after
                b, rank = self.left[b], younger_b + 1

    def arc(self, a: int, b: int) -> bool:
        """Whether token b may follow token a."""
        found = self.arcs.get((a, b))
        if found is None:
            if len(self.arcs) >= KEPT_ARCS:
                self.arcs.clear()
            found = self.arcs[a, b] = self._arc_before(a, b, len(self.merged))
        return found

    def encode(self, word: bytes) -> list[int]:
        """The path through the automaton that spells the word.

        Every beginning of a word has one path, so one state: the token read last.
        From the state at each byte the arcs to all tokens that the word spells
        there are followed; the first arc to reach a later byte is the only one.
        """
        n, arc = len(word), self.arc
        state: list[int | None] = [None] * (n + 1)
        for at in range(n):
            last, node = state[at], self.trie
            for k in range(at, n):
                entry = node.get(word[k])
                if entry is None:
                    break
                token, node = entry
                if token is not None and state[k + 1] is None and (at == 0 or arc(last, token)):
                    state[k + 1] = token
        path = []
        while n:
            path.append(state[n])
            n -= len(self.labels[path[-1]])
        return path[::-1]


class _Kept(dict):
    """Encodings by text as little-endian 32-bit ids, kept up to a bound."""

    def __init__(self, encode: Callable[[str], bytes]) -> None:
        self.encode = encode

    def __missing__(self, text: str) -> bytes:
        found = self.encode(text)
        if len(text) <= KEPT_CHARS:
            if len(self) >= KEPT_TEXTS:
                self.clear()
            self[text] = found
        return found


def read_labels(spec: dict) -> dict[int, bytes]:
    """The bytes of each token of a tokenizer file, but for the special ones."""
    bytes_of = byte_of_character()
    return {t: bytes(bytes_of[c] for c in token) for token, t in spec["model"]["vocab"].items()}


def read_special(spec: dict) -> dict[str, int]:
    return {x["content"]: x["id"] for x in spec["added_tokens"]}


class Tokenizer:
    """The encoding side of a byte-level BPE tokenizer."""

    def __init__(self, spec: dict) -> None:
        vocab = spec["model"]["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        merges = [(vocab[u], vocab[v], vocab[u + v]) for u, v in pairs]
        self.automaton = MergeAutomaton(read_labels(spec), merges)
        self.special = read_special(spec)
        self.split = regex.compile(SPLIT)
        content = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.special_split = regex.compile(f"({content})") if content else None
        self.words = _Kept(lambda word: np.array(self.automaton.encode(word.encode()), "<u4").tobytes())
        self.after_space = _Kept(lambda run: self._split_encode(f" {run}"))

    def _split_encode(self, text: str) -> bytes:
        words = self.words
        return b"".join([words[w] for w in self.split.findall(text)])

    def _encode_plain(self, text: str) -> bytes:
        """The ids of a text without special tokens.

        No word reaches over a space that stands between two other characters than
        white space, but for the space itself, which begins the next word. So such
        a text is cut there, and what follows a space is looked up as a whole.
        """
        if _WIDE_SPACE.search(text):
            return self._split_encode(text)
        first, *rest = text.split(" ")
        return self._split_encode(first) + b"".join(map(self.after_space.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit integers."""
        if self.special_split is None or not any(s in text for s in self.special):
            return self._encode_plain(text)
        parts = self.special_split.split(text)
        return b"".join(
            [self.special[x].to_bytes(4, "little") if k % 2 else self._encode_plain(x) for k, x in enumerate(parts)]
        )


class Labels:
    """The decoding side: the label of each arc."""

    def __init__(self, spec: dict) -> None:
        labels = {**read_labels(spec), **{t: text.encode() for text, t in read_special(spec).items()}}
        self.label = [labels.get(t, b"") for t in range(max(labels) + 1)]

    def decode(self, ids: bytes) -> str:
        """The text of ids: the labels of their arcs, one after another."""
        label = self.label.__getitem__
        return b"".join(map(label, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


def _read(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


@lru_cache(maxsize=1)
def tokenizer(path: str) -> Tokenizer:
    """The encoder of a file that is at ``path`` on every machine; compiled once in each Python worker."""
    return Tokenizer(_read(path))


@lru_cache(maxsize=1)
def arc_labels(path: str) -> Labels:
    return Labels(_read(path))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and the ``ids`` of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            ids = [own.encode(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    rows = texts(docs)
    return map_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` that they spell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = arc_labels(path)
        for batch in batches:
            spelled = [own.decode(ids) for ids in batch.column("ids").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("ids"), pa.array(spelled, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"])

    rows = encoded.select("doc_id", "ids")
    return map_arrow(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, text string")
