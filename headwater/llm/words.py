"""Words of many texts at once: where they are, and a 64-bit hash of each.

A word is a run of characters other than the space and U+0009 to U+000D. The
functions work on the bytes of an Arrow string column, a bounded slice at a time,
so that a task needs little memory beyond the batch that Spark hands it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# So many bytes of words are hashed at once, and so many bytes of texts form one block.
SLICE_BYTES = 1 << 20
BLOCK_BYTES = 2 << 20

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER_BYTE = _BYTE.copy()
_LOWER_BYTE[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(4095, _BASE)]))
LONG_WORD = 1 << 18  # longer words are hashed in pieces, so that no more powers are held


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, _BASE)]))
    return _POWERS


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its texts; NULL is empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return content[places[0] : places[-1]], places - places[0]


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most`` bytes; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


@dataclass
class Words:
    """All words of a block of texts: ``text[i]`` is the text of word i, ``first`` where each text's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """The words of each text, in order, as byte ranges of ``data``."""
    inside = ~_IS_SPACE[data]
    if len(inside):
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = offsets[:-1][offsets[:-1] < offsets[1:]]  # where a text begins, a word begins
        begins[edges] = inside[edges]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:]
        stops[edges[1:] - 1] = inside[edges[1:] - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    else:
        starts = ends = np.empty(0, np.int64)
    first = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(starts, ends, text, first)


def _long_word(table: np.ndarray, word: np.ndarray) -> np.uint64:
    """The hash of one word, piece by piece: the same as that of the word as a whole."""
    powers, total = _powers(LONG_WORD), 0
    for lo in range(0, len(word), LONG_WORD):
        piece = table[word[lo : lo + LONG_WORD]]
        part = int(np.add.reduce(piece * powers[: len(piece)]))
        total = (total + part * pow(int(_BASE), lo, 1 << 64)) % (1 << 64)
    return mix(np.array([(total + len(word)) % (1 << 64)], np.uint64))[0]


def hash_words(data: np.ndarray, words: Words, lower: bool = False) -> np.ndarray:
    """A hash of each word; with ``lower``, A to Z count as a to z."""
    table = _LOWER_BYTE if lower else _BYTE
    out = np.empty(len(words), np.uint64)
    lengths = words.ends - words.starts
    totals = np.concatenate([[0], np.cumsum(lengths)])
    at = 0
    while at < len(out):
        to = max(at + 1, int(np.searchsorted(totals, totals[at] + SLICE_BYTES, "right")) - 1)
        size = lengths[at:to]
        if size.max() > LONG_WORD:
            to = max(at + 1, at + int(np.argmax(size > LONG_WORD)))
            size = lengths[at:to]
        if size[0] > LONG_WORD:
            out[at] = _long_word(table, data[words.starts[at] : words.ends[at]])
            at = to
            continue
        begin = totals[at:to] - totals[at]
        inner = np.arange(totals[to] - totals[at]) - np.repeat(begin, size)
        values = table[data[inner + np.repeat(words.starts[at:to], size)]]
        values *= _powers(int(size.max()))[inner]
        out[at:to] = mix(np.add.reduceat(values, begin) + size.astype(np.uint64))
        at = to
    return out


def shingles(hashes: np.ndarray, words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside one text, and the index of the first word of each."""
    if len(hashes) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(words.text[: len(hashes) - n + 1] == words.text[n - 1 :])
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = mix(out * _BASE + hashes[at + k])
    return out, at
