"""An Elias-Fano n-gram trie of two levels: contexts, and the successors of each.

The levels lie in one anonymous memory map each, in the task that needs them, and are read as they
are packed: nothing is unpacked beside them.
"""

from __future__ import annotations

import mmap

import numpy as np

SUCCESSOR_BITS = 40  # of a successor's hash, kept beside its context
STEPS = 65_535  # of a quantised logarithm
LOWEST = -16.0  # the least logarithm that is told apart
BLOCK_WORDS = 8  # words of unary bits for each sampled count
_ONE = np.uint64(1)
_WORD = np.uint64(64)


def mapped(*arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as views of one anonymous memory map, released with them."""
    sizes = [-(-a.nbytes // 8) * 8 for a in arrays]
    space = mmap.mmap(-1, max(sum(sizes), 8))
    out, at = [], 0
    for a, size in zip(arrays, sizes):
        view = np.frombuffer(space, a.dtype, a.size, at).reshape(a.shape)
        view[...] = a
        out.append(view)
        at += size
    return out


def quantise(logs: np.ndarray) -> np.ndarray:
    """Logarithms from LOWEST to 0 as 16-bit steps."""
    return np.rint(np.clip(logs / LOWEST, 0, 1) * STEPS).astype(np.uint16)


def restore(steps: np.ndarray) -> np.ndarray:
    return steps.astype(np.float64) * (LOWEST / STEPS)


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Numbers of ``bits`` bits each, one after another in 64-bit words, and one word more."""
    out = np.zeros(len(values) * bits // 64 + 2, np.uint64)
    if bits:
        at = np.arange(len(values), dtype=np.uint64) * np.uint64(bits)
        word, shift = (at // _WORD).astype(np.int64), at % _WORD
        np.bitwise_or.at(out, word, values << shift)
        over = shift + np.uint64(bits) > _WORD
        np.bitwise_or.at(out, word[over] + 1, values[over] >> (_WORD - shift[over]))
    return out


class EliasFano:
    """A sequence of 64-bit numbers that doesn't descend, below ``universe``.

    The low bits of each number, log2(universe / numbers) of them, are packed as they are. The high parts are in unary: the
    i-th number is a one, after as many zeros as its high part says. The ones before every eighth word are counted, and
    a select scans the words between two counts.
    """

    def __init__(self, values: np.ndarray, universe: int) -> None:
        self.n = len(values)
        self.low_bits = min(max(universe // max(self.n, 1), 1).bit_length() - 1, 63)
        shift = np.uint64(self.low_bits)
        self.mask = np.uint64((1 << self.low_bits) - 1)
        self.highs = (max(universe, 1) - 1 >> self.low_bits) + 1
        size = self.n + self.highs
        words = -(-size // (64 * BLOCK_WORDS)) * BLOCK_WORDS
        place = (values >> shift).astype(np.int64) + np.arange(self.n)
        bits = np.zeros(words * 64, np.uint8)
        bits[place] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(high).astype(np.int64).reshape(-1, BLOCK_WORDS).sum(axis=1)
        before = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32)
        self.low, self.high, self.before = mapped(_pack(values & self.mask, self.low_bits), high, before)

    @property
    def nbytes(self) -> int:
        return self.low.nbytes + self.high.nbytes + self.before.nbytes

    def _select(self, rank: np.ndarray, ones: bool) -> np.ndarray:
        """The place of the one, or zero, with each number, from 0."""
        block_bits = 64 * BLOCK_WORDS
        counts = self.before.astype(np.int64) if ones else np.arange(len(self.before)) * block_bits - self.before.astype(np.int64)
        block = np.searchsorted(counts, rank, "right") - 1
        left, word = rank - counts[block], block * BLOCK_WORDS
        for _ in range(BLOCK_WORDS - 1):
            found = np.bitwise_count(self.high[word]).astype(np.int64)
            found = found if ones else 64 - found
            beyond = left >= found
            left, word = np.where(beyond, left - found, left), word + beyond
            if not beyond.any():
                break
        bits = self.high[word] if ones else ~self.high[word]
        at, width = np.zeros(len(rank), np.uint64), 32
        while width:  # halve the word
            found = np.bitwise_count((bits >> at) & np.uint64((1 << width) - 1)).astype(np.int64)
            beyond = left >= found
            left = np.where(beyond, left - found, left)
            at += np.where(beyond, np.uint64(width), np.uint64(0))
            width //= 2
        return word * 64 + at.astype(np.int64)

    def lows(self, at: np.ndarray) -> np.ndarray:
        """The low bits of the numbers at some places."""
        bit = at.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (bit // _WORD).astype(np.int64), bit % _WORD
        # a shift by 64 bits is not defined, so it goes in two steps
        return ((self.low[word] >> shift) | ((self.low[word + 1] << _ONE) << (_WORD - _ONE - shift))) & self.mask

    def get(self, at: np.ndarray) -> np.ndarray:
        """The numbers at some places."""
        high = (self._select(at, True) - at).astype(np.uint64)
        return (high << np.uint64(self.low_bits)) | self.lows(at)

    def successor(self, values: np.ndarray) -> np.ndarray:
        """The place of the first number that isn't below each value."""
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        low = values & self.mask
        first = high > 0
        begin = np.zeros(len(values), np.int64)
        begin[first] = self._select(high[first] - 1, False) + 1 - high[first]
        end = self._select(high, False) - high
        pending = np.flatnonzero(begin < end)
        while len(pending):
            middle = (begin[pending] + end[pending]) // 2
            below = self.lows(middle) < low[pending]
            begin[pending[below]] = middle[below] + 1
            end[pending[~below]] = middle[~below]
            pending = pending[begin[pending] < end[pending]]
        return begin

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each value, -1 where it is not there."""
        if not self.n:
            return np.full(len(values), -1, np.int64)
        at = self.successor(values)
        inside = np.minimum(at, self.n - 1)
        return np.where((at < self.n) & (self.get(inside) == values), at, -1)


class Trie:
    """Contexts by their hashes, and below each its successors by theirs.

    The first level is the contexts. The pointers say where the successors of each begin. In the second level a
    successor is its hash relative to its context: the context's place times 2^40, and 40 bits
    of the hash, so the whole level ascends and a context's successors are found by one successor search.
    """

    def __init__(self, contexts: np.ndarray, degrees: np.ndarray, successors: np.ndarray, logs: np.ndarray) -> None:
        """``contexts`` ascending; ``successors``, ascending in each context, with their log probabilities."""
        self.contexts = EliasFano(contexts, 1 << 64)
        starts = np.concatenate([[0], np.cumsum(degrees)]).astype(np.uint64)
        self.pointers = EliasFano(starts, len(successors) + 1)
        owner = np.repeat(np.arange(len(degrees)), degrees)
        self.successors = EliasFano(self.relative(owner, successors), max(len(degrees), 1) << SUCCESSOR_BITS)
        (self.steps,) = mapped(quantise(logs))

    @property
    def nbytes(self) -> int:
        return self.contexts.nbytes + self.pointers.nbytes + self.successors.nbytes + self.steps.nbytes

    @staticmethod
    def relative(owner: np.ndarray, successors: np.ndarray) -> np.ndarray:
        return (owner.astype(np.uint64) << np.uint64(SUCCESSOR_BITS)) | (successors >> np.uint64(64 - SUCCESSOR_BITS))

    def context(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each context, or -1."""
        return self.contexts.find(hashes)

    def degree(self, context: np.ndarray) -> np.ndarray:
        """How many successors a context (a place) has, by the pointers."""
        return (self.pointers.get(context + 1) - self.pointers.get(context)).astype(np.int64)

    def log(self, context: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """The log probability of each successor after its context (a place); NaN if it isn't there."""
        out = np.full(len(context), np.nan)
        known = np.flatnonzero(context >= 0)
        at = self.successors.find(self.relative(context[known], successors[known]))
        hit = at >= 0
        out[known[hit]] = restore(self.steps[at[hit]])
        return out
