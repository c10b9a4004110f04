"""Periodic runs of words, found by string synchronising sets.

A run is a stretch of consecutive words with smallest period q (words q apart are
equal) and at least 24 and 3 q words, that no neighbouring word extends with this period.

*Small periods*, up to 8, are found by comparing each word with the one q places on; these
are the highly periodic regions that the smallest scales leave out.

*Larger periods* are found scale by scale. At the scale t (6, 12, 24 and so on) each position has a
number, a hash of its next t words. A position is chosen if the least number of
the positions from it up to the one t further is its own or that of the last; positions whose
t words have a period of t / 3 or less take no part. The choice depends on the next 2 t words only, so a run
with period q repeats its chosen positions q words on, with equal contexts of 2 t words. Where
1.5 t <= q < 3 t, a run of three periods has such a pair: else all its words would be highly periodic, and
q not its smallest period. So pairs of chosen positions with equal contexts and such a
distance propose the periods, and each is extended to both sides as far as it holds. Equal contexts lie more than t / 3
apart, so a position has at most nine partners. The highly periodic regions of a scale are runs of smaller
scales, which are known by then. A multiple of a smallest period gives the same
stretch as that period, and the least period of a stretch stays.

The work grows with the words times the scales, whatever the periods. Words, and stretches of words, are
compared by 64-bit hashes. NULL and empty texts have no words and no runs. A text
is treated whole, in memory that grows with it; repeated rows are treated alike, and columns other than ``text`` are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headwater.llm import words as W
from headwater.llm.frames import beside, map_arrow

LEAST_WORDS = 24
REPEATS = 3
DIRECT = LEAST_WORDS // REPEATS
FIRST_SCALE = 6
_BASE = np.uint64(0xF1357AEA2E62A9C5)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_NONE = np.uint64(2**64 - 1)


class Stretches:
    """Hashes of all stretches of a sequence of word hashes."""

    def __init__(self, hashes: np.ndarray) -> None:
        power = np.full(len(hashes) + 1, _BASE)
        power[0] = 1
        power = np.multiply.accumulate(power)
        self.total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(hashes) * power[:-1], dtype=np.uint64)])
        power[1:] = _INVERSE
        self.back = np.multiply.accumulate(power)

    def hash(self, begin: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.total[begin + size] - self.total[begin]) * self.back[begin]

    def common(self, a: np.ndarray, b: np.ndarray, low: int, most: np.ndarray, forward: bool) -> np.ndarray:
        """How many words from ``a`` and ``b`` on (or before them) are equal: ``low`` at least, at most ``most``."""
        low, high = np.full(len(a), low), most.copy()
        while True:
            pending = np.flatnonzero(low < high)
            if not len(pending):
                return low
            middle = (low[pending] + high[pending] + 1) // 2
            x, y = (a[pending], b[pending]) if forward else (a[pending] - middle, b[pending] - middle)
            equal = self.hash(x, middle) == self.hash(y, middle)
            low[pending[equal]] = middle[equal]
            high[pending[~equal]] = middle[~equal] - 1


@dataclass
class Runs:
    """Stretches of a block of texts by their first words, lengths and periods."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray

    @classmethod
    def of(cls, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Runs:
        return cls(*(np.concatenate([np.empty(0, np.int64), *x]) for x in zip(*parts))) if parts else cls(*[np.empty(0, np.int64)] * 3)

    def where(self, which: np.ndarray) -> Runs:
        return Runs(self.start[which], self.length[which], self.period[which])

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.start, self.length, self.period


def small_periods(hashes: np.ndarray, text: np.ndarray) -> Runs:
    """All maximal stretches of three periods, for the periods up to DIRECT."""
    parts = []
    for period in range(1, DIRECT + 1):
        if len(hashes) <= period:
            break
        equal = np.zeros(len(hashes) - period + 2, np.int8)
        equal[1:-1] = (hashes[period:] == hashes[:-period]) & (text[period:] == text[:-period])
        edges = np.diff(equal)
        begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        length = end - begin + period
        long = length >= REPEATS * period
        parts.append((begin[long], length[long], np.full(int(long.sum()), period)))
    return Runs.of(parts)


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` values in a row."""
    out, width = values, 1
    while 2 * width <= size:
        out = np.minimum(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return np.minimum(out[: len(out) - rest], out[rest:])


def synchronising(stretches: Stretches, place: np.ndarray, end: np.ndarray, scale: int, periodic: Runs) -> np.ndarray:
    """The chosen places among ``place``, which are those of whole texts; ``end`` is where the text of each ends."""
    if len(place) <= scale:
        return np.empty(0, np.int64)
    covered = np.zeros(int(place[-1]) + 2, np.int32)
    highly = periodic.where((periodic.period * 3 <= scale) & (periodic.length >= scale))
    inside = highly.where(highly.start <= place[-1])
    np.add.at(covered, inside.start, 1)
    np.subtract.at(covered, np.minimum(inside.start + inside.length - scale + 1, len(covered) - 1), 1)
    left_out = (np.cumsum(covered)[place] > 0) | (place + scale > end)
    number = np.full(len(place), _NONE)
    own = place[~left_out]
    number[~left_out] = np.minimum(W.mix(stretches.hash(own, scale)), _NONE - np.uint64(1))
    least = _least(number, scale + 1)
    first, last = number[: len(least)], number[scale:]
    chosen = (least != _NONE) & ((least == first) | (least == last)) & (place[: len(least)] + 2 * scale <= end[: len(least)])
    return place[: len(least)][chosen]


def pairs(context: np.ndarray, text: np.ndarray, place: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of chosen places with equal contexts, 1.5 to 3 scales apart."""
    order = np.lexsort((place, context))
    context, text, place = context[order], text[order], place[order]
    found, shift = [(np.empty(0, np.int64), np.empty(0, np.int64))], 1
    at = np.arange(len(place))
    while True:
        at = at[at + shift < len(place)]
        near = (context[at] == context[at + shift]) & (text[at] == text[at + shift])
        near &= place[at + shift] - place[at] < 3 * scale
        at = at[near]
        if not len(at):
            return tuple(np.concatenate(x) for x in zip(*found))
        distance = place[at + shift] - place[at]
        far = 2 * distance >= 3 * scale
        found.append((place[at[far]], distance[far]))
        shift += 1


def find_runs(hashes: np.ndarray, first: np.ndarray) -> Runs:
    """The runs of texts whose words have these hashes; text k has the words from ``first[k]`` on. By start, then period."""
    sizes = np.diff(first)
    text = np.repeat(np.arange(len(sizes)), sizes)
    periodic = small_periods(hashes, text)
    stretches = Stretches(hashes)
    scale = FIRST_SCALE
    whole = np.arange(len(hashes))
    while len(sizes) and 2 * sizes.max() >= 3 * REPEATS * scale:
        place = whole[(2 * sizes >= 3 * REPEATS * scale)[text]]
        end = first[1:][text[place]]
        chosen = synchronising(stretches, place, end, scale, periodic)
        at, period = pairs(stretches.hash(chosen, 2 * scale), text[chosen], chosen, scale)
        after = stretches.common(at, at + period, 2 * scale, first[1:][text[at]] - at - period, True)
        before = stretches.common(at, at + period, 0, at - first[:-1][text[at]], False)
        rows = np.unique(np.stack([at - before, before + after + period, period], axis=1), axis=0)
        rows = rows[rows[:, 1] >= REPEATS * rows[:, 2]]
        periodic = Runs.of([periodic.parts(), tuple(rows.T)])
        scale *= 2
    found = periodic.where(periodic.length >= LEAST_WORDS)
    found = found.where(np.lexsort((found.period, found.length, found.start)))
    again = (found.start[1:] == found.start[:-1]) & (found.length[1:] == found.length[:-1])
    found = found.where(np.concatenate([np.ones(min(len(found.start), 1), bool), ~again]))
    return found.where(np.lexsort((found.period, found.start)))


def joined_words(data: np.ndarray, words: W.Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    which = np.flatnonzero(kept)
    size = words.ends[which] - words.starts[which] + 1  # with a space
    text = words.text[which]
    last = np.concatenate([text[1:] != text[:-1], np.ones(min(len(text), 1), bool)])
    totals = np.concatenate([[0], np.cumsum(size)])
    parts, at = [], 0
    while at < len(which):
        to = max(at + 1, int(np.searchsorted(totals, totals[at] + W.SLICE_BYTES, "right")) - 1)
        own = size[at:to]
        ends = np.cumsum(own)
        source = np.arange(ends[-1]) + np.repeat(words.starts[which[at:to]] - (ends - own), own)
        out = data[np.minimum(source, len(data) - 1)]
        out[ends - 1] = 32
        without = np.ones(len(out), bool)
        without[ends[last[at:to]] - 1] = False
        parts.append(out[without])
        at = to
    n = len(words.first) - 1
    offsets = np.concatenate([[0], np.cumsum(np.bincount(text, size - last, n))]).astype(np.int64)
    content = np.concatenate(parts) if parts else np.empty(0, np.uint8)
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(offsets), pa.py_buffer(content)).cast(pa.string())


_RUNS = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = W.column_bytes(batch.column("text"))
        rest = [i for i, name in enumerate(batch.schema.names) if name != "text"]
        for a, b in W.blocks(offsets):
            own, places = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            words = W.find_words(own, places)
            runs = find_runs(W.hash_words(own, words), words.first)
            dropped = np.zeros(len(words) + 1, np.int32)
            np.add.at(dropped, runs.start + runs.period, 1)
            np.subtract.at(dropped, runs.start + runs.length, 1)
            text = words.text[runs.start] if len(runs.start) else runs.start
            values = pa.StructArray.from_arrays(
                [pa.array(x) for x in (runs.start - words.first[text], runs.length, runs.period)], ["start", "length", "period"]
            )
            ends = np.searchsorted(text, np.arange(b - a + 1)).astype(np.int32)
            columns = [batch.column(i).slice(a, b - a) for i in rest]
            columns += [pa.array(np.diff(words.first)), pa.ListArray.from_arrays(pa.array(ends), values)]
            columns.append(joined_words(own, words, np.cumsum(dropped[:-1]) == 0))
            names = [batch.schema.names[i] for i in rest] + ["n_words", "runs", "collapsed"]
            yield pa.RecordBatch.from_arrays(columns, names)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but ``text`` in ``row``, its number of words, its runs by start, then period, and ``collapsed``.

    The runs' starts are numbers of words. ``collapsed`` has the words that no run contains after its first period,
    joined by one space.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    rows = docs.select(rest, F.coalesce("text", F.lit("")).alias("text"))
    return map_arrow(rows, _rows, beside(rows, _RUNS, "text"))
