"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: lines, and within them runs up to a mark of
punctuation, of 64 characters at most. Each gives a digest, the second equal one
another, and so on. A sketch adds each digest to three of its cells, which hold a
count and sums of digests, check digests and lengths. Subtracting the sketches of two
versions leaves the cells of what differs; a cell that holds one digest gives it
away, and taking it out of its other cells makes more of them single, until all
are empty. If cells remain, both versions are sketched anew with twice the cells.

The fingerprint is the smallest sketch, of 24 cells, with the text's length and
number of paragraphs: equal texts have equal fingerprints. The likeness of two
texts is the share of their characters in paragraphs that both have. Two empty texts
are alike (1.0), and an empty and another text are not (0.0).

NULL counts as empty. Ties of ``doc_id`` are ordered by a hash of the text; equal rows
follow each other. A lone document is its own successor. Columns other than ``doc_id``
and ``text`` are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame

from headwater.llm.frames import beside, map_arrow, texts
from headwater.llm.order import in_order
from headwater.llm.words import mix

CELLS = 24
HASHES = 3
BLOCK_CHARS = 1 << 20
_PARAGRAPH = re.compile(r"[^\n.!?,;|]{1,64}[\n.!?,;| ]*|[\n.!?,;| ]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_CHECK = np.uint64(0xD1B54A32D192ED03)


@dataclass
class Digests:
    """The paragraph digests of some texts, one text after another, and the length of each paragraph."""

    keys: np.ndarray
    lengths: np.ndarray
    first: np.ndarray
    n_chars: np.ndarray

    def select(self, which: np.ndarray) -> Digests:
        """The digests of the texts ``which``, in that order."""
        sizes = self.first[which + 1] - self.first[which]
        first = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(first[-1]) + np.repeat(self.first[which] - first[:-1], sizes)
        return Digests(self.keys[at], self.lengths[at], first, self.n_chars[which])

    def of(self, text: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.first[text], self.first[text + 1])
        return self.keys[part], self.lengths[part]


def digest(documents: list[str]) -> Digests:
    """The paragraph digests of texts; equal paragraphs of a text are numbered."""
    parts = [_PARAGRAPH.findall(text) for text in documents]
    sizes = np.array([len(p) for p in parts], np.int64)
    flat = [x for p in parts for x in p]
    raw = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))
    lengths = np.fromiter(map(len, flat), np.int64, len(flat))
    owner = np.repeat(np.arange(len(parts)), sizes)
    order = np.lexsort((raw, owner))
    same = np.zeros(len(flat), bool)
    same[1:] = (raw[order][1:] == raw[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    place = np.arange(len(flat))
    begins = np.maximum.accumulate(np.where(same, 0, place))
    number = np.empty(len(flat), np.uint64)
    number[order] = (place - begins).astype(np.uint64)
    n_chars = np.array([len(text) for text in documents], np.int64)
    return Digests(mix(raw + number * _STEP), lengths, np.concatenate([[0], np.cumsum(sizes)]), n_chars)


@dataclass
class Cells:
    """The cells of some sketches: one row for each, all of one size."""

    count: np.ndarray
    key: np.ndarray
    check: np.ndarray
    length: np.ndarray

    def minus(self, left: np.ndarray, right: np.ndarray) -> Cells:
        """The differences of the sketches ``left`` and ``right``."""
        return Cells(*(x[left] - x[right] for x in (self.count, self.key, self.check, self.length)))

    def add(self, row: np.ndarray, keys: np.ndarray, lengths: np.ndarray, sign: np.ndarray) -> None:
        """Put digests, ``sign`` times, into their cells of a row."""
        size = self.count.shape[1]
        signed = sign.astype(np.uint64)
        checks = mix(keys ^ _CHECK) * signed
        for k in range(HASHES):
            at = row * size + _cell(keys, k, size)
            for cells, value in ((self.count, sign), (self.key, keys * signed), (self.check, checks), (self.length, lengths * sign)):
                np.add.at(cells.reshape(-1), at, value)


def _cell(keys: np.ndarray, k: int, size: int) -> np.ndarray:
    """Where the k-th hash of a digest lies in a sketch; another place in each size of sketch."""
    third = size // HASHES
    shift = np.uint64((size * HASHES + k) * int(_STEP) % 2**64)
    return k * third + (mix(keys + shift) % np.uint64(third)).astype(np.int64)


def sketch(digests: Digests, size: int = CELLS) -> Cells:
    """A sketch of each text."""
    n = len(digests.n_chars)
    cells = Cells(*(np.zeros((n, size), t) for t in (np.int64, np.uint64, np.uint64, np.int64)))
    owner = np.repeat(np.arange(n), np.diff(digests.first))
    cells.add(owner, digests.keys, digests.lengths, np.ones(len(owner), np.int64))
    return cells


@dataclass
class Difference:
    """Of each pair of texts: the digests and characters that only one of them has, and whether all were found."""

    only: np.ndarray  # pairs x 2
    chars: np.ndarray  # pairs x 2
    found: np.ndarray


def peel(cells: Cells) -> Difference:
    """Empty the cells of sketch differences by taking out single digests."""
    pairs, size = cells.count.shape
    only, chars = np.zeros((pairs, 2), np.int64), np.zeros((pairs, 2), np.int64)
    count, key, check, length = (x.reshape(-1) for x in (cells.count, cells.key, cells.check, cells.length))
    look = np.flatnonzero(np.abs(count) == 1)
    while len(look):
        sign = count[look]
        keys = key[look] * sign.astype(np.uint64)
        single = mix(keys ^ _CHECK) * sign.astype(np.uint64) == check[look]
        look, sign, keys = look[single], sign[single], keys[single]
        if not len(look):
            break
        row = look // size
        order = np.lexsort((keys, row))
        fresh = np.ones(len(order), bool)  # a digest may be single in several of its cells
        fresh[1:] = (keys[order][1:] != keys[order][:-1]) | (row[order][1:] != row[order][:-1])
        pick = order[fresh]
        row, keys, sign = row[pick], keys[pick], sign[pick]
        lengths = length[look[pick]] * sign
        side = (sign < 0).astype(np.int64)
        np.add.at(only, (row, side), 1)
        np.add.at(chars, (row, side), lengths)
        cells.add(row, keys, lengths, -sign)
        touched = np.unique(np.concatenate([row * size + _cell(keys, k, size) for k in range(HASHES)]))
        look = touched[np.abs(count[touched]) == 1]
    empty = ~(cells.count.any(axis=1) | cells.key.any(axis=1) | cells.check.any(axis=1))
    return Difference(only, chars, empty)


def _plain_difference(digests: Digests, left: int, right: int) -> tuple[list[int], list[int]]:
    """The same without a sketch."""
    (a, a_chars), (b, b_chars) = digests.of(left), digests.of(right)
    lost, gained = ~np.isin(a, b), ~np.isin(b, a)
    return [int(lost.sum()), int(gained.sum())], [int(a_chars[lost].sum()), int(b_chars[gained].sum())]


def differences(digests: Digests, base: Cells, left: np.ndarray, right: np.ndarray) -> tuple[Difference, np.ndarray]:
    """What differs between texts ``left`` and ``right``, and the cells that it took to find it.

    ``base`` holds the fingerprints' sketches, which are tried first. Where two counts
    alone differ by more than a sketch has cells, that size is left out. A pair that
    no sketch of up to 64 cells a digest resolves, which needs equal digests of
    unequal paragraphs, is compared digest by digest.
    """
    n = np.diff(digests.first)
    out = Difference(*(np.zeros((len(left), 2), np.int64) for _ in range(2)), np.zeros(len(left), bool))
    used = np.zeros(len(left), np.int64)
    size, open_pairs = CELLS, np.arange(len(left))
    while len(open_pairs):
        hopeless = size > 64 * (n[left[open_pairs]] + n[right[open_pairs]] + 1)
        for pair in open_pairs[hopeless]:
            out.only[pair], out.chars[pair] = _plain_difference(digests, left[pair], right[pair])
        open_pairs = open_pairs[~hopeless]
        now = open_pairs[np.abs(n[left[open_pairs]] - n[right[open_pairs]]) <= size]
        if len(now):
            if size == CELLS:
                found = peel(base.minus(left[now], right[now]))
            else:
                needed, at = np.unique(np.concatenate([left[now], right[now]]), return_inverse=True)
                found = peel(sketch(digests.select(needed), size).minus(at[: len(now)], at[len(now) :]))
            done = now[found.found]
            out.only[done], out.chars[done], used[done] = found.only[found.found], found.chars[found.found], size
            open_pairs = np.setdiff1d(open_pairs, done)
        size *= 2
    return out, used


def likeness(digests: Digests, left: np.ndarray, right: np.ndarray, difference: Difference) -> np.ndarray:
    """The share of two texts' characters that is in paragraphs of both."""
    whole = digests.n_chars[left] + digests.n_chars[right]
    return np.where(whole > 0, 1 - difference.chars.sum(axis=1) / np.maximum(whole, 1), 1.0)


def fingerprints(digests: Digests, base: Cells) -> list[str]:
    """The sketches as text: length, paragraphs, and the cells."""
    n = np.diff(digests.first)
    packed = np.zeros(base.count.shape, [("count", "<i4"), ("key", "<u8"), ("check", "<u4"), ("length", "<i4")])
    packed["count"], packed["key"], packed["length"] = base.count, base.key, base.length
    packed["check"] = base.check & np.uint64(0xFFFFFFFF)
    return [
        f"{chars}:{paragraphs}:{base64.b64encode(row.tobytes()).decode()}"
        for chars, paragraphs, row in zip(digests.n_chars.tolist(), n.tolist(), packed)
    ]


def edit(text: str, other: str) -> str:
    """The text with its last quarter replaced by the beginning of another."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + other[:quarter]


_VERSIONS = (
    "n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double, n_lost bigint, n_gained bigint, n_cells bigint"
)


def _compare(ids: pa.Array, rows: list[str], following: np.ndarray) -> pa.RecordBatch:
    """The versions of the texts at ``following``, each of which stands before its successor in ``rows``."""
    edited = [edit(rows[i], rows[i + 1]) for i in following]
    n = len(edited)
    digests = digest([*rows, *edited])
    base = sketch(digests)
    left = np.concatenate([following, following])
    right = np.concatenate([len(rows) + np.arange(n), following + 1])
    found, used = differences(digests, base, left, right)
    near = likeness(digests, left, right, found)
    names = fingerprints(digests, base)
    columns = [
        ids.take(pa.array(following)),
        pa.array(digests.n_chars[following]),
        pa.array(edited, pa.string()),
        pa.array([names[i] for i in following], pa.string()),
        pa.array(names[len(rows) :], pa.string()),
        pa.array(near[:n]),
        pa.array(near[n:]),
        *(pa.array(found.only[:n, side]) for side in (0, 1)),
        pa.array(used[:n]),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", *[x.split()[0] for x in _VERSIONS.split(", ")]])


def _version_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the rows of sorted buckets in blocks; the last row of a block is the first of the next."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        for piece in _slices(batch):
            rows = piece if held is None else pa.concat_batches([held, piece])
            bucket, extra = (np.asarray(rows.column(x)) for x in ("bucket", "extra"))
            following = np.flatnonzero((extra[:-1] == 0) & (bucket[:-1] == bucket[1:]))
            if len(following):
                yield _compare(rows.column("doc_id"), rows.column("text").to_pylist(), following)
            held = rows.slice(len(rows) - 1)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about BLOCK_CHARS bytes of text; a longer text is a part of its own."""
    sizes = np.cumsum(np.asarray(pa.compute.binary_length(batch.column("text")), np.int64))
    at = 0
    while at < len(batch):
        before = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, before + BLOCK_CHARS, "right")))
        yield batch.slice(at, to - at)
        at = to


def versions(docs: DataFrame) -> DataFrame:
    """Each document against its edited text and against the next document.

    The edited text takes its last quarter from the next document, by ``doc_id``;
    the last document's next is the first. ``n_lost`` and ``n_gained`` count the
    paragraphs that the edit took and gave, ``n_cells`` the sketch that told it.
    """
    rows = in_order(texts(docs))
    schema = beside(rows, _VERSIONS, "bucket", "extra", "text")
    return map_arrow(rows, _version_batches, schema)
