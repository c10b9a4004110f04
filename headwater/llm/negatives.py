"""Hard-negative mining with rotated one-bit codes and deterministic intervals.

Vectors are whole numbers, floor(256 x) of each component. The score of a row for an anchor is their inner
product. An anchor's positives are its first rows of the same label, and for each positive the first rows of other labels
whose score lies within given shares of the positive's are its hard negatives; higher scores come first, and
equal ones by id.

1. *Codes.* All vectors are rotated alike (signs and Hadamard transforms, so every machine rotates alike). A row keeps
   the signs of its rotated components, one bit each, as the unit vector c; the alignment a = <v, c> of the
   code with the vector; and the length r of the rest v - a c, which is orthogonal to c.
2. *Intervals.* An anchor q, rotated too, is rounded to PLANES bits for each component, with a rest e.
   Population counts of its bit planes and a row's code give <q - e, c> exactly, which differs from <q, c> by |e| at most. By
   Cauchy-Schwarz on the rests, a <q, c> misses the score by sqrt(|q|^2 - <q, c>^2) r at most. So each pair has
   an interval that holds its score for certain.
3. *Filter.* Pairs whose interval lies below what an anchor still needs, or above what it can use, fall away. The
   surviving ones are scored with whole numbers, and what an anchor needs rises with what it has found.

Anchors are a stated query set, held against all rows: both are cut into blocks of bounded size by a hash of the row,
and each pair of blocks is a unit, which returns the few best of each of its anchors. No label, and no vector that very many rows have,
makes a block larger. Positives come first, then a second round of units with the positives' scores finds the negatives.

Rows with a NULL label, a NULL vector, or a component that is NULL or not finite take no part. Rows equal in id, label and vector count once;
others are rows of their own, whatever their ids. A row with a NULL id is no anchor, and comes last of equal scores. Shorter vectors
are filled up with zeros; an empty one scores 0. Scores are 64-bit numbers. Columns other than these three are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from headwater.llm import words as W
from headwater.llm.frames import map_arrow
from headwater.session import cut_lineage

SCALE = 256
PLANES = 6
ANCHOR_BLOCK = 1 << 15
ROW_BLOCK = 1 << 13
TILE = (256, 2048)  # anchors and rows that are held against each other at once
_SEED = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Mining:
    """How many positives, how many negatives for each, and the shares of a positive's score, in hundredths."""

    positives: int = 5
    negatives: int = 3
    least: int = 50
    most: int = 95


def code_bits(dimension: int) -> int:
    """The bits of a code: a power of two, 64 at least."""
    return 1 << max(6, (max(dimension, 1) - 1).bit_length())


def rotate(vectors: np.ndarray, bits: int) -> np.ndarray:
    """The rows rotated in ``bits`` dimensions: twice random signs and a Hadamard transform."""
    out = np.zeros((len(vectors), bits))
    out[:, : vectors.shape[1]] = vectors
    place = np.arange(bits, dtype=np.uint64)
    for turn in range(2):
        signs = (W.mix(place + np.uint64((turn + 1) * int(_SEED) % 2**64)) >> np.uint64(63)).astype(np.float64) * 2 - 1
        out *= signs
        half = 1
        while half < bits:
            pairs = out.reshape(len(out), -1, 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(out), bits)
            half *= 2
        out /= np.sqrt(bits)
    return out


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(np.uint64)


class Codes(NamedTuple):
    """One-bit codes of rows, their alignments and the lengths of the rests."""

    bits: np.ndarray  # rows x words
    along: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, vectors: np.ndarray, bits: int) -> Codes:
        rotated = rotate(vectors, bits)
        along = np.abs(rotated).sum(axis=1) / np.sqrt(bits)
        rest = np.sqrt(np.maximum((rotated**2).sum(axis=1) - along**2, 0))
        return cls(_packed(rotated > 0), along, rest)


class Queries:
    """Anchors as bit planes, with what the intervals need of them."""

    def __init__(self, vectors: np.ndarray, bits: int) -> None:
        rotated = rotate(vectors, bits)
        low = rotated.min(axis=1, keepdims=True)
        step = np.maximum((rotated.max(axis=1, keepdims=True) - low) / (2**PLANES - 1), 1e-12)
        whole = np.rint((rotated - low) / step).astype(np.int64)
        self.planes = [_packed((whole >> k) & 1) for k in range(PLANES)]
        self.low, self.step, self.sum = low[:, 0], step[:, 0], whole.sum(axis=1)
        self.rest = np.sqrt(((rotated - low - step * whole) ** 2).sum(axis=1))
        self.square = (rotated**2).sum(axis=1)
        self.bits = bits

    def intervals(self, at: np.ndarray, codes: Codes, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest score of each pair of anchors ``at`` and ``rows``."""
        code = codes.bits[rows]
        ones = np.bitwise_count(code).sum(axis=1, dtype=np.int64)
        weighed = np.zeros((len(at), len(rows)), np.int64)
        for k, plane in enumerate(self.planes):
            for word in range(code.shape[1]):
                weighed += np.bitwise_count(plane[at, word][:, None] & code[None, :, word]).astype(np.int64) << k
        low, step = self.low[at][:, None], self.step[at][:, None]
        along = low * (2 * ones - self.bits)[None] + step * (2 * weighed - self.sum[at][:, None])
        along /= np.sqrt(self.bits)
        rest, square = self.rest[at][:, None], self.square[at][:, None]
        across = np.sqrt(np.maximum(square - np.maximum(np.abs(along) - rest, 0) ** 2, 0))
        a, r = codes.along[rows][None], codes.rest[rows][None]
        half = a * rest + across * r
        half += 1e-6 + 1e-9 * np.sqrt(square) * (a + r)  # for the rounding of floats
        return a * along - half, a * along + half


def exact(anchors: np.ndarray, rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The whole-number scores of the pairs ``a[i], b[i]``."""
    out = np.empty(len(a), np.int64)
    for lo in range(0, len(a), 1 << 14):
        part = slice(lo, lo + (1 << 14))
        out[part] = np.einsum("ij,ij->i", anchors[a[part]], rows[b[part]])
    return out


def first_of_each(owner: np.ndarray, score: np.ndarray, tie: np.ndarray, most: int) -> np.ndarray:
    """Which entries are among the first ``most`` of their owner; owners come out in order."""
    order = np.lexsort((tie, -score, owner))
    own = owner[order]
    begins = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.empty(0, np.int64)
    number = np.arange(len(own)) - np.repeat(begins, np.diff(np.append(begins, len(own))))
    return order[number < most]


@dataclass
class Side:
    """The anchors or the rows of a unit."""

    key: np.ndarray  # tells rows apart
    id: np.ndarray
    no_id: np.ndarray
    label: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, dimension: int) -> Side:
        ids = table.column("vec_id")
        vectors = np.zeros((len(table), dimension), np.int64)
        for k, raw in enumerate(table.column("vector").to_pylist()):
            own = np.frombuffer(raw, np.int64)
            vectors[k, : len(own)] = own
        return cls(
            table.column("key").to_numpy(),
            ids.fill_null(0).to_numpy(),
            np.asarray(ids.is_null()),
            table.column("label").to_numpy(),
            vectors,
        )

    def order(self) -> np.ndarray:
        """The place of each row by id, NULL last."""
        out = np.empty(len(self.id), np.int64)
        out[np.lexsort((self.key, self.id, self.no_id))] = np.arange(len(self.id))
        return out


def _codes_of(table: pa.Table) -> Codes:
    words = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint64).reshape(len(table), -1)
    return Codes(words, table.column("along").to_numpy(), table.column("rest").to_numpy())


def find_positives(anchors: Side, rows: Side, codes: Codes, bits: int, mining: Mining) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first rows of the same label for each anchor: places of anchors and rows, and scores."""
    queries, tie = Queries(anchors.vectors, bits), rows.order()
    out = [(np.empty(0, np.int64),) * 3]
    for label in np.unique(anchors.label):
        every, all_rows = np.flatnonzero(anchors.label == label), np.flatnonzero(rows.label == label)
        for i in range(0, len(every), TILE[0]):
            at = every[i : i + TILE[0]]
            best = (np.empty(0, np.int64),) * 3
            need = np.full(len(at), -np.inf)
            for j in range(0, len(all_rows), TILE[1]):
                some = all_rows[j : j + TILE[1]]
                _, high = queries.intervals(at, codes, some)
                a, b = np.nonzero((high >= need[:, None]) & (anchors.key[at][:, None] != rows.key[some][None]))
                score = exact(anchors.vectors, rows.vectors, at[a], some[b])
                best = tuple(np.concatenate(x) for x in zip(best, (a, some[b], score)))
                kept = first_of_each(best[0], best[2], tie[best[1]], mining.positives)
                best = tuple(x[kept] for x in best)
                full = np.bincount(best[0], minlength=len(at)) == mining.positives
                least = np.full(len(at), np.inf)
                np.minimum.at(least, best[0], best[2])
                need = np.where(full, least, -np.inf)
            out.append((at[best[0]], best[1], best[2]))
    return tuple(np.concatenate(x) for x in zip(*out))


def find_negatives(
    anchors: Side, positives: np.ndarray, rows: Side, codes: Codes, bits: int, mining: Mining
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The first rows of other labels for each positive: places of anchor, positive and row, and scores.

    ``positives`` has a row for each anchor with the scores of its positives, NaN where it has fewer.
    """
    queries, tie = Queries(anchors.vectors, bits), rows.order()
    number = positives.shape[1]
    usable = np.where(positives >= 0, positives, np.nan)  # a negative score has an empty range
    least = np.where(np.isnan(usable), np.inf, np.ceil(usable * mining.least / 100 - 1e-9))
    most = np.where(np.isnan(usable), -np.inf, np.floor(usable * mining.most / 100 + 1e-9))
    out = [(np.empty(0, np.int64),) * 4]
    for label in np.unique(anchors.label):
        every = np.flatnonzero((anchors.label == label) & np.isfinite(least).any(axis=1))
        all_rows = np.flatnonzero(rows.label != label)
        for i in range(0, len(every), TILE[0]):
            at = every[i : i + TILE[0]]
            best = (np.empty(0, np.int64),) * 3
            need = least[at].copy()  # of each positive
            for j in range(0, len(all_rows), TILE[1]):
                some = all_rows[j : j + TILE[1]]
                low, high = queries.intervals(at, codes, some)
                a, b = np.nonzero((high >= need.min(axis=1)[:, None]) & (low <= most[at].max(axis=1)[:, None]))
                score = exact(anchors.vectors, rows.vectors, at[a], some[b])
                found = [best]
                for k in range(number):
                    p = usable[at[a], k]
                    # whole numbers decide what lies in the range
                    whole = np.where(np.isnan(p), 0, p).astype(np.int64)
                    inside = ~np.isnan(p) & (mining.least * whole <= 100 * score) & (100 * score <= mining.most * whole)
                    found.append((a[inside] * number + k, some[b[inside]], score[inside]))
                best = tuple(np.concatenate(x) for x in zip(*found))
                kept = first_of_each(best[0], best[2], tie[best[1]], mining.negatives)
                best = tuple(x[kept] for x in best)
                full = np.bincount(best[0], minlength=len(at) * number) == mining.negatives
                worst = np.full(len(at) * number, np.inf)
                np.minimum.at(worst, best[0], best[2])
                need = np.maximum(least[at], np.where(full, worst, -np.inf).reshape(len(at), number))
            out.append((at[best[0] // number], best[0] % number, best[1], best[2]))
    return tuple(np.concatenate(x) for x in zip(*out))


# --- Spark --------------------------------------------------------------------

_CODED = "key bigint, vec_id bigint, label bigint, vector binary, code binary, along double, rest double"


def _coded(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = np.asarray(lists.value_lengths(), np.int64)
            values = np.floor(np.asarray(lists.flatten(), np.float64) * SCALE)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            inner = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            vectors = np.zeros((len(sizes), max(int(sizes.max(initial=0)), 1)))
            vectors[owner, inner] = values
            codes = Codes.of(vectors, bits)
            whole = np.clip(vectors, -(2.0**62), 2.0**62).astype(np.int64)
            columns = [batch.column(name) for name in ("key", "vec_id", "label")]
            columns.append(pa.array([row[:n].tobytes() for row, n in zip(whole, sizes)], pa.binary()))
            columns.append(pa.array([row.tobytes() for row in codes.bits], pa.binary()))
            columns += [pa.array(codes.along), pa.array(codes.rest)]
            names = [x.split()[0] for x in _CODED.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def usable_rows(vectors: DataFrame, label: Column | str = "label") -> DataFrame:
    """``key, vec_id, label, embedding`` of the rows that take part, equal ones once."""
    own = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        (F.col(label) if isinstance(label, str) else label).cast("bigint").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = own.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    return kept.distinct().select(F.xxhash64("vec_id", "label", "embedding").alias("key"), "*")


def _units(anchors: DataFrame, rows: DataFrame, anchor_blocks: int, row_blocks: int) -> DataFrame:
    """Anchors and rows of each pair of blocks, in the columns of both."""
    own = anchors.withColumn("one", F.pmod(F.xxhash64("key"), F.lit(anchor_blocks)).cast("int"))
    own = own.withColumn("two", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))).withColumn("is_anchor", F.lit(True))
    other = rows.withColumn("two", F.pmod(F.xxhash64("key"), F.lit(row_blocks)).cast("int"))
    other = other.withColumn("one", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1)))).withColumn("is_anchor", F.lit(False))
    return own.unionByName(other, allowMissingColumns=True)


def _sides(table: pa.Table, dimension: int) -> tuple[pa.Table, Side, pa.Table, Side]:
    is_anchor = table.column("is_anchor")
    own, other = table.filter(is_anchor), table.filter(pc.invert(is_anchor))
    return own, Side.of(own, dimension), other, Side.of(other, dimension)


def _ids(side: Side, at: np.ndarray) -> pa.Array:
    return pa.array(side.id[at], mask=side.no_id[at])


def mine(vectors: DataFrame, is_anchor: Column, label: Column | str = "label", mining: Mining = Mining()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on ``vec_id``; ``label`` the label to go by, a column or an expression over the columns of ``vectors``.
    """
    usable = cut_lineage(usable_rows(vectors, label))
    chosen = F.coalesce(is_anchor, F.lit(False))
    totals = usable.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(chosen).alias("anchors"), F.max(F.size("embedding")).alias("dimension")
    ).first()
    dimension = max(totals.dimension or 0, 1)
    bits = code_bits(dimension)
    anchor_blocks, row_blocks = max(-(-totals.anchors // ANCHOR_BLOCK), 1), max(-(-totals.rows // ROW_BLOCK), 1)
    coded = cut_lineage(map_arrow(usable, _coded(bits), _CODED))
    anchors = coded.where(chosen).select("key", "vec_id", "label", "vector")

    def positives_of(table: pa.Table) -> pa.Table:
        _, own, rest, rows = _sides(table, dimension)
        a, b, score = find_positives(own, rows, _codes_of(rest), bits, mining)
        return pa.table(
            {"key": pa.array(own.key[a]), "positive": pa.array(rows.key[b]), "positive_id": _ids(rows, b), "score": pa.array(score)}
        )

    by_unit = _units(anchors, coded, anchor_blocks, row_blocks).groupBy("one", "two")
    every = by_unit.applyInArrow(positives_of, "key bigint, positive bigint, positive_id bigint, score bigint")
    ranked = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("positive_id"), "positive")
    # a few for each anchor
    positives = cut_lineage(every.withColumn("nr", F.row_number().over(ranked)).where(F.col("nr") <= mining.positives))
    lists = positives.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("nr", "score"))).getField("score").alias("scores")
    )

    def negatives_of(table: pa.Table) -> pa.Table:
        anchor_table, own, rest, rows = _sides(table, dimension)
        scores = np.full((len(own.key), mining.positives), np.nan)
        for k, found in enumerate(anchor_table.column("scores").to_pylist()):
            scores[k, : len(found)] = found
        a, nr, b, score = find_negatives(own, scores, rows, _codes_of(rest), bits, mining)
        return pa.table(
            {
                "key": pa.array(own.key[a]),
                "anchor_id": _ids(own, a),
                "nr": pa.array(nr.astype(np.int32) + 1),
                "negative": pa.array(rows.key[b]),
                "negative_id": _ids(rows, b),
                "negative_score": pa.array(score),
            }
        )

    by_unit = _units(anchors.join(lists, "key"), coded, anchor_blocks, row_blocks).groupBy("one", "two")
    schema = "key bigint, anchor_id bigint, nr int, negative bigint, negative_id bigint, negative_score bigint"
    found = by_unit.applyInArrow(negatives_of, schema)
    ranked = Window.partitionBy("key", "nr").orderBy(F.desc("negative_score"), F.asc_nulls_last("negative_id"), "negative")
    best = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= mining.negatives)
    joined = best.join(positives.select("key", "nr", "positive_id", F.col("score").alias("positive_score")), ["key", "nr"])
    return joined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
