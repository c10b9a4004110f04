"""Near-duplicate documents by SuperMinHash signatures, banding, and verification on full sets.

A document's set holds the 64-bit hashes of its word shingles. Documents with equal sets are one
node, so copies never become pairs.

1. *Signatures.* Each element of a set deals out the M places of the signature in a random order of its own:
   in round j it offers its j-th place a random number between j and j + 1, and each place keeps the least offer.
   The ranks of one element differ from place to place, which makes the estimate
   less scattered than independent hashes do. Later offers are larger, so a set is ready after the first round in
   which no place is empty: two rounds or so for long texts, all of them for a single shingle.
2. *Bands.* Each ROWS places are a band, hashed to a key. With 252 places in 42 bands of six, two sets at 0.85 share none with a
   probability of (1 - 0.85 ** 6) ** 42, about two in a billion; at 0.95 it is 1e-24. This chance
   of a miss for each pair is all that is not certain.
3. *Candidates.* The least node of each key is aggregated before the shuffle, and other nodes with the key are
   tied to it. The connected components of the ties are clusters, which no candidate pair leaves.
4. *Verification.* The sets of a cluster meet in blocks of bounded size, and each pair of blocks is a unit. A set is
   compared with those of fitting size that share a key with it and are not yet connected with it; the
   intersection is counted on the full sets. A unit's union-find keeps copies of copies from being compared at all.
5. The links' connected components, by star rounds, are the groups.

NULL and empty texts, or texts without words, have empty sets, linked with nothing. Fewer words than a shingle are one
shingle. Rows of equal ``doc_id`` are documents of their own; NULL is an id that is never the smallest of a group that has another.
Columns other than ``doc_id`` and ``text`` are ignored.
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
from headwater.llm.graph import components
from headwater.llm.similar import block_sets, node_of
from headwater.session import cut_lineage

BANDS, ROWS = 42, 6
PLACES = BANDS * ROWS
BLOCK_SETS = 4_000
BLOCK_SHINGLES = 1_000_000
HELD_ELEMENTS = 1 << 16  # so many elements have their orders of places at hand at once
FEW_ROUNDS = 6
_STEP = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(2**32 - 1)


@dataclass(frozen=True)
class Likeness:
    """Shingles of so many words, and the least share of the intersection in the union."""

    words: int = 5
    share: tuple[int, int] = (85, 100)

    def reached(self, overlap: np.ndarray | int, sizes: np.ndarray | int) -> np.ndarray | bool:
        """Whether sets with these sizes' sum and this overlap are linked."""
        part, whole = self.share
        return (part + whole) * overlap >= part * sizes


def _offers(elements: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """In round ``number``: which of the places left each element takes, and what it offers."""
    random = W.mix(elements + np.uint64((number + 1) * int(_STEP) % 2**64))
    left = ((random & _LOW) * np.uint64(PLACES - number)) >> np.uint64(32)
    return number + left.astype(np.int64), (np.uint64(number) << np.uint64(32)) | (random >> np.uint64(32))


def _sign(elements: np.ndarray, owner: np.ndarray, out: np.ndarray) -> None:
    """Add the offers of some elements to the signatures ``out`` of their owners.

    An order is dealt by swaps: in a round the place taken changes with the first of those left. The first
    rounds keep the swaps alone; the few elements that go on get whole orders.
    """
    swaps: list[tuple[np.ndarray, np.ndarray]] = []  # of each round, the position that changed, and its place since
    orders: np.ndarray | None = None

    def place_at(position: np.ndarray | int) -> np.ndarray:
        found = np.broadcast_to(np.asarray(position, np.int64), len(elements))
        for changed, since in swaps:
            found = np.where(changed == position, since, found)
        return found

    for number in range(PLACES):
        taken, offer = _offers(elements, number)
        if number == FEW_ROUNDS:
            orders = np.tile(np.arange(PLACES, dtype=np.int16), (len(elements), 1))
            for changed, since in swaps:
                orders[np.arange(len(elements)), changed] = since
        if orders is None:
            place = place_at(taken)
            swaps.append((taken, place_at(number)))
        else:
            rows = np.arange(len(elements))
            place = orders[rows, taken].astype(np.int64)
            orders[rows, taken] = orders[:, number]
        np.minimum.at(out.reshape(-1), owner * PLACES + place, offer)
        # later offers are larger, so they change nothing where no place has more than this round offers
        going = (out >= np.uint64((number + 1) << 32)).any(axis=1)[owner]
        if not going.any():
            return
        if not going.all():
            elements, owner = elements[going], owner[going]
            swaps = [(changed[going], since[going]) for changed, since in swaps]
            orders = orders[going] if orders is not None else None


def superminhash(sets: list[np.ndarray]) -> np.ndarray:
    """The signatures of sets that are not empty: a row of PLACES numbers for each."""
    out = np.full((len(sets), PLACES), np.uint64(PLACES) << np.uint64(32))
    sizes = np.array([len(s) for s in sets], np.int64)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sets):
        end = max(begin + 1, int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + HELD_ELEMENTS, "right")))
        owner = np.repeat(np.arange(end - begin), sizes[begin:end])
        elements = W.mix(np.concatenate(sets[begin:end]))
        for lo in range(0, len(elements), HELD_ELEMENTS):  # a very large set comes in pieces
            _sign(elements[lo : lo + HELD_ELEMENTS], owner[lo : lo + HELD_ELEMENTS], out[begin:end])
        begin = end
    return out


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """BANDS keys for each signature."""
    places = signatures.reshape(-1, BANDS, ROWS)
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP, (len(places), 1))
    for k in range(ROWS):
        keys = W.mix(keys * _STEP + places[:, :, k])
    return keys


def _sets(batch: pa.RecordBatch, n_words: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    data, offsets = W.column_bytes(batch.column("text"))
    for first, last in W.blocks(offsets):
        lo = offsets[first]
        yield first, block_sets(data[lo : offsets[last]], offsets[first : last + 1] - lo, n_words)


def _node_rows(batches: Iterator[pa.RecordBatch], n_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, sets in _sets(batch, n_words):
            filled = np.array([len(s) > 0 for s in sets])
            keys = band_keys(superminhash([s for s in sets if len(s)])).view(np.int64)
            ends = np.concatenate([[0], np.cumsum(filled) * BANDS]).astype(np.int32)
            columns = [batch.column(name).slice(first, len(sets)) for name in ("doc_id", "text_hash")]
            columns += [pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) for s in sets], pa.int64())]
            columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1))))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "node", "keys"])


def _hashed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))


def set_nodes(docs: DataFrame, like: Likeness) -> DataFrame:
    """``doc_id, text_hash, n_shingles, node, keys`` of each document."""
    rows = _hashed(docs)
    schema = beside(rows, "n_shingles bigint, node bigint, keys array<bigint>", "text")
    return map_arrow(rows, lambda batches: _node_rows(batches, like.words), schema)


def clusters(sets: DataFrame) -> DataFrame:
    """``node, component`` of distinct ``node, keys``: sets that share a key, directly or through others."""
    keyed = sets.select("node", F.explode("keys").alias("key"))
    least = keyed.groupBy("key").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    ties = keyed.join(least.select("key", "least"), "key").where("node != least").select("node", "least")
    return components(ties.distinct())


def overlaps(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """The sizes of the intersections of a sorted set with others."""
    if not others:
        return np.empty(0, np.int64)
    every = np.concatenate(others)
    hits = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
    sizes = np.array([len(x) for x in others])
    return np.add.reduceat(hits, np.cumsum(sizes) - sizes, dtype=np.int64)


def verify(table: pa.Table, like: Likeness) -> pa.Table:
    """Links between the sets of one block, or of two: as many as connect what is linked."""
    nodes = table.column("node").to_numpy()
    order = np.argsort(table.column("n").to_numpy(), kind="stable")
    sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    sets = [sets[i] for i in order]
    nodes, in_first = nodes[order], np.asarray(table.column("in_first"))[order]
    keys = np.asarray(table.column("keys").combine_chunks().flatten()).reshape(-1, BANDS)[order]
    sizes = np.array([len(x) for x in sets], np.int64)
    group = np.arange(len(sets))
    part, whole = like.share
    links: list[tuple[int, int]] = []
    both = bool(in_first.all())
    for i in range(len(sets)) if both else np.flatnonzero(~in_first):
        # in one block each pair is looked at from its larger set; sets of the block itself have a unit of their own
        lo = int(np.searchsorted(sizes, -(-part * sizes[i] // whole)))
        hi = i if both else int(np.searchsorted(sizes, sizes[i] * whole // part, "right"))
        near = np.arange(lo, hi)
        near = near[(group[near] != group[i]) & in_first[near]]
        near = near[(keys[near] == keys[i]).any(axis=1)]
        while len(near):
            some, near = near[:64], near[64:]
            linked = some[like.reached(overlaps(sets[i], [sets[k] for k in some]), sizes[some] + sizes[i])]
            for k in linked:
                if group[k] != group[i]:
                    group[group == group[k]] = group[i]
                    links.append((int(nodes[i]), int(nodes[k])))
            near = near[group[near] != group[i]]
    return pa.table({"node": pa.array([x[0] for x in links], pa.int64()), "other": pa.array([x[1] for x in links], pa.int64())})


def links(docs: DataFrame, nodes: DataFrame, like: Likeness) -> DataFrame:
    """Links that connect all linked sets; ``nodes`` is the stored result of :func:`set_nodes`."""
    # equal nodes have equal keys and sizes
    distinct = nodes.where("n_shingles > 0").groupBy("node").agg(
        F.min("text_hash").alias("text_hash"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys")
    )
    sets = cut_lineage(distinct)
    members = cut_lineage(sets.join(clusters(sets), "node"))
    sums = members.groupBy("component").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    cut = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    blocks = members.join(sums.select("component", cut.alias("blocks")), "component").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    )
    # one text of each node; copies of it fall away before they are shuffled
    texts = _hashed(docs).select("text_hash", "text").dropDuplicates(["text_hash"]).join(blocks, "text_hash")
    names = ["component", "blocks", "block", "node", "n", "keys"]

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, found in _sets(batch, like.words):
                own = [batch.column(name).slice(first, len(found)) for name in names]
                yield pa.RecordBatch.from_arrays([*own, pa.array([s.tobytes() for s in found], pa.binary())], [*names, "shingles"])

    rows = texts.select(*names, "text")
    with_sets = map_arrow(rows, to_sets, beside(rows, "shingles binary", "text"))
    units = with_sets.withColumn("other_block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "component",
        F.least("block", "other_block").alias("one"),
        F.greatest("block", "other_block").alias("two"),
        (F.col("block") <= F.col("other_block")).alias("in_first"),
        "node", "n", "keys", "shingles",
    )
    by_unit = units.groupBy("component", "one", "two")
    return by_unit.applyInArrow(lambda table: verify(table, like), "node bigint, other bigint")


def near_duplicates(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: the smallest ``doc_id`` that links reach, and whether it is the own one."""
    nodes = cut_lineage(set_nodes(docs, like))
    groups = components(links(docs, nodes, like)).withColumnRenamed("component", "_group")
    named = nodes.select("doc_id", "n_shingles", "node").join(groups, "node", "left")
    group = F.when(F.col("n_shingles") > 0, F.coalesce("_group", "node"))
    found = cut_lineage(named.select("doc_id", "n_shingles", group.alias("group")))
    least = found.where(F.col("group").isNotNull()).groupBy("group").agg(F.min("doc_id").alias("least"))
    own = F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    joined = found.join(least, "group", "left").select("doc_id", "n_shingles", own.alias("component_id"))
    return joined.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
